import zlib

import numpy as np
from pyspark.sql import functions as F

from layerflow.llm import language_id as m
from tests.llm.cases import LONG, frame

#: Morphemes of two invented languages.
A, B = ("the", "ing", "and", "tion", "er"), ("der", "ung", "sch", "keit", "ein")


def text(kind, seed, n=40):
    r = np.random.default_rng(seed)
    return " ".join("".join(r.choice(kind, r.integers(1, 4))) for _ in range(n))


def labelled(n=120):
    return [(i, text(A if i % 3 else B, i), "en" if i % 3 else "de") for i in range(n)]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    import __spark_entry__ as E

    got = E.queries()["op6_language_id"](spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in held) / len(held) >= 0.95


def test_windows_cover_the_whole_text():
    for n in (0, 1, 3, m.LENGTH - 1, m.LENGTH, m.LENGTH + 1, 5 * m.LENGTH + 7):
        body = bytes(i % 251 + 1 for i in range(n))
        view, added = m.windows_of(body)
        assert view.shape[1] == m.LENGTH and added.sum() == max(1, n)
        grams = {body[i:i + 4] for i in range(n - 3)}
        assert grams <= {bytes(w[i:i + 4]) for w in view for i in range(m.LENGTH - 3)}


def test_edges_and_clashing_columns(spark):
    rows = labelled() + [(200, None, "en"), (201, "", "en"), (202, "123 !?", "de"), (203, text(B, 7), None), (203, text(B, 7), None),
                         (None, text(A, 9), "en"), (204, LONG, None)]
    docs = frame(spark, rows).withColumn("language", F.lit("x")).withColumn("score", F.lit(5))
    got = m.identify(docs, ~m.held_out(F.col("doc_id")), "found").select("doc_id", "found.*").collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: (r["lang"], r["score"]) for r in got}
    assert by_id[200] == by_id[201] == by_id[202] == ("und", 0.0) and by_id[203][0] == "de"
    out = m.stage(spark, docs, "")
    assert out.columns == docs.columns and {200, 201, 202}.isdisjoint(r["doc_id"] for r in out.collect())


def test_no_labels_one_label_empty(spark):
    none = frame(spark, [(1, "some text", None)])
    assert m.identify(none, F.lit(True)).select("language.*").first() == ("und", 0.0)
    one = m.identify(frame(spark, [(1, "some text", "en"), (3, "more", "en")]), F.lit(True)).select("language.*").collect()
    assert {tuple(r) for r in one} == {("en", 1.0)}
    assert m.stage(spark, none.limit(0), "").count() == 0


def test_labels_are_never_inputs(spark):
    rows = labelled()
    held = [i for i, *_ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    other = [(i, t, "zz" if i in held else lang) for i, t, lang in rows]
    out = [{r["doc_id"]: r["language"] for r in m.identify(frame(spark, x), ~m.held_out(F.col("doc_id"))).collect()} for x in (rows, other)]
    assert out[0] == out[1]


def test_numerals_are_no_letters():
    assert not any(map(m.has_letter, ("", "²", "½ ①", "\u2167 12", "_-!"))) and m.has_letter("1 é") and m.has_letter("語")


def test_sample_is_bounded_where_one_id_holds_a_third_of_the_rows(spark):
    rows = [(i, f"word{i} again", "aa" if i % 2 else "bb") for i in range(400)]
    rows += [(1, "the same text", "aa")] * 150 + [(1, f"other text {i}", "aa") for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7)
    got = m.sampled(docs, F.lit(True), "doc_id", "text", "lang", 40)
    assert {lang: sum(g[0] == lang for g in got) for lang in ("aa", "bb")}.keys() == {"aa", "bb"}
    assert all(0 < sum(g[0] == lang for g in got) <= 40 for lang in ("aa", "bb")) and len(got) == len(set(got))
    assert got == m.sampled(docs.repartition(3), F.lit(True), "doc_id", "text", "lang", 40)
    everything = m.sampled(docs, F.lit(True), "doc_id", "text", "lang", 1000)
    assert sorted(everything) == sorted((lang, text.encode()) for _, text, lang in set(rows))
