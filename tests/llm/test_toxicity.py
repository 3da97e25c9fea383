import zlib

import numpy as np
from pyspark.sql import functions as F

from layerflow.llm import toxicity as m
from tests.llm.cases import LONG, frame, prose


def test_held_out_scores(spark):
    import __spark_entry__ as E

    sf = "/root/testdata/sf0.1"
    got = E.queries()["op10_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in got)
    hit = sum(r["predicted"] and r["toxic"] for r in got)
    assert hit / sum(r["toxic"] for r in got) >= 0.9 and hit / sum(r["predicted"] for r in got) >= 0.9


def test_isotonic_points_rise():
    r = np.random.default_rng(2)
    margin = r.normal(size=400)
    x, y = m.isotonic(margin, (r.random(400) < 1 / (1 + np.exp(-margin))).astype(float), r.random(400) + 0.1)
    assert (np.diff(x) > 0).all() and (np.diff(y) > 0).all() and y.min() >= 0 and y.max() <= 1


def test_trees_learn_a_rule():
    r = np.random.default_rng(5)
    x = r.normal(size=(600, 3))
    y = (x[:, 1] > 0.2).astype(float)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, m.BINS + 1)[1:-1])) for f in range(3)]
    bins = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    tree = m.grow(x, bins, edges, 0.5 - y, np.full(600, 0.25))
    assert ((tree(x) > 0) == (y > 0)).mean() > 0.95


def test_obfuscated_words_fold():
    assert m.fold("id1ot") == "idiot" and m.fold("stuuuupid") == "stupid" and m.fold("w*o*r*m") == "worm"
    w = m.WordWeights({"=idiot": 2.0, "mor": 9.0, "moro": 3.0})
    assert w.of("idiot") == (2.0, 0) and w.of("!idiot!!") == (2.0, 0) and w.of("1d1ot") == (2.0, 1) and w.of("moronic") == (3.0, 0)


def tables(spark, labels):
    rows = [(i, prose(i, 40) + (" you vilword scumbag" if i % 3 == 0 else "")) for i in range(300)]
    rows += [(500, None), (501, ""), (502, LONG), (503, "vilword"), (503, "vilword"), (None, "vilword vilword"), (504, "!!! *** 123")]
    docs = frame(spark, rows).withColumn("score", F.lit("clash")).withColumn("label", F.lit(1)).withColumn("toxic", F.lit(0))
    return docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_edges(spark):
    labels = [(i, 1, int(i % 3 == 0)) for i in range(300)] + [(None, 0, 1), (7, 0, None), (999, 0, 1), (12, 0, 1), (12, 0, 1)]
    docs, marked = tables(spark, labels)
    got = m.toxicity(docs, marked, ~m.held_out(F.col("doc_id")), "found").select("doc_id", "found").collect()
    assert len(got) == docs.count() and all(0 <= r["found"] <= 1 for r in got)
    score = {r["doc_id"]: r["found"] for r in got}
    assert min(score[i] for i in range(0, 300, 3)) > max(score[i] for i in range(1, 300, 3))
    assert score[500] == score[501] and score[500] < 0.3 and score[502] < 0.3


def test_without_labels_or_with_one_class(spark):
    docs, none = tables(spark, [])
    assert {r["toxicity"] for r in m.toxicity(docs, none, F.lit(True)).select("toxicity").collect()} == {0.0}
    _, one = tables(spark, [(i, 0, 1) for i in range(100)])
    assert {r["toxicity"] for r in m.toxicity(docs, one, F.lit(True)).select("toxicity").collect()} == {1.0}
    assert m.toxicity(docs.limit(0), none, F.lit(True)).count() == 0


def test_held_out_labels_teach_nothing(spark):
    labels = [(i, 1, int(i % 3 == 0)) for i in range(300)]
    other = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    out = []
    for x in (labels, other):
        docs, marked = tables(spark, x)
        out.append(sorted((str(r["doc_id"]), r["found"]) for r in m.toxicity(docs, marked, ~m.held_out(F.col("doc_id")), "found").collect()))
    assert out[0] == out[1]


def test_sample_is_bounded_where_one_id_holds_a_third_of_the_rows(spark):
    rows = [(i, f"text {i}") for i in range(400)] + [(2, "the same text")] * 100 + [(2, f"other text {i}") for i in range(100)]
    docs = spark.createDataFrame([*rows, (3, None)], "doc_id long, text string").repartition(7)
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(2, 0)] * 200, "doc_id long, toxic int").repartition(5)
    args = ("doc_id", "text", "toxic")
    texts, y, w = m.sampled(docs, labels, F.lit(True), *args, 40)
    assert 0 < (y == 0).sum() <= 40 and 0 < (y == 1).sum() <= 40 and len(set(texts)) == len(texts)
    assert texts == m.sampled(docs.repartition(3), labels.repartition(2), F.lit(True), *args, 40)[0]
    texts, y, w = m.sampled(docs, labels, F.lit(True), *args, 1000)
    assert sorted(zip(texts, y.tolist())) == sorted({(t or "", i % 2) for i, t in {*rows, (3, None)}})
