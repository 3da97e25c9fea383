import random

import numpy as np
import public_tokenizers as P
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from layerflow.llm import merge_dropout as m
from tests.llm.cases import LONG, corpus, frame

MODEL = P.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
PLAIN, DROPPED = m.Segmenter(MODEL, 1, 0.0, 1), m.Segmenter(MODEL, 1, 0.3, 4)
ODD = ["", " ", "   ", "\n", "  a  b ", "don't. he's, 'll\n\n x", "a b\tc\r\n", "3.14, e.g., x.y .z ,", "a" * 80 + " " * 40 + "b", "é 日本語。 😀", LONG[:9000]]


def ids(segmenter, text, key="1"):
    return np.frombuffer(segmenter.encode(text, key), segmenter.dtype)


def test_without_dropout_as_the_library():
    for text in ODD + [t for _, t, *_ in corpus() if t and "▁" not in t and "\0" not in t and len(t) < 10_000]:
        assert ids(PLAIN, text).tolist() == LIBRARY.encode(text), text[:50]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab the.,▁\n \t\0\"'()"), st.characters(exclude_categories=("Cs",))), max_size=60))
def test_every_text_decodes_to_itself(text):
    for s in (PLAIN, DROPPED):
        assert s.decode(ids(s, text)) == text


def test_seed_key_and_dropout_vary_the_segmentation():
    text = " ".join(["international reconsideration"] * 40)
    one = ids(DROPPED, text)
    assert ids(DROPPED, text).tolist() == one.tolist()
    assert ids(m.Segmenter(MODEL, 1, 0.3, 4), text).tolist() == one.tolist()  # not the kept words, but the seed decides
    assert ids(DROPPED, text, "2").tolist() != one.tolist()
    assert ids(m.Segmenter(MODEL, 2, 0.3, 4), text).tolist() != one.tolist()
    assert len(one) > len(ids(PLAIN, text))
    words = {tuple(DROPPED.segment("▁reconsideration", v).hex() for v in (i,)) for i in range(4)}
    assert len(words) > 1
    everything = m.Segmenter(MODEL, 1, 1.0, 1)
    assert everything.decode(ids(everything, text)) == text and len(ids(everything, text)) == len(" " + text)


def test_operator_on_odd_rows(spark):
    rows = [r[:2] for r in corpus()]
    docs = frame(spark, rows).withColumn("ids", F.lit("clash"))
    out = m.decode(m.encode(docs, MODEL, into="coded"), MODEL, "coded", "back").select("doc_id", "text", "coded", "back").collect()
    assert len(out) == len(rows)
    for r in out:
        assert r["back"] == r["text"] and (r["coded"] is None) == (r["text"] is None)
    digest = m.round_trips(docs, MODEL).select("coded.*")
    assert digest.where("lossless").count() == len(rows)
    staged = m.stage(spark, docs, "")
    assert staged.columns == [*docs.columns, "token_ids"] and m.stage(spark, docs.limit(0), "").count() == 0


def test_query(spark, sf_dir):
    import __spark_entry__ as E

    got = E.queries()["op9_merge_dropout"](spark, sf_dir).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    made = m.Segmenter(MODEL)
    assert len(got) == len(docs) and all(r["lossless"] and r["n_ids"] == len(ids(made, docs[r["doc_id"]] or "", str(r["doc_id"]))) for r in got)


def test_every_occurrence_draws_its_own_dropout():
    made = m.Segmenter(MODEL)  # as the query and the stage make it
    word, times = "reconsideration", 4000
    seen = {}
    for key in range(40):
        row = "|".join(LIBRARY.id_to_piece(int(i)) for i in ids(made, " ".join([word] * (times // 40)), str(key)))
        for taken in row.replace("|\u2581", "\n\u2581").split("\n"):
            seen[taken] = seen.get(taken, 0) + 1
    assert len(seen) > 12 and sum(seen.values()) == times
    # the shares are those of skips drawn by another source, without kept words
    r, other = random.Random(3), {}
    for _ in range(times):
        draw = sum(1 << k for k in range(64) if r.random() < m.DROPOUT)
        row = np.frombuffer(made.segment("\u2581" + word, draw), made.dtype)
        taken = "|".join(LIBRARY.id_to_piece(int(i)) for i in row)
        other[taken] = other.get(taken, 0) + 1
    assert len(other) > 12
    assert sum(abs(seen.get(k, 0) - other.get(k, 0)) for k in {*seen, *other}) < 0.25 * times


def test_kept_segmentations_do_not_matter(monkeypatch):
    texts = ["the international reconsideration of the reconsidered " * 30 + "a" * 300 + " ", "\u2581 odd \u2581words reconsideration " * 20, LONG[:5000]]
    whole = m.Segmenter(MODEL)
    want = [ids(whole, t, k).tolist() for t in texts for k in "123"]
    assert [ids(whole, t, k).tolist() for t in texts for k in "123"] == want
    monkeypatch.setattr(m, "KNOWN", 10)
    small = m.Segmenter(MODEL)
    assert [ids(small, t, k).tolist() for t in texts for k in "123"] == want and small.kept <= 10 + 2000
    assert all(whole.decode(np.array(x)) == t for x, t in zip(want, [t for t in texts for _ in "123"]))


def test_draws_have_the_probability_of_dropout():
    for dropout in (0.1, 0.3, 1.0):
        bits = np.unpackbits(m.Segmenter(MODEL, 1, dropout).draws(np.arange(20_000, dtype=np.uint64) * np.uint64(977)).view(np.uint8))
        assert abs(bits.mean() - dropout) < 0.003


def test_words_merged_together_are_as_merged_alone(monkeypatch):
    rng = np.random.default_rng(5)
    letters = list("abcdeorstin.,éüß漢 ") + ["  ", "x" * 9, "\n"]
    texts = [" ".join("".join(rng.choice(letters, rng.integers(1, 12))) for _ in range(300)) for _ in range(30)]
    texts += ["", None, "one", "\u2581 a\0b", "a" * 400, " ".join(f"word{i % 7}" for i in range(5000))]
    rows = [(t, str(k)) for k, t in enumerate(texts)]
    for dropout in (0.0, 0.1, 0.6, 1.0):
        alone = m.Segmenter(MODEL, 3, dropout)
        alone.together = None
        expected = list(alone.encode_all(rows))
        for together, known in ((m.TOGETHER, m.KNOWN), (200, 50)):
            monkeypatch.setattr(m, "TOGETHER", together)
            monkeypatch.setattr(m, "KNOWN", known)
            made = m.Segmenter(MODEL, 3, dropout)
            assert list(made.encode_all(rows)) == expected
            assert [made.encode(t, k) for t, k in rows if t is not None] == [ids for t, ids in expected if t is not None]


def test_most_words_are_merged_together(monkeypatch):
    made, alone = m.Segmenter(MODEL, 3, 0.1), []
    merged = made._merged
    monkeypatch.setattr(made, "_merged", lambda *a: alone.append(a) or merged(*a))
    made.encode(" ".join(f"reason{i} number{i}" for i in range(2000)), "1")
    assert len(alone) < 100
