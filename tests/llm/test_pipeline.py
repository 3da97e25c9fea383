import re

import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F

import corpus_pipeline
from layerflow.llm import language_id, line_dedup, merge_dropout
from tests.llm import test_decontaminate as decon
from tests.llm import test_jaccard_join as jaccard
from tests.llm import test_line_dedup as dedup
from tests.llm.cases import SCHEMA


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def brute(spark, docs, sf_dir):
    """The rows (doc_id, text) that the stages leave, without the operators."""
    net = language_id.train(language_id.sampled(docs, ~language_id.held_out(F.col("doc_id")), "doc_id", "text", "lang"))
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    rows = [r for r, (lang, score) in zip(rows, language_id.predictions(net, [t for _, t in rows]))
            if lang != "und" and score >= language_id.MIN_SCORE]
    kept = dedup.brute(rows)
    rows = [(d, kept[False, d, t]) for d, t in rows]
    groups = jaccard.brute(rows)
    rows = [r for i, (r, (n, members)) in enumerate(zip(rows, groups)) if not n or i == min(members)]
    items = [(r["item_id"], r["text"]) for r in read(spark, sf_dir, "benchmark").collect()]
    hits = decon.brute(rows, items)
    return [r for r in rows if not hits[r[0]][1]]


def test_pipeline_matches_brute_force(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == [*docs.columns, "token_ids"]
    rows = got.collect()
    assert sorted((r["doc_id"], r["text"]) for r in rows) == sorted(brute(spark, docs, sf_dir))
    made = merge_dropout.Segmenter(P.path("piece_bpe_32k.model"))
    assert all(made.decode(np.array(r["token_ids"])) == r["text"] for r in rows)


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "ngram_jaccard", "decontaminate", "sentencepiece"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_on_odd_tables(spark, sf_dir):
    rows = [(1, "the man and the\nold dog ran\nfar", "en", "s", 9), (1, "the man and the\nold dog ran\nfar", "en", "s", 9), (2, None, None, None, None),
            (None, "words without any id at all", "en", "s", 1), (3, "", "en", "s", 0), (4, "12 34", "en", "s", 5)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("row", F.lit(1)).withColumn("language", F.lit("l"))
    for table in (docs, docs.limit(0)):
        now = table
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, sf_dir)
            assert now.columns[:len(docs.columns)] == docs.columns, name
        assert now.count() <= table.count()
    assert re.fullmatch(r"\w+", corpus_pipeline.STAGES[0][0]) and line_dedup.MIN_LINES >= 2
