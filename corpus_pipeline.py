"""Corpus pipeline over ``documents``: five stages, each written as Parquet
and read again as the next one's input, so a lost executor costs at most one
stage's recomputation.

1. ``language_id`` - documents without a recognised language go.
2. ``line_dedup`` - repeated multi-line chunks are removed from texts.
3. ``ngram_jaccard`` - of each group of near copies one document stays.
4. ``decontaminate`` - documents holding a benchmark window go.
5. ``sentencepiece`` - texts are encoded with merge dropout; the ids are a
   further column.

An empty table passes through all stages; columns that ``documents`` has
beside its own are kept. Null texts have no language and go in stage 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from layerflow.llm import decontaminate, jaccard_join, language_id, line_dedup, merge_dropout
from layerflow.llm.common import staged, table

STAGES = [
    ("language_id", language_id.stage),
    ("line_dedup", line_dedup.stage),
    ("ngram_jaccard", jaccard_join.stage),
    ("decontaminate", decontaminate.stage),
    ("sentencepiece", merge_dropout.stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs


#: SQL cannot express the trained, hashed and merging stages; the tests hold
#: the pipeline against brute-force versions of its stages instead.
ORACLE_SQL = None
