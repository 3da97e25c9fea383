"""Page source (S1), bad-payload quarantine (S2), invalid-element filter (S3).

A page is one JSON envelope ``{"data": [...], "_links": {"next": ...}}``.
Pages arrive as files (one envelope per file, read whole) or as lines of a
JSON-lines file. Every step is a per-row expression on VARIANT; the only
shuffle is the small per-page reject count.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class PageSplit:
    elements: DataFrame   # page, source, pos, id, doc (VARIANT) — valid review elements
    quarantine: DataFrame  # page, source, logged_at, payload (whole), reason
    rejects: DataFrame    # page, reason, dropped  (S3 counts per page)


def read_page_files(spark: SparkSession, path: str, whole_file: bool = True) -> DataFrame:
    """S1 reader. ``whole_file``: one envelope per file (the API's page);
    otherwise one envelope per line. Returns (source, payload)."""
    # text()'s own ``wholetext`` argument would override a reader option
    df = spark.read.text(path, wholetext=whole_file)
    return df.select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("payload"))


def split_pages(pages: DataFrame, page_col: str = "page", payload_col: str = "payload",
                source_col: str | None = "source") -> PageSplit:
    """Parse envelopes and split them into good elements, quarantined pages
    and per-page element reject counts."""
    src = F.col(source_col) if source_col and source_col in pages.columns else F.lit(None).cast("string")
    parsed = pages.select(
        F.col(page_col).alias("page"), src.alias("source"), F.col(payload_col).alias("payload"),
        F.try_parse_json(F.col(payload_col)).alias("v"),
    ).withColumn("data", F.expr("try_cast(v:data as array<variant>)"))
    bad_reason = (F.when(F.col("v").isNull(), F.lit("bad_json"))
                  .when(F.col("data").isNull(), F.lit("data_not_list")))
    parsed = parsed.withColumn("reason", bad_reason)

    quarantine = parsed.where(F.col("reason").isNotNull()).select(
        "page", "source", F.current_timestamp().alias("logged_at"),
        "payload", "reason")

    el = (parsed.where(F.col("reason").isNull())
          .select("page", "source", F.posexplode("data").alias("pos", "doc")))
    as_map = F.expr("try_cast(doc as map<string, variant>)")
    el = el.withColumn(
        "reject",
        F.when(as_map.isNull(), F.lit("not_object"))
        .when(~F.map_contains_key(as_map, F.lit("id")), F.lit("no_id")))
    elements = el.where(F.col("reject").isNull()).select(
        "page", "source", "pos", F.expr("try_variant_get(doc, '$.id', 'string')").alias("id"), "doc")
    rejects = (el.where(F.col("reject").isNotNull())
               .groupBy("page", F.col("reject").alias("reason"))
               .agg(F.count(F.lit(1)).alias("dropped")))
    return PageSplit(elements, quarantine, rejects)
