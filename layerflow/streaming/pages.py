"""Page stream -> field-level upsert (T1) with replay safety.

Page files arriving in a folder are read by the Structured Streaming file
source; each micro-batch is split into valid review elements (S1-S3) and
merged into the document state (U1) inside ``foreachBatch``. The state is a
bucketed table of the layer store: a batch writes one delta with its own fields,
readers take the latest row of each field, and a bucket with ``MAX_PARTS`` files
is folded into one. What a batch writes so grows with the batch, not with the
store. The publish that makes a delta current also records the stream's id and the micro-batch id, so a batch that
is replayed after a failure (both from the streaming checkpoint) changes
nothing, while another stream's batches, or those of a new checkpoint, count.
Bad pages and reject counts are stored in the same publish.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from layerflow.operators import upsert as ou
from layerflow.session import shared_dir
from layerflow.sources import layers as sl
from layerflow.sources import pages as sp

PAGE_FILE_PATTERN = r"page-(\d+)"
# Buckets of a new document state; a caller's own count is kept with the state.
STATE_BUCKETS = 64
# Files of a bucket at which the next batch folds them into one.
MAX_PARTS = 8
MAX_SINK_PARTS = 16
STATE_SCHEMA = "id string, field string, value_json string, seq struct<batch:bigint,page:bigint,source:string,pos:int>"


def page_stream(spark: SparkSession, path: str, whole_file: bool = False,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming (page, source, payload). The page number is the envelope's
    ``page`` field when present, else the number in a ``page-<n>`` file name."""
    r = spark.readStream.format("text").option("wholetext", whole_file)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.load(path)
    src = F.col("_metadata.file_path")
    page = F.coalesce(F.expr("try_variant_get(try_parse_json(value), '$.page', 'bigint')"),
                      F.regexp_extract(src, PAGE_FILE_PATTERN, 1).try_cast("bigint"))
    return df.select(page.alias("page"), src.alias("source"), F.col("value").alias("payload"))


@dataclass
class Batch:
    """A merged batch of pages, written but not yet visible."""
    split: sp.PageSplit
    metrics: dict
    parts: dict                      # files of the whole state with this batch, by bucket
    touched: dict                    # those of them in the buckets that the batch falls in
    ids: DataFrame                   # the documents of the batch
    rows_written: int
    change: Callable[[], tuple[dict, Callable[[dict], dict]]]  # tables and state, for a publish with other layers
    commit: Callable[[], dict | None]                          # publishes the batch by itself
    clean_up: Callable[[], None]                               # after it is published


def merge_batch(store: sl.LayerStore, layer: str, table: str, batch: DataFrame, buckets: int | None = None,
                mark: tuple[str, int] | None = None, max_parts: int = MAX_PARTS) -> Batch | None:
    """Merge pages into the document state and write what changes aside.

    The state is hash-bucketed on the document id. The bucket count is part of
    the published state. The batch's own fields are written as one delta; only a
    bucket that would have more than ``max_parts`` files is merged and rewritten,
    and all of them if ``buckets`` asks for another count. Fields are ordered by (batch, page, source, position),
    the batch being counted by the manifest, so a later run wins over an
    earlier one whatever its page numbers. ``mark``: (query id, micro-batch id);
    one that is published already returns None."""
    cur = store.current(layer)
    if mark and cur.get("stream_marks", {}).get(table, {}).get(mark[0], -1) >= mark[1]:
        return None
    number = cur.get("batches", {}).get(table, 0) + 1
    stored = cur.get("bucket_counts", {}).get(table)
    count = buckets or stored or STATE_BUCKETS
    split = sp.split_pages(batch, source_col="source")
    seq = F.struct(F.lit(number).cast("bigint").alias("batch"), F.col("page").cast("bigint").alias("page"), F.col("source").alias("source"),
                   F.col("pos").cast("int").alias("pos"))
    fields = ou.document_fields(split.elements.select("id", "doc", seq.alias("seq")), "seq")
    # read twice below (touched buckets, merge): written once, so a lost executor costs no parsing
    path = shared_dir(store.spark, "page-batch") + "/fields"
    fields.withColumn("bucket", _bucket(count)).write.parquet(path)
    fields = store.spark.read.parquet(path)
    # at most ``count`` small integers reach the driver
    touched = sorted(r.bucket for r in fields.select("bucket").distinct().collect())
    current = sl.parts_of(cur.get("buckets", {}).get(table, {}))
    rebucket = bool(current) and stored not in (None, count)
    metrics = {"upserted": 0, "matched": 0, "modified": 0, "total": 0}
    new_map, written = dict(current), 0
    fold = {str(b) for b in touched if len(current.get(str(b), ())) + 1 > max_parts}
    ids = fields.select("id").distinct()
    within = ou.field_upsert(None, fields.drop("bucket")).withColumn("bucket", _bucket(count))
    if touched or rebucket:
        old = current if rebucket else {str(b): current[str(b)] for b in touched if str(b) in current}
        state = read_state(store, old)
        if rebucket:
            rows = ou.field_upsert(state, fields.drop("bucket"))
        else:
            folded = F.col("bucket").cast("string").isin(*fold)
            rows = within.where(~folded).drop("bucket").unionByName(
                ou.field_upsert(read_state(store, {b: old[b] for b in fold}), fields.where(folded).drop("bucket"))) if fold else within.drop("bucket")
        # rows of a bucket meet before the write, large buckets are split by size: few files, none huge
        res = store.write_version(layer, f"{table}__state", rows.withColumn("bucket", _bucket(count)).hint("rebalance", "bucket"),
                                  partition_by=["bucket"])
        written = res.rows_stored
        if rebucket:
            hit = store.spark.read.parquet(res.path).select("bucket").distinct().collect()
            new_map = {str(r.bucket): [f"{res.path}/bucket={r.bucket}"] for r in hit}
        else:
            for b in map(str, touched):
                new_map[b] = ([] if b in fold else current.get(b, [])) + [f"{res.path}/bucket={b}"]
        # U2 over the documents that this batch touched (one row)
        before = state.join(ids, "id", "left_semi")
        row = ou.upsert_metrics(before, ou.field_upsert(before, fields.drop("bucket"))).first()
        metrics = {k: int(row[k]) for k in metrics}
    rejected = {name: store.write_version(layer, f"{table}__{name}", df.withColumn("batch", F.lit(number).cast("bigint")))
                for name, df in (("quarantine", split.quarantine), ("rejects", split.rejects))}

    def state_of(now: dict) -> dict:
        if now.get("batches", {}).get(table, 0) != number - 1:
            raise RuntimeError(f"{layer}.{table}: another batch was published meanwhile; merge again")
        totals = dict(now.get("stream_metrics", {}).get(table, {}))
        for k in ("upserted", "matched", "modified"):
            totals[k] = totals.get(k, 0) + metrics[k]
        out = {"batches": {**now.get("batches", {}), table: number}, "bucket_counts": {**now.get("bucket_counts", {}), table: count},
               "buckets": {**now.get("buckets", {}), table: new_map},
               "merge": {**now.get("merge", {}), table: {"keys": ["id", "field"], "order": "seq"}}, "stream_metrics": {**now.get("stream_metrics", {}), table: totals}}
        if mark:
            marks = now.get("stream_marks", {})
            out["stream_marks"] = {**marks, table: {**marks.get(table, {}), mark[0]: mark[1]}}
        return out

    def change() -> tuple[dict, Callable[[dict], dict]]:
        tables = {table: sorted(p for ps in new_map.values() for p in ps)} if new_map else {}
        for name, res in rejected.items():
            if not res.rows_stored:
                store.fs.delete(res.path)
                continue
            # kept beside those of earlier batches, in at most MAX_SINK_PARTS files
            before = store.current(layer)["tables"].get(f"{table}__{name}", [])
            if len(before) + 1 > MAX_SINK_PARTS:
                before = [store.write_version(layer, f"{table}__{name}", store.spark.read.parquet(*before)).path]
            tables[f"{table}__{name}"] = [*before, res.path]
        return tables, state_of

    def clean_up() -> None:
        store.fs.delete(path)

    def commit() -> dict | None:
        published = store.publish(layer, *change())
        clean_up()
        return published

    own = {str(b): new_map[str(b)] for b in touched}
    return Batch(split, metrics, new_map, own, ids, written, change, commit, clean_up)


def upsert_batch(store: sl.LayerStore, layer: str, table: str, batch: DataFrame, batch_id: int | None = None,
                 buckets: int | None = None, query_id: str = "") -> dict | None:
    """Merge and publish one micro-batch; a replayed one (same query and batch
    id) changes nothing and returns None. Quarantined pages and reject counts
    are published with it as ``<table>__quarantine`` and ``<table>__rejects``."""
    done = merge_batch(store, layer, table, batch, buckets, None if batch_id is None else (query_id, batch_id))
    if done is None:
        return None
    done.commit()
    return {"split": done.split, "metrics": done.metrics, "rows_written": done.rows_written}


def read_state(store: sl.LayerStore, parts: dict | None) -> DataFrame:
    """The document state in the given files by bucket (of a batch that may not
    be published yet)."""
    if not parts:
        return store.spark.createDataFrame([], STATE_SCHEMA)
    return sl.read_parts(store.spark, parts, ["id", "field"], "seq", STATE_SCHEMA)


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")


def query_id(checkpoint: str, spark: SparkSession) -> str:
    """The id that Spark keeps in a stream's checkpoint folder; a new folder is
    a new query, whose batch ids start again."""
    fs = sl._FS(spark, checkpoint)
    path = f"{checkpoint.rstrip('/')}/metadata"
    return json.loads(fs.read(path))["id"] if fs.fs.exists(fs._Path(path)) else ""


def run_page_upsert(spark: SparkSession, pages_path: str, store: sl.LayerStore, layer: str, table: str,
                    checkpoint: str, whole_file: bool = False, max_files_per_trigger: int | None = None,
                    buckets: int | None = None) -> StreamingQuery:
    """Start the stream with ``availableNow``: process every page present,
    in micro-batches, then stop."""
    stream = page_stream(spark, pages_path, whole_file, max_files_per_trigger)
    return (stream.writeStream
            .foreachBatch(lambda df, bid: upsert_batch(store, layer, table, df, bid, buckets, query_id(checkpoint, spark)))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())
