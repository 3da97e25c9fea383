"""The whole daily job on real inputs, as one Spark application.

    pages (JSON envelopes)  ->  document store (field-level upsert by id)
    documents               ->  raw parent + child tables   (discovery, shredding)
    reference CSV files     ->  raw all-string tables
    raw -> clean -> relational (constraint-gated) -> checks report -> star

Each step reads what the previous step stored aside; all layers of a run, the
document store included, go live in one commit of the layer store. A run that
fails part-way leaves every published layer as it was.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.operators import upsert as ou
from layerflow.operators.checks import failed, run_checks
from layerflow.operators.clean import MAPPING_COLUMNS
from layerflow.operators.increment import shred_increment
from layerflow.operators.relational import filled_flags
from layerflow.plans import reviews as R
from layerflow.sources.csv import CsvRead, read_csv
from layerflow.sources.layers import LayerStore
from layerflow.sources.pages import read_page_files
from layerflow.streaming.pages import PAGE_FILE_PATTERN, Batch, merge_batch, read_state

@dataclass
class DailyResult:
    model: R.Model
    report: DataFrame
    star: dict
    failed: bool


def page_number(payload: str = "payload", source: str = "source"):
    """The envelope's ``page`` field, else the number in a ``page-<n>`` file name."""
    return F.coalesce(F.expr(f"try_variant_get(try_parse_json({payload}), '$.page', 'bigint')"),
                      F.regexp_extract(F.col(source), PAGE_FILE_PATTERN, 1).try_cast("bigint"))


def merge_pages(spark: SparkSession, store: LayerStore, pages_path: str, whole_file: bool = True,
                buckets: int | None = None) -> tuple[Batch, DataFrame]:
    """S1-S3 + U1 + U2: merge new pages into the document store as a delta (the
    same merge as the page stream). The result is not live yet; with it come the
    documents (id, doc) that the pages touch, or all of them where the raw layer
    has none yet."""
    pages = read_page_files(spark, pages_path, whole_file).withColumn("page", page_number())
    batch = merge_batch(store, "docs", "fields", pages, buckets)
    if "reviews" not in store.current("raw").get("groups", {}):
        return batch, ou.assemble_documents(read_state(store, batch.parts)).select("id", "doc")
    fields = read_state(store, batch.touched).join(batch.ids, "id", "left_semi")
    return batch, ou.assemble_documents(fields).select("id", "doc")


def kept_reference(store: LayerStore, read: CsvRead, table: str) -> DataFrame:
    """A reference file without rows keeps the table that is live."""
    if read.rows.isEmpty() and table in store.current("raw")["tables"]:
        return store.table("raw", table)
    return read.rows


def run(spark: SparkSession, pages_path: str, properties_csv: str, mapping_csv: str, root: str,
        as_of: str | None = None, loaded_at: str | None = None, sep: str = ",", encoding: str = "UTF-8",
        whole_file_pages: bool = True, build_star: bool = True, keep_versions: int | None = None,
        keep_seconds: float = 24 * 3600, mapping_columns: tuple[str, str] = MAPPING_COLUMNS,
        floors: dict[str, int] | None = None, buckets: int | None = None) -> DailyResult:
    """Run every step; ``failed`` is true iff a check FAILed (the reference's
    exit status). Every layer, the document store included, is written aside;
    all go live at the end, after floors and constraints held. ``floors``: the
    smallest row counts of the clean tables. ``mapping_columns``: the cleaned
    names of the internal and external id in the mapping file.
    ``keep_versions``: drop table versions that the newest N manifests of a
    layer do not name and that are older than ``keep_seconds``."""
    store = LayerStore(spark, root)
    version = uuid.uuid4().hex[:12]
    as_of = as_of or spark.sql("SELECT date_format(current_timestamp(), 'yyyy-MM-dd HH:mm:ss')").first()[0]
    loaded_at = loaded_at or as_of
    batch, docs = merge_pages(spark, store, pages_path, whole_file_pages, buckets)
    # The key columns must be there after name cleaning
    props = read_csv(spark, properties_csv, sep=sep, encoding=encoding, expected_columns=["id"])
    mapping = read_csv(spark, mapping_csv, sep=sep, encoding=encoding, expected_columns=list(mapping_columns))
    # Only documents that are new or changed are shredded; all other raw rows stay where they are
    shredded = shred_increment(store, "raw", "reviews", docs, loaded_at)
    m = R.Model(counters=shredded.counters, mapping_columns=mapping_columns, grouped=shredded.tables, extras={"raw": shredded.extra})
    m.raw = {**shredded.tables, "propriedades": kept_reference(store, props, "propriedades"),
             "id_mapping": kept_reference(store, mapping, "id_mapping")}
    m = R.stage_layers(m, store, version, R.CLEAN_FLOORS if floors is None else floors)
    counters = m.counters.get
    ingest = {"bad_payloads": batch.split.quarantine, "rejected_elements": batch.split.rejects,
              "upsert_metrics": spark.createDataFrame([tuple(batch.metrics.values())], ", ".join(f"{k} bigint" for k in batch.metrics)),
              "shred_counts": spark.createDataFrame([(int(counters["processed"]), int(counters["skipped"]), int(counters["failed"]))],
                                                    "processed bigint, skipped bigint, failed bigint"),
              "filled_flags": filled_flags(m.clean["properties"]),
              "csv_rejects": props.rejects.withColumn("table_name", F.lit("propriedades"))
              .unionByName(mapping.rejects.withColumn("table_name", F.lit("id_mapping")))}
    m.aside["ingest"] = store.build_aside("ingest", ingest, version)
    m.aside["checks"] = store.build_aside("checks", {"report": run_checks(R.check_layers(m), as_of)}, version)
    star = R.star_schema(m, publish=False) if build_star else {}
    R.publish_aside(m, {"docs": batch.change()})  # one commit over all layers
    batch.clean_up()
    report = store.table("checks", "report")
    if keep_versions:
        for layer in ("docs", "ingest", "raw", "clean", "rel", "checks", "star"):
            store.vacuum(layer, keep_versions, keep_seconds)
    return DailyResult(m, report, star, failed(report))


def main(argv: list[str] | None = None) -> int:
    """``python -m layerflow.plans.daily --pages ... --properties ...
    --mapping ... --root ...``; exit status 1 iff a check FAILed."""
    import argparse

    from layerflow.session import build_session

    p = argparse.ArgumentParser(description="layered review build")
    p.add_argument("--pages", required=True)
    p.add_argument("--properties", required=True)
    p.add_argument("--mapping", required=True)
    p.add_argument("--root", required=True, help="layer store root on the shared file system")
    p.add_argument("--sep", default=",")
    p.add_argument("--encoding", default="UTF-8")
    p.add_argument("--internal-id", default=MAPPING_COLUMNS[0], help="cleaned name of the mapping file's internal id")
    p.add_argument("--external-id", default=MAPPING_COLUMNS[1], help="cleaned name of the mapping file's external id")
    p.add_argument("--no-star", action="store_true")
    a = p.parse_args(argv)
    spark = build_session()
    res = run(spark, a.pages, a.properties, a.mapping, a.root, sep=a.sep, encoding=a.encoding,
              build_star=not a.no_star, mapping_columns=(a.internal_id, a.external_id))
    for r in res.report.orderBy("check_id").collect():
        print(f"[{r.status:4s}] {r.check_name} (observed {r.observed})")
    return 1 if res.failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
