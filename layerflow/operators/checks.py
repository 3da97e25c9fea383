"""Cross-layer data-quality report.

All conditional counts, distinct counts and averages of a table are one
aggregate (G4) that yields a handful of metric rows. Cross-table checks scan
the keys once more: an anti join per layer for orphans, and one full outer join
of the reviews for key and score parity. The metric rows (a fixed, small number) are pivoted into one row
and the 44 checks are evaluated as Column expressions, so the report is one
Spark job and nothing but the final report rows leaves the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerflow.operators.relational import to_dt, to_ts

# Thresholds of the reference checks.
MIN_ROWS = [("raw", "reviews", 100), ("clean", "reviews", 100), ("rel", "reviews", 100),
            ("raw", "reviews_evaluationaspects", 100), ("clean", "review_aspects", 100),
            ("raw", "propriedades", 10), ("clean", "properties", 10)]
SCORE_MIN, SCORE_MAX = 0, 10
PLAUSIBLE_AVG = (5.0, 10.0)
CRITICAL_NULLS = [("clean", "reviews", "external_property_id"), ("clean", "reviews", "created_at"),
                  ("clean", "reviews", "sales_channel_code"), ("rel", "reviews", "external_property_id"),
                  ("rel", "reviews", "sales_channel_code"), ("clean", "review_aspects", "aspect_id"),
                  ("clean", "review_aspects", "review_id"), ("clean", "review_aspects", "aspect"),
                  ("rel", "review_aspects", "aspect_id")]
WARN_ONLY_NULLS = ["external_property_id"]
PK = {"reviews": "review_id", "review_aspects": "aspect_id", "properties": "property_id"}
REPORT_COLUMNS = ["check_id", "family", "check_name", "layer", "table_name", "column_name",
                  "severity", "status", "observed"]


def _metric_rows(df: DataFrame, prefix: str, exprs: dict[str, Column]) -> DataFrame:
    """One aggregate over ``df`` -> rows (metric, value)."""
    agg = df.agg(*[e.cast("double").alias(k) for k, e in exprs.items()])
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(f"{prefix}.{k}").alias("metric"), F.col(k).alias("value")) for k in exprs
    ])).alias("m")).select("m.*")


def _range_bad(c: str) -> Column:
    return F.count_if(F.col(c).isNotNull() & ((F.col(c) < SCORE_MIN) | (F.col(c) > SCORE_MAX)))


CHECKED_COLUMNS = {"reviews": {"review_id": "string", "overall_score": "double", "arrival_date": "string",
                               "departure_date": "string", "created_at": "string",
                               "external_property_id": "bigint", "sales_channel_code": "string"},
                   "review_aspects": {"aspect_id": "bigint", "review_id": "string", "aspect": "string",
                                      "score": "double"}}


def _with_checked_columns(df: DataFrame, table: str) -> DataFrame:
    """A checked column the table does not carry counts as all NULL."""
    missing = {c: F.lit(None).cast(t) for c, t in CHECKED_COLUMNS.get(table, {}).items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def _beside(left: DataFrame, right: DataFrame, key: str, a: str | None = None, b: str | None = None) -> DataFrame:
    """Full outer join on a key: l and r say which side has it, a and b are the
    values of either side."""
    def value(c):
        return F.col(c).cast("double") if c else F.lit(None).cast("double")

    l_ = left.select(key, F.lit(1).alias("l"), value(a).alias("a"))
    r_ = right.select(key, F.lit(1).alias("r"), value(b).alias("b"))
    return l_.join(r_, key, "full_outer")


def key_parity(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys that only one side has, and those of both."""
    present = F.col(key).isNotNull()
    j = _beside(left.select(key).distinct(), right.select(key).distinct(), key)
    return j.agg(F.count_if(F.col("r").isNull()).alias("only_left"), F.count_if(F.col("l").isNull()).alias("only_right"),
                 F.count_if(present & F.col("l").isNotNull() & F.col("r").isNotNull()).alias("both"))


def value_parity(left: DataFrame, right: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """Rows of a key on both sides with values, and those that differ."""
    j = _beside(left, right, key, a, b).where("a is not null and b is not null")
    return j.agg(F.count(F.lit(1)).alias("matched"), F.count_if(F.col("a") != F.col("b")).alias("mismatched"))


def row_counts(layers: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """G1: (layer, table_name, row_count) of every table."""
    out = None
    for layer, tables in layers.items():
        for t, df in tables.items():
            c = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(layer).alias("layer"), F.lit(t).alias("table_name"), "row_count")
            out = c if out is None else out.unionByName(c)
    return out


def score_distribution(aspects: DataFrame, aspect: str = "aspect", score: str = "score") -> DataFrame:
    """Average score and number of rows per aspect."""
    return aspects.groupBy(F.col(aspect).alias("aspect")).agg(F.round(F.avg(score), 2).alias("avg_score"), F.count(F.lit(1)).alias("n"))


def table_metrics(layers: dict[str, dict[str, DataFrame]], as_of) -> DataFrame:
    layers = {lyr: {t: _with_checked_columns(df, t) for t, df in tables.items()} for lyr, tables in layers.items()}
    out = []
    for layer, tables in layers.items():
        for tname, df in tables.items():
            ex: dict[str, Column] = {"rows": F.count(F.lit(1))}
            if layer in ("clean", "rel") and tname in PK and PK[tname] in df.columns:
                pk = PK[tname]
                ex["dupes"] = F.count(F.lit(1)) - F.count_distinct(pk)
            if tname == "reviews" and layer in ("clean", "rel"):
                ex["null_review_id"] = F.count_if(F.col("review_id").isNull())
                ex["bad_score"] = _range_bad("overall_score")
                ex["avg_score"] = F.round(F.avg("overall_score"), 2)
                arr, dep = to_dt(df, "arrival_date"), to_dt(df, "departure_date")
                ex["bad_dates"] = F.count_if(arr.isNotNull() & dep.isNotNull() & (dep < arr))
                ex["future_created"] = F.count_if(to_ts(df, "created_at") > F.lit(as_of).cast("timestamp_ntz"))
            if tname == "review_aspects" and layer in ("clean", "rel"):
                ex["bad_score"] = _range_bad("score")
                ex["avg_score"] = F.round(F.avg("score"), 2)
            for (lyr, tbl, col) in CRITICAL_NULLS:
                if lyr == layer and tbl == tname:
                    ex[f"null_{col}"] = F.count_if(F.col(col).isNull())
            out.append(_metric_rows(df, f"{layer}.{tname}", ex))
    # cross-table: orphans (J1), then key and score parity (X1, J2) of one join
    for layer in ("clean", "rel"):
        ra, r = layers[layer]["review_aspects"], layers[layer]["reviews"]
        orphans = ra.select("review_id").join(r.select("review_id"), "review_id", "left_anti")
        out.append(_metric_rows(orphans, f"{layer}.cross", {"orphans": F.count(F.lit(1))}))
    both = _beside(layers["clean"]["reviews"], layers["rel"]["reviews"], "review_id", "overall_score", "overall_score")
    out.append(_metric_rows(both, "x.ids", {
        "only_clean": F.count_distinct(F.when(F.col("r").isNull(), F.col("review_id"))),
        "only_rel": F.count_distinct(F.when(F.col("l").isNull(), F.col("review_id"))),
        "mismatch": F.count_if(F.col("a") != F.col("b"))}))
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res


# What a metric of violations must show, by its name (critical columns: null_<column>).
RULES = {"dupes": "no repeated key", "bad_score": "scores from 0 to 10", "bad_dates": "departure not before arrival",
         "future_created": "nothing created in the future", "orphans": "every review exists", "only_clean": "the same keys",
         "mismatch": "the same scores", "avg_score": "plausible average"}


def _title(layer: str, table: str, column: str | None, kind: str, metric: str, threshold) -> str:
    """A check's name from its parts."""
    what = metric.rsplit(".", 1)[-1]
    rule = {"eq": "equal row counts", "min": f"at least {threshold} rows"}.get(kind) or RULES.get(what, "no missing value")
    return f"{layer}.{table}" + (f".{column}" if column else "") + f": {rule}"


def _specs() -> list[tuple]:
    """(family, layer, table, column, severity, kind, metric(s), threshold)."""
    s: list[tuple] = []
    raw_names = {"reviews": "reviews", "review_aspects": "reviews_evaluationaspects", "properties": "propriedades"}
    for t, raw_t in raw_names.items():
        s.append(("V1", "raw/clean", t, None, "FAIL", "eq", (f"raw.{raw_t}.rows", f"clean.{t}.rows"), None))
        s.append(("V1", "clean/rel", t, None, "FAIL", "eq", (f"clean.{t}.rows", f"rel.{t}.rows"), None))
    s += [("V2", layer, t, None, "FAIL", "min", (f"{layer}.{t}.rows",), n) for layer, t, n in MIN_ROWS]
    for layer in ("clean", "rel"):
        s += [("V3", layer, t, pk, "FAIL", "zero", (f"{layer}.{t}.dupes",), None) for t, pk in PK.items()]
    s += [("V3", layer, "reviews", "review_id", "FAIL", "zero", (f"{layer}.reviews.null_review_id",), None) for layer in ("clean", "rel")]
    s += [("V4", layer, t, c, "FAIL", "zero", (f"{layer}.{t}.bad_score",), None)
          for t, c in (("reviews", "overall_score"), ("review_aspects", "score")) for layer in ("clean", "rel")]
    s.append(("V5", "rel", "reviews", "overall_score", "WARN", "avg", ("rel.reviews.avg_score",), "fail_if_null"))
    s.append(("V5", "rel", "review_aspects", "score", "WARN", "avg", ("rel.review_aspects.avg_score",), "skip_if_null"))
    for column, metric in (("departure_date", "bad_dates"), ("created_at", "future_created")):
        s += [("V6", layer, "reviews", column, "WARN", "zero", (f"{layer}.reviews.{metric}",), None) for layer in ("clean", "rel")]
    s += [("V7", layer, t, c, "WARN" if c in WARN_ONLY_NULLS else "FAIL", "zero", (f"{layer}.{t}.null_{c}",), None)
          for layer, t, c in CRITICAL_NULLS]
    s += [("V8", layer, "review_aspects", "review_id", "FAIL", "zero", (f"{layer}.cross.orphans",), None) for layer in ("clean", "rel")]
    s.append(("V9", "clean/rel", "reviews", "review_id", "FAIL", "zero2", ("x.ids.only_clean", "x.ids.only_rel"), None))
    s.append(("V9", "clean/rel", "reviews", "overall_score", "FAIL", "zero", ("x.ids.mismatch",), None))
    return s


CHECK_SPECS = _specs()


def run_checks(layers: dict[str, dict[str, DataFrame]], as_of) -> DataFrame:
    """Report rows (check_id, family, check_name, layer, table_name,
    column_name, severity, status, observed). ``status`` is PASS, WARN,
    FAIL or SKIP (aspect average without scores, as the reference skips it).
    The run fails iff any status is FAIL (``failed(report)``)."""
    metrics = table_metrics(layers, as_of)
    keys = sorted({m for spec in CHECK_SPECS for m in spec[6]})
    wide = metrics.groupBy().pivot("metric", keys).agg(F.first("value"))
    rows = []
    for i, (fam, layer, tbl, col, sev, kind, ms, thr) in enumerate(CHECK_SPECS, start=1):
        name = _title(layer, tbl, col, kind, ms[0], thr)
        v = [F.col(f"`{m}`") for m in ms]
        if kind == "eq":
            observed = v[0] - v[1]
            ok = observed == 0
        elif kind == "min":
            observed = v[0]
            ok = observed >= thr
        elif kind == "zero2":
            observed = v[0] + v[1]
            ok = observed == 0
        elif kind == "avg":
            observed = v[0]
            ok = (observed >= PLAUSIBLE_AVG[0]) & (observed <= PLAUSIBLE_AVG[1])
        else:
            observed = v[0]
            ok = observed == 0
        status = F.when(ok, F.lit("PASS")).otherwise(F.lit(sev))
        if kind == "avg":
            status = F.when(observed.isNull(), F.lit("FAIL" if thr == "fail_if_null" else "SKIP")).otherwise(status)
        rows.append(F.struct(F.lit(i).alias("check_id"), F.lit(fam).alias("family"), F.lit(name).alias("check_name"),
                             F.lit(layer).alias("layer"), F.lit(tbl).alias("table_name"),
                             F.lit(col).cast("string").alias("column_name"), F.lit(sev).alias("severity"),
                             status.alias("status"), observed.cast("double").alias("observed")))
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def failed(report: DataFrame) -> bool:
    """Exit status of the reference: true iff any check FAILed."""
    return not report.where(F.col("status") == "FAIL").isEmpty()


def with_details(report: DataFrame) -> DataFrame:
    """Adds a readable ``detail`` per check (what the reference prints)."""
    n = F.format_number(F.abs(F.col("observed")), 0)
    kind = (F.when(F.col("family") == "V1", F.concat(F.lit("row delta "), n))
            .when(F.col("family") == "V2", F.concat(n, F.lit(" rows")))
            .when(F.col("family") == "V5", F.when(F.col("observed").isNull(), F.lit("no scores found"))
                  .otherwise(F.concat(F.lit("avg="), F.col("observed").cast("string"))))
            .otherwise(F.concat(n, F.lit(" violating rows"))))
    return report.withColumn("detail", F.when(F.col("status") == "PASS", F.concat(F.lit("ok: "), kind))
                             .otherwise(kind))
