"""Clean -> relational layer.

Spark enforces no keys, so each constraint is an explicit check: primary
keys by exact distinct counts, foreign keys by anti joins, column sizes by
``count_if``. A violated hard constraint fails the build before publish.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerflow.functions import clean as fc
from layerflow.functions import typing as ft

# Relational column sizes and flags of the reference.
PROPERTY_SIZES = {"team": 100, "neighbourhood": 200, "floor": 20, "garage_info": 200}
REVIEW_SIZES = {"review_id": 255, "mongo_id": 255, "sales_channel_code": 50, "language": 10,
                "external_id": 100, "customer_name": 255}
ASPECT_SIZES = {"review_id": 255, "aspect": 50}
# Ids are BIGINT, whatever the reference's column holds, so they never run out.
PROPERTY_INTS = {"property_id": "bigint", **dict.fromkeys(
    ["postcode_prefix", "postcode_suffix", "is_inactive", "has_elevator", "max_occupancy", "num_bathrooms_with_shower",
     "num_basic_bathrooms", "has_washing_machine", "has_dishwasher", "has_air_conditioning", "has_self_checkin"], "int")}
MAPPING_INTS = {"property_id": "bigint", "external_property_id": "bigint"}
REVIEW_INTS = {"external_property_id": "bigint", "booking_id": "bigint", "is_validated": "int"}
ASPECT_INTS = {"aspect_id": "bigint"}
PROPERTY_FLAGS_NOT_NULL = ["is_inactive", "has_washing_machine", "has_dishwasher",
                           "has_air_conditioning", "has_self_checkin"]
REVIEW_DROP = ["hash_evaluationaspects", "is_eligible_for_response", "external_response_status", "likes_count"]


class ConstraintViolation(RuntimeError):
    pass


# Working columns of trimmed text, so that each rule reads it without trimming
# again (the rules name their input several times).
_TRIMMED = "__trimmed_"


def _dtype(df: DataFrame, c: str):
    return df.schema[c].dataType


def to_int(df: DataFrame, c: str, target: str = "int") -> Column:
    """F6 for any input type: numbers and booleans cast directly, text by
    the guarded rule."""
    t = _dtype(df, c)
    if isinstance(t, (T.IntegralType, T.BooleanType)):
        return F.col(c).try_cast(target)
    if isinstance(t, (T.FractionalType,)):
        return F.when(F.col(c) == F.floor(F.col(c)), F.col(c).try_cast(target))
    return ft.to_nullable_int(c, target, c.startswith(_TRIMMED))


def int_error(df: DataFrame, c: str, target: str = "int") -> Column:
    """Why a value would fail the integer column; NULL where it would not."""
    t = _dtype(df, c)
    if isinstance(t, T.FractionalType):
        d = F.col(c).cast("double")
        return (F.when(F.isnan(d) | (F.abs(d) == float("inf")), F.lit("infinite value"))
                .when(F.abs(d) > 2.0 ** 63, F.lit("value out of range"))
                .when(d != F.floor(d), F.lit("fractional value"))
                .when(d.isNotNull() & F.col(c).try_cast(target).isNull(), F.lit("value out of range")))
    if isinstance(t, (T.IntegralType, T.BooleanType)):
        return F.when(F.col(c).isNotNull() & F.col(c).try_cast(target).isNull(), F.lit("value out of range"))
    return ft.to_nullable_int_error(c, target, c.startswith(_TRIMMED))


def to_float(df: DataFrame, c: str) -> Column:
    t = _dtype(df, c)
    if isinstance(t, T.NumericType):
        return F.col(c).cast("double")
    return ft.to_nullable_float(c)


def to_ts(df: DataFrame, c: str) -> Column:
    t = _dtype(df, c)
    if isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.col(c).cast("timestamp_ntz")
    return ft.to_datetime(c)


def to_dt(df: DataFrame, c: str) -> Column:
    return to_ts(df, c).cast("date")


def int_errors(df: DataFrame, ints: dict[str, str]) -> Column:
    """Reason and name of the first column whose value fails its integer type."""
    found = [F.concat(int_error(df, c, t), F.lit(f" in {c.removeprefix(_TRIMMED)}")) for c, t in ints.items() if c in df.columns]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def _failed(df: DataFrame, ints: dict[str, str]) -> Column:
    """Whether any column has a value that its integer type cannot hold. In a
    filter every mention of a trimmed text trims it again, so plain numerals are
    told by their text as it is."""
    flags = [~ft.is_small_int(c.removeprefix(_TRIMMED)) & ft.is_failed_int(c, t) if c.startswith(_TRIMMED)
             else int_error(df, c, t).isNotNull() for c, t in ints.items()]
    return reduce(lambda a, b: a | b, flags, F.lit(False))


def split_errors(df: DataFrame, table: str, key: str, error: Column, failed: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows without an ``error``, and the dead letter of the others
    (failed_at, table_name, key, error); ``failed``: a cheaper test of them."""
    failed = error.isNotNull() if failed is None else failed
    bad = df.where(failed).select(F.current_timestamp().alias("failed_at"), F.lit(table).alias("table_name"),
                                  F.col(key).cast("string").alias("key"), error.alias("error"))
    return df.where(~failed), bad


def _typed(clean: DataFrame, table: str, key: str, ints: dict[str, str], others: dict) -> tuple[DataFrame, DataFrame]:
    """The columns of ``ints`` as integers, those of ``others`` by their rule;
    rows with a value that no integer column can hold go to the dead letter."""
    here = {c: t for c, t in ints.items() if c in clean.columns}
    texts = {c: _TRIMMED + c for c in here if isinstance(_dtype(clean, c), T.StringType)}
    work = clean.withColumns({w: ft.trimmed_mostly(c) for c, w in texts.items()}) if texts else clean
    read = {texts.get(c, c): t for c, t in here.items()}
    good, bad = split_errors(work, table, key, int_errors(work, read), _failed(work, read))
    conv = {c: to_int(good, texts.get(c, c), t) for c, t in here.items()}
    conv |= {c: rule(good, c) for c, rule in others.items() if c in clean.columns}
    return good.withColumns(conv).drop(*texts.values()), bad


_PROPERTY_RULES = {"start_date": to_ts, "inactive_date": to_ts}
_REVIEW_RULES = {"overall_score": to_float, "arrival_date": to_dt, "departure_date": to_dt, "created_at": to_ts,
                 "response_date": to_dt}
_ASPECT_RULES = {"score": to_float, "created_at": to_ts}


def build_properties(clean: DataFrame) -> tuple[DataFrame, DataFrame]:
    """P10 + P11 + F8. Returns (properties, dead letter)."""
    df = clean
    if "gps_coordinates" in df.columns:
        lat, lon = fc.split_gps("gps_coordinates")
        df = df.withColumns({"latitude": lat, "longitude": lon}).drop("gps_coordinates")
    good, bad = _typed(df, "properties", "property_id", PROPERTY_INTS, _PROPERTY_RULES)
    flags = [c for c in PROPERTY_FLAGS_NOT_NULL if c in good.columns]
    return good.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("tinyint") for c in flags}), bad   # P11


def filled_flags(clean: DataFrame) -> DataFrame:
    """P11 audit: per flag column the rows whose missing or unreadable value
    becomes 0 (column_name, filled)."""
    flags = [c for c in PROPERTY_FLAGS_NOT_NULL if c in clean.columns]
    counts = clean.agg(*[F.count_if(to_int(clean, c).isNull()).alias(c) for c in flags] or [F.lit(0).alias("none")])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled")) for c in flags]
    if not rows:
        return counts.select(F.lit("").alias("column_name"), F.lit(0).cast("bigint").alias("filled")).limit(0)
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def build_mapping(clean: DataFrame) -> tuple[DataFrame, DataFrame]:
    return _typed(clean, "property_id_mapping", "property_id", MAPPING_INTS, {})


def build_reviews(clean: DataFrame) -> tuple[DataFrame, DataFrame]:
    good, bad = _typed(clean, "reviews", "review_id", REVIEW_INTS, _REVIEW_RULES)
    return good.drop(*REVIEW_DROP), bad


def build_aspects(clean: DataFrame) -> tuple[DataFrame, DataFrame]:
    return _typed(clean, "review_aspects", "aspect_id", ASPECT_INTS, _ASPECT_RULES)


# ---- constraints -------------------------------------------------------------
def pk_violations(df: DataFrame, table: str, key: list[str], nulls_allowed: bool = False) -> DataFrame:
    """C1/C2 as one aggregate: rows, distinct keys, surplus rows
    (COUNT(*) - COUNT(DISTINCT key), NULL keys counted as surplus) and rows
    with a NULL key part. For a UNIQUE column that allows NULLs (C2) only
    non-NULL rows count."""
    any_null = F.lit(False)
    for k in key:
        any_null = any_null | F.col(k).isNull()
    src = df.where(~any_null) if nulls_allowed else df
    agg = src.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_distinct(*[F.col(k) for k in key]).alias("distinct_keys"),
                  F.count_if(any_null).alias("null_keys"))
    return agg.select(F.lit(table).alias("table_name"), F.lit(",".join(key)).alias("key_columns"),
                      "rows", "distinct_keys", (F.col("rows") - F.col("distinct_keys")).alias("surplus_rows"),
                      "null_keys")


def length_violations(df: DataFrame, table: str, sizes: dict[str, int]) -> DataFrame:
    """per column the rows longer than the column size, one scan."""
    present = {c: n for c, n in sizes.items() if c in df.columns}
    agg = df.agg(*[F.count_if(ft.length_violation(c, n)).alias(c) for c, n in present.items()],
                 *[F.max(F.length(c)).alias(f"__max_{c}") for c in present])
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(n).alias("max_len"),
                     F.col(c).alias("violations"), F.col(f"__max_{c}").alias("longest"))
            for c, n in present.items()]
    return agg.select(F.explode(F.array(*rows)).alias("r")).select(
        F.lit(table).alias("table_name"), "r.*")


def enforce_table(df: DataFrame, table: str, key: list[str], sizes: dict[str, int] | None = None,
                  nulls_allowed: bool = False) -> None:
    """Build gate for one table (C1 + F12): a single aggregate counts rows,
    distinct and NULL keys and over-long values; any violation raises with
    the counts, so the layer is never published (B8). ``nulls_allowed``
    gives a UNIQUE key (C2): NULL keys are neither violations nor counted."""
    sizes = {c: n for c, n in (sizes or {}).items() if c in df.columns}
    any_null = F.lit(False)
    for k in key:
        any_null = any_null | F.col(k).isNull()
    if nulls_allowed:
        df = df.where(~any_null)
    r = df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(*[F.col(k) for k in key]).alias("keys"),
               F.count_if(any_null).alias("null_keys"),
               *[F.count_if(ft.length_violation(c, n)).alias(f"len_{c}") for c, n in sizes.items()]).first()
    problems = []
    if r["null_keys"]:
        problems.append(f"{r['null_keys']} NULL key(s)")
    if r["rows"] - r["null_keys"] != r["keys"]:
        problems.append(f"{r['rows'] - r['null_keys'] - r['keys']} duplicate key row(s)")
    problems += [f"{r[f'len_{c}']} value(s) longer than {n} in {c}" for c, n in sizes.items() if r[f"len_{c}"]]
    if problems:
        raise ConstraintViolation(f"{table}: " + "; ".join(problems))


def fk_orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key has no parent (NULL keys are not
    orphans, as in SQL foreign keys)."""
    parent_key = parent_key or child_key
    p = parent.select(F.col(parent_key).alias(child_key)).where(F.col(child_key).isNotNull())
    return child.where(F.col(child_key).isNotNull()).join(p, child_key, "left_anti")


def enforce_fk(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None) -> DataFrame:
    """J4 as a build gate: raise when any orphan exists, else return child."""
    if not fk_orphans(child, parent, child_key, parent_key).isEmpty():
        raise ConstraintViolation(f"foreign key {child_key} has orphans")
    return child


def cascade_delete(child: DataFrame, surviving_parents: DataFrame, key: str,
                   parent_key: str | None = None) -> DataFrame:
    """J4 ON DELETE CASCADE: keep children whose parent survives."""
    parent_key = parent_key or key
    return child.join(surviving_parents.select(F.col(parent_key).alias(key)), key, "left_semi")
