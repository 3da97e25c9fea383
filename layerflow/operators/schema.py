"""Schema discovery over documents (P3, G5, W1) and drift.

Each document value is ranked by its VARIANT type; the merged type of a
field is the highest rank seen, which makes the merge an order-free
``max`` — a partial (map-side) aggregate, so discovery is one shuffle of at
most (partitions x distinct fields) rows however many documents there are.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerflow.functions.names import sanitize_identifier_col
from layerflow.session import cut_lineage

# The widening order of the reference type lattice.
RANK = {"BOOLEAN": 1, "BIGINT": 2, "DOUBLE": 3, "DECIMAL(30,10)": 4, "DATE": 5,
        "TIMESTAMP_NTZ": 6, "STRING": 99}
HASH_PREFIX = "__hash_"
SKIP_FIELDS = ["id", "_id"]
_PLAIN_KEY = re.compile(r"[A-Za-z0-9_]+")


def variant_kind(v: Column, null_widens: bool = True, s: Column | None = None) -> Column:
    """Lattice type name of one VARIANT value (NULL = no vote). Pass ``s`` =
    an already computed ``schema_of_variant(v)`` column to evaluate it once."""
    s = F.schema_of_variant(v) if s is None else s
    return (
        F.when(v.isNull(), F.lit(None))
        .when(s == "VOID", F.lit("STRING") if null_widens else F.lit(None))
        .when(s == "BOOLEAN", F.lit("BOOLEAN"))
        .when(s.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), F.lit("BIGINT"))
        # a JSON number with a point or exponent is a float; parse_json keeps
        # it as DECIMAL (trailing zeros stripped, so 23.0 is DECIMAL(2,0))
        .when(s.startswith("DECIMAL") | s.isin("DOUBLE", "FLOAT"), F.lit("DOUBLE"))
        .when(s == "DATE", F.lit("DATE"))
        .when(s.startswith("TIMESTAMP"), F.lit("TIMESTAMP_NTZ"))
        .otherwise(F.lit("STRING")))


def rank_of(kind: Column) -> Column:
    expr = F.lit(99)
    for name, r in RANK.items():
        expr = F.when(kind == name, F.lit(r)).otherwise(expr)
    return expr


def kind_of(rank: Column) -> Column:
    """Inverse of :func:`rank_of` (ranks are one-to-one with types)."""
    expr = F.lit("STRING")
    for name, r in RANK.items():
        expr = F.when(rank == r, F.lit(name)).otherwise(expr)
    return expr


def has_objects(v: Column, s: Column) -> Column:
    """Whether a value of type ``s`` (``schema_of_variant``) is a list with an
    object in it. W1 keeps mixed lists, whose common element type is VARIANT:
    there every element that is no object becomes NULL in the cast. No lambda,
    which would take the rows out of generated code."""
    mixed = F.array_max(v.try_cast("array<struct<id:string>>")).isNotNull()
    return s.startswith("ARRAY<OBJECT<") | (s.startswith("ARRAY<VARIANT") & mixed)


def field_of(doc: Column, key: str) -> Callable[[str], Column]:
    """The value of ``key`` in a VARIANT object as a given type (NULL where there
    is none). Only that value is decoded; a key that no path can name is looked
    up in the map of all values."""
    if _PLAIN_KEY.fullmatch(key):
        return lambda data_type: F.try_variant_get(doc, f"$.{key}", data_type)
    return F.element_at(doc.try_cast("map<string, variant>"), F.lit(key)).try_cast


def objects_json(v: Column) -> Column:
    """JSON text of the object elements: in JSON only an object starts with a brace."""
    return F.filter(F.transform(v.try_cast("array<variant>"), lambda e: F.to_json(e)), lambda j: j.startswith("{"))


def _exploded(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """(keep..., pos, key, value) of each variant's object fields or list
    elements (key NULL), by a generator inside generated code."""
    fields = df.sparkSession.tvf.variant_explode(F.col(column).outer())
    return df.lateralJoin(fields).select(*keep, "key", "value")


def _votes(values: DataFrame, scope: Column, nested: Column, null_widens: bool) -> DataFrame:
    """The highest rank per field. The types met are made distinct first (map
    side, a hash aggregate), so kinds are told once per type and not per value;
    of a list or an object only that it is one is kept."""
    shape = F.when(F.col("value").isNotNull(), F.substring_index("sv", "<", 1))
    met = values.select(scope.alias("scope"), F.col("key").alias("source_field"), nested.alias("nested"), shape.alias("shape")).distinct()
    kind = F.when(F.col("nested"), F.lit("STRING")).otherwise(variant_kind(F.col("shape"), null_widens, F.col("shape")))
    return (met.select("scope", "source_field", F.when(F.col("nested"), F.lit("list_hash")).otherwise(F.lit("value")).alias("role"), kind.alias("kind"))
            .where(F.col("kind").isNotNull())
            .groupBy("scope", "source_field", "role").agg(F.max(rank_of(F.col("kind"))).alias("rank")))


def discover_schema(docs: DataFrame, doc_col: str = "doc", null_widens: bool = True) -> DataFrame:
    """P3. Returns (scope, field, source_field, role, data_type, rank,
    child_scope, name_collision): scope 'parent' for top-level columns (a
    nested list contributes a ``hash_<field>`` STRING column whose
    ``child_scope`` names its table), scope '<field>' for the columns of the
    child table of each nested list. Every document counts: there is no sample
    limit (O3), as a column that only later documents have would be lost.

    Two passes: one over the top-level values, whose votes are stored and name
    the nested lists, and one over those lists; only keys and types travel, values
    stay where they are."""
    top = _exploded(docs.select(F.col(doc_col).alias("doc")), "doc") \
        .where(F.col("key").isNotNull() & ~F.col("key").isin(SKIP_FIELDS)).withColumn("sv", F.schema_of_variant("value"))
    top = top.withColumn("nested", has_objects(F.col("value"), F.col("sv")))
    parents = cut_lineage(_votes(top, F.lit("parent"), F.col("nested"), null_widens))
    names = [r["source_field"] for r in parents.where(F.col("role") == "list_hash").select("source_field").collect()]
    votes = parents
    if names:
        # only the lists are looked up, the other values of a document stay packed
        found = F.array(*[F.struct(F.lit(n).alias("list"), field_of(F.col(doc_col), n)("variant").alias("items")) for n in names])
        lists = docs.select(F.explode(found).alias("found")).select("found.*").where(F.col("items").isNotNull())
        # the fields of a value that is an object itself have keys and are no elements
        elements = _exploded(lists, "items", "list").where(F.col("key").isNull()).select("list", F.col("value").alias("element"))
        fields = _exploded(elements, "element", "list").where(F.col("key").isNotNull()).withColumn("sv", F.schema_of_variant("value"))
        votes = parents.unionByName(_votes(fields, F.col("list"), F.lit(False), null_widens))
    named = votes.select(
        F.when(F.col("scope") == "parent", F.lit("parent")).otherwise(sanitize_identifier_col("scope")).alias("scope"),
        F.when(F.col("role") == "list_hash",
               sanitize_identifier_col(F.concat(F.lit(HASH_PREFIX), sanitize_identifier_col("source_field"))))
        .otherwise(sanitize_identifier_col("source_field")).alias("field"),
        "source_field", "role", "rank")
    return _merged(named.withColumn("source_field_max", F.col("source_field")))


def _merged(votes: DataFrame) -> DataFrame:
    """The votes of one column as one: the highest rank."""
    merged = (votes.groupBy("scope", "field")
              .agg(F.max("rank").alias("rank"),
                   F.min("source_field").alias("source_field"),
                   F.max("source_field_max").alias("source_field_max"),
                   F.max("role").alias("role")))
    return merged.select("scope", "field", "source_field", "role",
                         kind_of(F.col("rank")).alias("data_type"), "rank",
                         F.when(F.col("role") == "list_hash", sanitize_identifier_col("source_field")).alias("child_scope"),
                         (F.col("source_field") != F.col("source_field_max")).alias("name_collision"))


def merge_schemas(old: DataFrame, new: DataFrame) -> DataFrame:
    """P3 by parts: the schema of two sets of documents from the schemas of
    both (per field the lattice maximum, which is order-free), so a stored
    schema is brought up to date by the votes of new documents alone."""
    def votes(df: DataFrame) -> DataFrame:
        # a collision that one side knows of stays known
        return df.select("scope", "field", "rank", "source_field", "role",
                         F.when(F.col("name_collision"), F.concat("source_field", F.lit("\uffff"))).otherwise(F.col("source_field")).alias("source_field_max"))

    return _merged(votes(old).unionByName(votes(new)))


def schema_drift(old_schema: DataFrame, new_schema: DataFrame) -> DataFrame:
    """Columns the new discovery adds, and columns whose merged type
    widened. Existing types are never narrowed (additive evolution)."""
    o = old_schema.select("scope", "field", F.col("data_type").alias("old_type"), F.col("rank").alias("old_rank"))
    n = new_schema.select("scope", "field", F.col("data_type").alias("new_type"), F.col("rank").alias("new_rank"))
    j = n.join(o, ["scope", "field"], "left")
    return j.where(F.col("old_type").isNull() | (F.col("new_rank") > F.col("old_rank"))).select(
        "scope", "field", "old_type", "new_type",
        F.when(F.col("old_type").isNull(), F.lit("added")).otherwise(F.lit("widened")).alias("change"))


def check_name_collisions(schema_rows: list) -> None:
    """Two source names that sanitise to one column are an error."""
    for r in schema_rows:
        if r["name_collision"]:
            raise ValueError(f"several source fields map to column {r['field']!r} "
                             f"(e.g. {r['source_field']!r})")
