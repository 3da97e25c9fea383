"""Shredding documents into a parent table and child tables (P5, P6, W2,
U4, U5, U9, F13).

The discovered schema (P3) is a small table — one row per column — and is
the only thing the driver holds; it turns into one ``select`` per table.
Everything per document is a row-local expression: dedup of a nested list
and its hash are computed inside the row, so shredding needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerflow.operators.schema import field_of, objects_json

CHILD_RESERVED = {"id", "parent_id", "row_hash", "created_at"}
CHILD_PREFIX = "item_"
ITEMS = "__items_"   # + child scope: the deduplicated objects of a list, see with_items
VALUES = "__values"  # the decoded scalars of an object, see with_values


def content_hash(v: Column) -> Column:
    """U4: md5 of canonical JSON (VARIANT renders keys sorted, explicit nulls
    kept, compact separators)."""
    return F.md5(F.to_json(v))


def dedup_objects_json(v: Column) -> Column:
    """U5 inside one row: canonical JSON of the object elements, first
    occurrence kept, list order preserved."""
    return F.array_distinct(objects_json(v))


def items_hash(items: Column) -> Column:
    """:func:`list_hash` of a list whose deduplicated objects are at hand."""
    return F.md5(F.concat(F.lit("["), F.array_join(items, ","), F.lit("]")))


def list_hash(v: Column) -> Column:
    """Hash of the deduplicated list (the ``hash_<field>`` column)."""
    return items_hash(dedup_objects_json(v))


def convert(get: Callable[[str], Column], data_type: str) -> Column:
    """F13 / §1.2: one VARIANT value (``field_of``) to its column type."""
    if data_type == "STRING":
        # objects and lists become their JSON text, strings their value,
        # a JSON null becomes NULL
        return get("string")
    if data_type == "BOOLEAN":
        return get("boolean")
    if data_type == "TIMESTAMP_NTZ":
        return F.coalesce(get("timestamp_ntz"), get("string").try_cast("timestamp_ntz"))
    if data_type == "DATE":
        return F.coalesce(get("date"), get("string").try_cast("date"))
    return get(data_type.lower())


def list_objects(doc: Column, key: str) -> Column:
    """:func:`dedup_objects_json` of the list at ``key``. A list of objects alone
    gives its texts at once; only another list is rebuilt element by element, as
    there a string may look like an object."""
    get = field_of(doc, key)
    only_objects = F.forall(get("array<struct<id:string>>"), lambda e: e.isNotNull())
    return F.array_distinct(F.when(only_objects, get("array<string>")).otherwise(objects_json(get("variant"))))


# Column types that are read from a VARIANT as they are (see convert).
_DIRECT = {"STRING": T.StringType(), "BOOLEAN": T.BooleanType(), "BIGINT": T.LongType(), "DOUBLE": T.DoubleType(),
           "DECIMAL(30,10)": T.DecimalType(30, 10)}


def with_values(df: DataFrame, doc: Column, wanted: list[tuple[str, str]]) -> tuple[DataFrame, Callable[[str, str], Column]]:
    """``df`` with the values of ``wanted`` (source field, type) decoded in one
    pass over each object, and how to read them: a look-up of its own per field
    searches the keys again, and one that finds none is the dearest of all. Keys
    that differ in case alone, and types with a second reading, are looked up."""
    lower = [src.lower() for src, _ in wanted]
    direct = [(src, typ) for src, typ in wanted if typ in _DIRECT and lower.count(src.lower()) == 1]
    if not direct:
        return df, lambda src, typ: convert(field_of(doc, src), typ)
    names = {src for src, _ in direct}
    df = df.withColumn(VALUES, doc.try_cast(T.StructType([T.StructField(src, _DIRECT[typ]) for src, typ in direct])))
    return df, lambda src, typ: F.col(VALUES).getField(src) if src in names else convert(field_of(doc, src), typ)


def with_items(docs: DataFrame, schema_rows: list, doc_col: str = "doc") -> DataFrame:
    """``docs`` with the deduplicated objects (JSON text) of each nested list in a
    further column. Stored with the documents, the lists are decoded once for the
    parent's hashes, the child counts and the child rows."""
    new = {ITEMS + r["child_scope"]: list_objects(F.col(doc_col), r["source_field"])
           for r in schema_rows if r["role"] == "list_hash" and ITEMS + r["child_scope"] not in docs.columns}
    return docs.withColumns(new) if new else docs


def shred_parent(docs: DataFrame, schema_rows: list, doc_col: str = "doc",
                 counters: Observation | None = None, also: tuple[str, ...] = ()) -> DataFrame:
    """P5 + W2: one row per document with a non-NULL id; scalar columns typed
    by the schema, objects and scalar lists as JSON text, each nested list
    replaced by the md5 of its deduplicated objects.

    ``docs`` has (id, doc) and optionally ``_id``; ``schema_rows`` are the
    collected 'parent' rows of :func:`discover_schema`. ``also``: columns to
    pass on as they are (those of :func:`with_items`, too)."""
    doc = F.col(doc_col)
    base = with_items(docs, schema_rows, doc_col).withColumn("__id", field_of(doc, "id")("string"))
    if counters is not None:
        no_id = F.col("__id").isNull()
        is_object = doc.try_cast("map<string, variant>").isNotNull()
        base = base.observe(counters, F.count(F.lit(1)).alias("processed"),
                            F.count_if(F.when(no_id, is_object)).alias("skipped"),
                            F.count_if(F.when(no_id, ~is_object)).alias("failed"))
    # a document that is not an object fails; one without id is skipped
    base = base.where(F.col("__id").isNotNull())
    store_id = F.col("_id").cast("string") if "_id" in docs.columns else F.substring(F.md5(F.col("__id")), 1, 24)
    cols = [F.col("__id").alias("id"), store_id.alias("_id")]
    base, value_of = with_values(base, doc, [(r["source_field"], r["data_type"]) for r in schema_rows
                                             if r["scope"] == "parent" and r["role"] != "list_hash"])
    # only fields that discovery saw as nested lists need the list test
    lists = {r["source_field"]: F.col(ITEMS + r["child_scope"]) for r in schema_rows if r["role"] == "list_hash"}
    for r in sorted((r for r in schema_rows if r["scope"] == "parent"), key=lambda r: r["field"]):
        src, field, typ = r["source_field"], r["field"], r["data_type"]
        items = lists.get(src)
        if r["role"] == "list_hash":
            cols.append(F.when(F.size(items) > 0, items_hash(items)).alias(field))
            continue
        value = value_of(src, typ)
        if items is None:
            cols.append(value.alias(field))
            continue
        # a value that is a list of objects is shredded to the child table
        nested = F.coalesce(F.size(items) > 0, F.lit(False))
        cols.append(F.when(~nested, value).alias(field))
    return base.select(*cols, *also)


def child_columns(schema_rows: list, scope: str) -> list[tuple[str, str, str]]:
    """(source key, column name, type) for one child table; generated names
    that clash with the table's own columns get the ``item_`` prefix (B15)."""
    out = []
    for r in sorted((r for r in schema_rows if r["scope"] == scope), key=lambda r: r["field"]):
        name = r["field"]
        if name in CHILD_RESERVED:
            name = CHILD_PREFIX + name
        out.append((r["source_field"], name, r["data_type"]))
    return out


def _lists(docs: DataFrame, scope: str, source_field: str, doc_col: str) -> DataFrame:
    """(parent_id, items) of the documents with an id."""
    doc = F.col(doc_col)
    stored = ITEMS + scope in docs.columns
    items = F.col(ITEMS + scope) if stored else list_objects(doc, source_field)
    return docs.select(field_of(doc, "id")("string").alias("parent_id"), items.alias("items")).where(F.col("parent_id").isNotNull())


def child_counts(docs: DataFrame, scope: str, source_field: str, doc_col: str = "doc") -> DataFrame:
    """(__pid, __n): the child rows that each partition of ``docs`` yields,
    without building them."""
    return _lists(docs, scope, source_field, doc_col).select(F.spark_partition_id().alias("__pid"), F.size("items").alias("n")) \
        .groupBy("__pid").agg(F.coalesce(F.sum(F.greatest("n", F.lit(0))), F.lit(0)).alias("__n"))


def shred_children(docs: DataFrame, schema_rows: list, scope: str, source_field: str,
                   doc_col: str = "doc", loaded_at=None) -> DataFrame:
    """P6 + U5: one row per distinct object of the nested list, first
    occurrence kept, with (parent_id, pos, row_hash, created_at, columns)."""
    return child_rows(list_items(_lists(docs, scope, source_field, doc_col)), schema_rows, scope, loaded_at)


def list_items(lists: DataFrame) -> DataFrame:
    """(parent_id, items) -> (parent_id, pos, item_json), the child rows before
    they are decoded."""
    return lists.select("parent_id", F.posexplode("items").alias("pos", "item_json"))


def child_rows(items: DataFrame, schema_rows: list, scope: str, loaded_at=None) -> DataFrame:
    """The child rows of ``items`` (parent_id, pos, item_json and further
    columns, which are passed on)."""
    cols = [F.col("parent_id"), F.col("pos"), F.md5(F.col("item_json")).alias("row_hash"),
            (F.lit(loaded_at) if loaded_at is not None else F.lit(None)).cast("timestamp_ntz").alias("created_at")]
    for src, name, typ in child_columns(schema_rows, scope):
        cols.append(convert(field_of(F.col("__item"), src), typ).alias(name))
    also = [c for c in items.columns if c not in ("parent_id", "pos", "item_json")]
    return items.withColumn("__item", F.parse_json("item_json")).select(*cols, *also)


def dedup_child_rows(children: DataFrame, parent_col: str, content_cols: list[str],
                     order_cols: list[str]) -> DataFrame:
    """U5 on child rows that are already rows (no list in hand): one row per
    (parent, content hash), keeping the first by ``order_cols``. A partial
    aggregate keyed on (parent, row_hash): a hot parent spreads over its
    distinct items and repeats collapse map-side, so no parent's children
    are ever gathered in one place."""
    obj = F.parse_json(F.to_json(F.struct(*content_cols)))
    keyed = children.select(F.col(parent_col).cast("string").alias("parent_id"),
                            content_hash(obj).alias("row_hash"),
                            F.struct(*order_cols).alias("__o"), F.struct(*content_cols).alias("__c"))
    first = keyed.groupBy("parent_id", "row_hash").agg(F.min_by("__c", "__o").alias("__c"))
    return first.select("parent_id", "row_hash", "__c.*")
