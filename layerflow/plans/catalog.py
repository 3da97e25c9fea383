"""Registered queries: one per operator family of SURVEY §2, each run over
the driver's whole tables (SURVEY §7.4 stand-ins). Every callable takes
(spark, sf_dir) and returns a DataFrame; ``layerflow.plans.oracle`` holds
the DuckDB SQL that computes the same answer straight from the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from layerflow.functions import clean as fc
from layerflow.functions import names as fn
from layerflow.functions import typing as ft
from layerflow.operators import clean as oc
from layerflow.operators import relational as orl
from layerflow.operators import schema as osch
from layerflow.operators import shred as osh
from layerflow.operators import upsert as ou
from layerflow.operators import checks as ock
from layerflow.operators import star
from layerflow.operators.keys import dense_ids
from layerflow.plans import reviews as R
from layerflow.session import cut_lineage, shared_dir
from layerflow.sources import csv as scsv
from layerflow.sources import layers as sl
from layerflow.sources import pages as sp

read = R.read

# Fixed stand-in parameters (shared with the oracle SQL).
UPSERT_SPLIT_TS = "2024-01-15 00:00:00"
ORDER_GAP_MOD = 13          # orders removed to create true orphans
NEW_PARENT_OFFSET = 1000000000
SHIFT_OFFSET = 1000000


# ---- shared model --------------------------------------------------------------
_MODELS: dict = {}


def _session_key(spark: SparkSession) -> str:
    # unique per SparkContext, unlike id(), which a new session may reuse
    return spark.sparkContext.applicationId


def model(spark: SparkSession, sf_dir: str) -> R.Model:
    key = (_session_key(spark), sf_dir)
    if key not in _MODELS:
        _MODELS[key] = R.build_model(spark, sf_dir)
    return _MODELS[key]


def star_tables(spark: SparkSession, sf_dir: str) -> dict:
    key = (_session_key(spark), sf_dir, "star")
    if key not in _MODELS:
        _MODELS[key] = R.star_schema(model(spark, sf_dir))
    return _MODELS[key]


def documents(spark: SparkSession, sf_dir: str) -> tuple:
    """The stored review documents in id order and their discovered schema: the
    inputs of the shredding queries."""
    key = (_session_key(spark), sf_dir, "documents")
    if key not in _MODELS:
        _MODELS[key] = R.ordered_documents(R.review_documents(spark, sf_dir))
    return _MODELS[key]


# ---- S1-S3: pages ------------------------------------------------------------------
TURNS_PER_PAGE = 100
PAGE_STRIDE = 10000   # page number = conv_id * PAGE_STRIDE + chunk


def conversation_pages(spark: SparkSession, sf_dir: str, with_faults: bool = False) -> DataFrame:
    """Page envelopes of at most TURNS_PER_PAGE turns of one conversation,
    in turn order (a page is bounded, however long a conversation is). With
    faults, some pages are broken and some elements invalid, by fixed rules
    on the conversation id."""
    c = read(spark, sf_dir, "conversations")
    el = F.struct(F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("id"),
                  "conv_id", "turn", "role", "text")
    el_json = F.to_json(el)
    if with_faults:
        no_id = F.to_json(F.struct("conv_id", "turn", "role", "text"))
        el_json = (F.when((F.col("role") == "assistant") & (F.col("turn") % 2 == 1), F.col("turn").cast("string"))
                   .when(F.col("turn") % 3 == 2, no_id).otherwise(el_json))
    page_no = F.col("conv_id") * PAGE_STRIDE + (F.col("turn") / TURNS_PER_PAGE).cast("bigint")
    pages = c.groupBy(page_no.alias("page")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", el_json.alias("j")))),
                                 lambda e: e["j"]), ",").alias("items"))
    payload = F.concat(F.lit('{"data":['), F.col("items"), F.lit('],"_links":{"next":null}}'))
    if with_faults:
        p = (F.col("page") / PAGE_STRIDE).cast("bigint")
        payload = (F.when(p % 10 == 0, F.lit('{"data": ['))
                   .when(p % 10 == 1, F.lit('{"items": []}'))
                   .when(p % 10 == 2, F.lit('{"data": {"id": "x"}}'))
                   .otherwise(payload))
    return pages.select("page", F.concat(F.lit("page-"), F.col("page").cast("string")).alias("source"),
                        payload.alias("payload"))


def q_pages_explode(spark, sf_dir):
    split = sp.split_pages(conversation_pages(spark, sf_dir))
    e = split.elements
    return e.select(F.col("page").cast("bigint").alias("page"), F.col("pos").cast("bigint").alias("pos"), "id",
                    F.expr("variant_get(doc, '$.role', 'string')").alias("role"),
                    F.expr("variant_get(doc, '$.text', 'string')").alias("text"))


def q_pages_quarantine(spark, sf_dir):
    split = sp.split_pages(conversation_pages(spark, sf_dir, with_faults=True))
    q = split.quarantine.select(F.col("page").cast("bigint").alias("page"), "reason",
                                F.lit(1).cast("bigint").alias("dropped"),
                                F.length("payload").cast("bigint").alias("stored_chars"))
    r = split.rejects.select(F.col("page").cast("bigint").alias("page"), "reason",
                             F.col("dropped").cast("bigint").alias("dropped"),
                             F.lit(None).cast("bigint").alias("stored_chars"))
    return q.unionByName(r)


# ---- S4/W3/U8: incremental scan ---------------------------------------------------
def q_incremental_scan(spark, sf_dir):
    """A first run commits the orders up to half the key range and stops
    (its resume point is kept); the next run resumes after that key, loads
    the rest and completes, clearing the resume point. All rows come back,
    each with the run that loaded it."""
    store = sl.LayerStore(spark, shared_dir(spark, "incremental_scan"))
    orders = read(spark, sf_dir, "orders")
    half = orders.agg((F.max("o_orderkey") / 2).cast("bigint")).first()[0]
    first = orders.where(F.col("o_orderkey") <= F.lit(half))
    store.commit_increment("raw", "orders", first, "o_orderkey", done=False)      # run 1 stops here
    hwm = store.high_water_mark("raw", "orders")
    rest = sl.scan_after(spark.read.parquet(f"{sf_dir}/orders.parquet"), "o_orderkey", hwm)
    store.commit_increment("raw", "orders", rest, "o_orderkey", done=True)        # run 2 resumes
    assert store.high_water_mark("raw", "orders") is None
    return store.increments("raw", "orders", "load_run")


def q_increment_passes(spark, sf_dir):
    """Each year is a pass of two runs over the orders of its customers: a
    customer's orders of a later year replace those of earlier ones, and parts
    are folded on the way. The orders of each customer's last year, each with
    the run that loaded it."""
    store = sl.LayerStore(spark, shared_dir(spark, "increment_passes"))
    orders = read(spark, sf_dir, "orders")
    year = F.year("o_orderdate")
    first, last, middle = orders.agg(F.min(year), F.max(year), (F.max("o_custkey") / 2).cast("bigint")).first()
    for n in range(first, last + 1):
        own = orders.where(year == n)
        store.commit_increment("raw", "orders", own.where(F.col("o_custkey") <= F.lit(middle)), "o_custkey", done=False)
        store.commit_increment("raw", "orders", own.where(F.col("o_custkey") > F.lit(middle)), "o_custkey", done=True)
    return store.increments("raw", "orders", "load_run")


# ---- S10: one commit over layers ---------------------------------------------------
def q_run_commit(spark, sf_dir):
    """Two runs each publish the orders of a period (layer raw) and the totals
    by customer computed from them (layer rel) in one commit. A reader pinned
    between the runs and one of the newest commit each compare the two layers:
    per customer, the orders and value in raw and those in rel."""
    store = sl.LayerStore(spark, shared_dir(spark, "run_commit"))
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    readers = {}
    for name, rows in (("pinned", orders.where("o_orderkey % 2 = 0")), ("newest", orders)):
        raw = store.build_aside("raw", {"orders": rows})
        totals = spark.read.parquet(raw["orders"]).groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum("price").alias("value"))
        store.publish_together({"raw": (raw, None), "rel": (store.build_aside("rel", {"totals": totals}), None)})
        readers[name] = store.pinned() if name == "pinned" else store
    out = None
    for name, reader in readers.items():
        raw = reader.table("raw", "orders").groupBy("o_custkey").agg(F.count("*").alias("raw_n"), F.sum("price").alias("raw_value"))
        rows = raw.join(reader.table("rel", "totals"), "o_custkey", "full_outer") \
            .select(F.lit(name).alias("reader"), F.col("o_custkey").alias("custkey"), "raw_n", F.col("n").alias("rel_n"),
                    F.col("raw_value").cast("double").alias("raw_value"), F.col("value").cast("double").alias("rel_value"))
        out = rows if out is None else out.unionByName(rows)
    return out


# ---- S5-S7, P2: CSV -----------------------------------------------------------------
CSV_HEADER = ["N NationKey", "N-Name", "Região.Nome", "n_name", "Note"]


def q_csv_all_string(spark, sf_dir):
    n = read(spark, sf_dir, "nation")
    r = read(spark, sf_dir, "region")
    rows = n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_nationkey").cast("string").alias("c0"),
        F.when(F.col("n_nationkey") % 7 == 0, F.lit("NA")).otherwise(F.col("n_name")).alias("c1"),
        F.col("r_name").alias("c2"), F.lower("n_name").alias("c3"),
        F.concat(F.col("n_name"), F.lit("\n"), F.col("r_name")).alias("c4")).toDF(*CSV_HEADER)
    path = shared_dir(spark, "csv_all_string")
    scsv.write_csv(rows, path)
    return scsv.read_csv_all_string(spark, path, expected_columns=["n_nationkey", "n_name"])


# ---- S8-S10, D7: layer store ----------------------------------------------------------
def q_refresh_counts(spark, sf_dir):
    store = sl.LayerStore(spark, shared_dir(spark, "refresh_counts"))
    res = [store.write_version("raw", t, read(spark, sf_dir, t)) for t in ("part", "supplier")]
    return spark.createDataFrame([(r.table, r.rows_observed, r.rows_stored) for r in res],
                                 "table_name string, rows_read bigint, rows_stored bigint")


def q_guarded_load(spark, sf_dir):
    store = sl.LayerStore(spark, shared_dir(spark, "guarded_load"))
    part = read(spark, sf_dir, "part")
    store.guarded_load("clean", "part", part, min_rows=1)
    try:   # a load below its floor is refused and leaves the live table alone
        store.guarded_load("clean", "part", part.where(F.lit(False)), min_rows=1)
    except sl.LoadGuardError:
        pass
    return store.table("clean", "part")


def q_publish_roundtrip(spark, sf_dir):
    store = sl.LayerStore(spark, shared_dir(spark, "publish_roundtrip"))
    sup = read(spark, sf_dir, "supplier")
    store.build_and_publish("rel", {"supplier": sup, "part": read(spark, sf_dir, "part")})

    def broken():
        raise RuntimeError("build failed")
    try:   # a failing build leaves every live table untouched
        store.build_and_publish("rel", {"supplier": sup.where(F.col("s_suppkey") % 2 == 0), "part": broken})
    except RuntimeError:
        pass
    tables = {"supplier": ("s_suppkey", "s_name"), "part": ("p_partkey", "p_name")}
    out = [store.table("rel", t).select(F.lit(t).alias("table_name"), F.col(k).cast("bigint").alias("key"), F.col(n).alias("name"))
           for t, (k, n) in tables.items()]
    return out[0].unionByName(out[1])


# ---- S12: dead letter -------------------------------------------------------------
def q_dead_letter(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey") + F.col("l_linenumber")
    qty = (F.when(k % 9 == 0, F.concat(F.col("l_quantity").cast("bigint").cast("string"), F.lit(".5")))
           .when(k % 9 == 1, F.lit("inf")).when(k % 9 == 2, F.lit("n/a"))
           .otherwise(F.col("l_quantity").cast("bigint").cast("string")))
    rows = li.select(F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
                     .alias("row_key"), qty.alias("l_quantity"))
    _, bad = orl.split_errors(rows, "lineitem", "row_key", orl.int_errors(rows, {"l_quantity": "bigint"}))
    return bad.select("key", "error")


def faulty_tables(spark, sf_dir) -> dict[str, DataFrame]:
    """The four tables before typing, as text, with values that no integer
    column holds: fractions, infinities, numbers out of range, words."""
    c, o, li = (read(spark, sf_dir, t) for t in ("customer", "orders", "lineitem"))
    k = F.col("c_custkey")
    text = k.cast("string")
    props = c.select(F.when(k % 20 == 3, F.concat(text, F.lit(".5"))).otherwise(text).alias("property_id"),
                     F.when(k % 20 == 7, F.lit("3000000000")).otherwise(F.lit("4")).alias("max_occupancy"), "c_mktsegment")
    ext = (k + R.EXTERNAL_ID_OFFSET).cast("string")
    mapping = c.select(F.when(k % 30 == 2, F.lit("1e30")).otherwise(text).alias(oc.MAPPING_COLUMNS[0]),
                       F.when(k % 30 == 1, F.lit("abc")).otherwise(ext).alias(oc.MAPPING_COLUMNS[1]))
    r = F.col("o_orderkey")
    booking = F.when(r % 25 == 4, F.lit("12.5")).when(r % 25 == 5, F.lit("-inf")).when(r % 25 == 6, F.lit("99999999999999999999")) \
        .otherwise(r.cast("string"))
    reviews = o.select(r.cast("string").alias("review_id"), booking.alias("booking_id"), F.col("o_custkey").alias("external_property_id"))
    a = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    aspects = li.select(F.when(a % 40 == 0, F.lit("1.5")).otherwise(a.cast("string")).alias("aspect_id"),
                        F.col("l_orderkey").cast("string").alias("review_id"), (F.col("l_quantity") / 5).alias("score"))
    return {"properties": props, "property_id_mapping": mapping, "reviews": reviews, "review_aspects": aspects}


def q_dead_letter_all(spark, sf_dir):
    """S12 over all four tables: of each the rows stored and the rows of the
    dead letter by error; together they are the rows that went in."""
    t = faulty_tables(spark, sf_dir)
    mapping, bad = orl.split_errors(t["property_id_mapping"], "property_id_mapping", oc.MAPPING_COLUMNS[0],
                                    oc.mapping_errors(t["property_id_mapping"]))
    built = {"properties": orl.build_properties(t["properties"]), "property_id_mapping": orl.build_mapping(oc.clean_mapping(mapping)),
             "reviews": orl.build_reviews(t["reviews"]), "review_aspects": orl.build_aspects(t["review_aspects"])}
    rows = bad.select("table_name", F.col("error").alias("outcome"))
    for table, (good, letter) in built.items():
        rows = rows.unionByName(letter.select("table_name", F.col("error").alias("outcome"))) \
            .unionByName(good.select(F.lit(table).alias("table_name"), F.lit("stored").alias("outcome")))
    return rows.groupBy("table_name", "outcome").agg(F.count(F.lit(1)).alias("n"))


# ---- P1: names --------------------------------------------------------------------------
def q_sanitize_names(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    src = F.concat(F.col("p_name"), F.lit(" "), F.col("p_type"), F.lit("."), F.repeat(F.lit("-x"), F.col("p_size")))
    return p.select("p_partkey", src.alias("source_name"), fn.sanitize_identifier_col(src).alias("column_name"))


# ---- P3/P4: schema ---------------------------------------------------------------------
def _json_docs(df: DataFrame, key: str) -> DataFrame:
    j = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.select(F.col(key).cast("string").alias("id"), F.parse_json(j).alias("doc"))


def q_infer_types(spark, sf_dir):
    docs = _json_docs(read(spark, sf_dir, "orders"), "o_orderkey").unionByName(
        _json_docs(read(spark, sf_dir, "events"), "event_id")).unionByName(_line_docs(read(spark, sf_dir, "lineitem")))
    return osch.discover_schema(docs).select("scope", "field", "data_type")


def q_schema_drift(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    old = osch.discover_schema(_json_docs(o, "o_orderkey"))
    new_docs = _json_docs(o, "o_orderkey").unionByName(_json_docs(read(spark, sf_dir, "events"), "event_id")) \
        .unionByName(_widened_docs(o)).unionByName(_line_docs(read(spark, sf_dir, "lineitem")))
    new = osch.discover_schema(new_docs)
    return osch.schema_drift(old, new).select("scope", "field", "old_type", "new_type", "change")


def _widened_docs(o: DataFrame) -> DataFrame:
    """Orders whose key is a multiple of 100 carry the customer key as text."""
    w = o.where(F.col("o_orderkey") % 100 == 0).select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("o_custkey"))
    return _json_docs(w, "o_orderkey")


# ---- P5/P6/W2/U9: shredding ------------------------------------------------------------
def q_shred_parent(spark, sf_dir):
    return osh.shred_parent(*documents(spark, sf_dir))


def q_shred_children(spark, sf_dir):
    docs, rows = documents(spark, sf_dir)
    children = osh.shred_children(docs, rows, "evaluationaspects", "evaluationAspects", loaded_at=R.LOADED_AT)
    return dense_ids(children, ["parent_id", "pos"], "id", presorted=True, counts=osh.child_counts(docs, "evaluationaspects", "evaluationAspects")) \
        .select("id", "parent_id", "row_hash", "created_at", "evaluationaspect", "valoration")


def q_shred_counts(spark, sf_dir):
    docs = R.review_documents(spark, sf_dir)
    o = read(spark, sf_dir, "orders").where(F.col("o_orderkey") % 50 == 0)
    nulls = o.select(F.lit(None).cast("string").alias("id"),
                     F.parse_json(F.concat(F.lit('{"id":null,"bookingId":'), F.col("o_orderkey").cast("string"),
                                           F.lit("}"))).alias("doc"))
    alld = docs.unionByName(nulls)
    rows = osch.discover_schema(docs).collect()
    obs = Observation("shred_counts")
    parents = osh.shred_parent(alld, rows, counters=obs).count()
    got = obs.get
    return spark.createDataFrame([(int(got["processed"]), int(got["skipped"]), int(parents))],
                                 "processed bigint, skipped bigint, parents bigint")


# ---- P7-P9: clean -------------------------------------------------------------------------
def q_rename_clean(spark, sf_dir):
    return oc.clean_reviews(model(spark, sf_dir).raw["reviews"])


def q_first_present(spark, sf_dir):
    return oc.clean_aspects(model(spark, sf_dir).raw["reviews_evaluationaspects"])


# ---- U1-U3: upserts ----------------------------------------------------------------------
def _event_doc_text() -> "F.Column":
    """``{"id": "<user>", "<event_type>": <value>}`` as JSON text (explicit
    nulls kept)."""
    return F.concat(F.lit('{"id":"'), F.col("user_id").cast("string"), F.lit('",'),
                    F.regexp_replace(F.to_json(F.struct(F.col("event_type").alias("k"))), r'^\{"k":(.*)\}$', "$1"),
                    F.lit(":"), F.coalesce(F.col("value").cast("string"), F.lit("null")), F.lit("}"))


def _event_fields(spark, sf_dir, where=None):
    ev = read(spark, sf_dir, "events")
    if where is not None:
        ev = ev.where(where)
    docs = ev.select(F.col("user_id").cast("string").alias("id"), F.parse_json(_event_doc_text()).alias("doc"),
                     F.struct("ts", "event_id").alias("seq"))
    return ou.document_fields(docs, "seq")


def q_field_upsert(spark, sf_dir):
    state = ou.field_upsert(None, _event_fields(spark, sf_dir))
    return state.where(F.col("field") != "id").select(
        "id", "field", F.parse_json("value_json").try_cast("double").alias("value"))


def q_upsert_metrics(spark, sf_dir):
    split = F.lit(UPSERT_SPLIT_TS).cast("timestamp_ntz")
    before = ou.field_upsert(None, _event_fields(spark, sf_dir, F.col("ts") < split))
    after = ou.field_upsert(before, _event_fields(spark, sf_dir, F.col("ts") >= split))
    return ou.upsert_metrics(before, after)


def q_row_upsert(spark, sf_dir):
    ev = read(spark, sf_dir, "events")
    split = F.lit(UPSERT_SPLIT_TS).cast("timestamp_ntz")

    def latest(df, cols):
        return df.groupBy("user_id").agg(F.max_by(F.struct(*cols), F.struct("ts", "event_id")).alias("r")) \
            .select("user_id", "r.*")
    target = latest(ev.where(F.col("ts") < split), ["event_type", "value", "ts"])
    updates = ev.where(F.col("ts") >= split).select("user_id", "value", "ts", "event_id")
    updates = updates.withColumn("seq", F.struct("ts", "event_id")).drop("event_id")
    return ou.row_upsert(target, updates.select("user_id", "value", "ts", "seq"), ["user_id"], seq="seq") \
        .select("user_id", "event_type", "value", "ts")


EVENTS_PER_PAGE = 100


def q_page_stream_upsert(spark, sf_dir):
    """Events delivered as page files (100 events per page, in id
    order) in three instalments -> one Structured Streaming query, a
    micro-batch each -> field-level upsert."""
    from layerflow.streaming.pages import run_page_upsert
    pages = event_pages(read(spark, sf_dir, "events"))
    bounds = pages.agg(F.min("page"), F.max("page")).first()
    third = ((bounds[1] or 0) - (bounds[0] or 0)) // 3 + 1
    root = shared_dir(spark, "page_stream_upsert")
    store = sl.LayerStore(spark, f"{root}/store")
    for part in range(3):
        pages.where(F.floor((F.col("page") - F.lit(bounds[0] or 0)) / third) == part).select("value").write.mode("append").text(f"{root}/pages")
        run_page_upsert(spark, f"{root}/pages", store, "docs", "reviews", f"{root}/checkpoint").awaitTermination()
    return _state_values(store.table("docs", "reviews"))


def event_pages(ev: DataFrame) -> DataFrame:
    """(page, value): envelopes of EVENTS_PER_PAGE events in id order."""
    page = (F.col("event_id") / EVENTS_PER_PAGE).cast("bigint")
    pages = ev.groupBy(page.alias("page")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", _event_doc_text().alias("j")))),
                                 lambda e: e["j"]), ",").alias("items"))
    return pages.select("page", F.concat(F.lit('{"page":'), F.col("page").cast("string"), F.lit(',"data":['),
                                         F.col("items"), F.lit("]}")).alias("value"))


def _state_values(state: DataFrame) -> DataFrame:
    return state.where(F.col("field") != "id").select(
        "id", "field", F.parse_json("value_json").try_cast("double").alias("value"))


def q_two_day_upsert(spark, sf_dir):
    """U1 over two runs: the events before UPSERT_SPLIT_TS and those after it
    come as two days' pages, the second day's numbered from the front again;
    another table of the layer is published between. The second day wins."""
    from layerflow.streaming.pages import upsert_batch
    ev = read(spark, sf_dir, "events")
    split = F.lit(UPSERT_SPLIT_TS).cast("timestamp_ntz")
    store = sl.LayerStore(spark, shared_dir(spark, "two_day_upsert"))
    last = ev.agg(F.max("event_id")).first()[0] or 0
    for day, events in enumerate((ev.where(F.col("ts") < split), ev.where(F.col("ts") >= split))):
        # the first day has the high page numbers
        pages = event_pages(events).select((F.col("page") + (0 if day else last)).alias("page"),
                                           F.lit(f"day-{day}").alias("source"), F.col("value").alias("payload"))
        upsert_batch(store, "docs", "reviews", pages)
        store.guarded_load("docs", "other", spark.range(3).toDF("x"))
    return _state_values(store.table("docs", "reviews"))


# ---- U4/U5: hashing and child dedup ------------------------------------------------------
def q_content_hash(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    obj = F.parse_json(F.to_json(F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus")))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", osh.content_hash(obj).alias("row_hash"))


def q_child_dedup(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    content = ["l_linenumber", "l_returnflag", "l_linestatus"]
    return osh.dedup_child_rows(li, "l_orderkey", content, content + ["l_partkey"]).select(
        "parent_id", *content)


# ---- U6/J6: change detection ---------------------------------------------------------
def _line_docs(li: DataFrame) -> DataFrame:
    g = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(
        F.col("l_linenumber").alias("n"), F.col("l_returnflag").alias("f"), F.col("l_quantity").alias("q"),
        F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s")))).alias("ls"))
    return g.select(F.col("l_orderkey").cast("string").alias("id"),
                    F.parse_json(F.to_json(F.struct(F.col("l_orderkey").cast("string").alias("id"),
                                                    F.col("ls").alias("lines")))).alias("doc"))


def _changed_lines(li: DataFrame) -> DataFrame:
    k = F.col("l_orderkey")
    return li.withColumn("l_quantity", F.when(k % 7 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))) \
             .withColumn("l_orderkey", F.when(k % 7 == 1, k + NEW_PARENT_OFFSET).otherwise(k))


def _hashes(docs: DataFrame) -> DataFrame:
    stored = osh.ITEMS + "lines"
    items = F.col(stored) if stored in docs.columns else osh.dedup_objects_json(osh.field_of(F.col("doc"), "lines")("variant"))
    return docs.select(F.col("id").alias("parent_id"), osh.items_hash(items).alias("list_hash"))


def q_change_detect(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    old, new = _line_docs(li), _line_docs(_changed_lines(li))
    return ou.change_detect(_hashes(old), _hashes(new)).select("parent_id", "status")


def q_replace_children(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    incoming = cut_lineage(_line_docs(_changed_lines(li)))
    # the incoming documents define the child columns (the stored ones
    # were shredded with the same schema)
    rows = osch.discover_schema(incoming).collect()
    # the lists of both document sets are read twice (hashes, shredding) and decoded once
    old, new = cut_lineage(osh.with_items(_line_docs(li), rows)), cut_lineage(osh.with_items(incoming, rows))
    status = ou.change_detect(_hashes(old), _hashes(new))
    cols = ["parent_id", "n", "f", "q", "p", "s"]
    oc_ = osh.shred_children(old, rows, "lines", "lines").select(*cols)
    nc_ = osh.shred_children(new, rows, "lines", "lines").select(*cols)
    return ou.replace_children(oc_, nc_, status)


def q_incremental_build(spark, sf_dir):
    """U6 + U7 over two days: the lines of all orders, then a second delivery in
    which some orders have other lines, some are new and the rest are unchanged.
    The stored children with their ids, which unchanged rows keep."""
    from layerflow.operators.increment import shred_increment
    li = read(spark, sf_dir, "lineitem")
    store = sl.LayerStore(spark, shared_dir(spark, "incremental_build"))
    for day in (li, _changed_lines(li)):
        store.publish("raw", {}, shred_increment(store, "raw", "orders", _line_docs(day)).extra)
    return store.table("raw", "orders_lines").select("id", "parent_id", "n", "f", "q", "p", "s")


def _order_docs(o: DataFrame, *extra) -> DataFrame:
    return o.select(F.col("o_orderkey").cast("string").alias("id"),
                    F.parse_json(F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("id"), *extra))).alias("doc"))


def q_drift_applied(spark, sf_dir):
    """Day one has whole prices of the orders with even keys, day two exact
    prices and priorities of the odd ones; rows of both days read back under
    one schema, with the column widened and the added one NULL on day one."""
    from layerflow.operators.increment import shred_increment
    o = read(spark, sf_dir, "orders")
    store = sl.LayerStore(spark, shared_dir(spark, "drift_applied"))
    days = (_order_docs(o.where("o_orderkey % 2 = 0"), F.floor("o_totalprice").alias("price")),
            _order_docs(o.where("o_orderkey % 2 = 1"), F.col("o_totalprice").cast("double").alias("price"), F.col("o_orderpriority").alias("priority")))
    for docs in days:
        store.publish("raw", {}, shred_increment(store, "raw", "orders", docs).extra)
    return store.table("raw", "orders").select("id", "price", "priority")


DELTA_BATCHES = 10


def q_delta_batches(spark, sf_dir):
    """U1/T1 as a delta store: the events in DELTA_BATCHES batches, the highest
    ids first, each written as its own delta; buckets fold on the way. The
    latest batch wins, within it the highest event id."""
    from layerflow.streaming.pages import upsert_batch
    ev = read(spark, sf_dir, "events")
    top = ev.agg(F.max("event_id")).first()[0] or 0
    store = sl.LayerStore(spark, shared_dir(spark, "delta_batches"))
    pages = cut_lineage(event_pages(ev))
    last = top // EVENTS_PER_PAGE
    for batch in range(DELTA_BATCHES):
        own = F.floor(F.col("page") * DELTA_BATCHES / (last + 1)) == DELTA_BATCHES - 1 - batch
        upsert_batch(store, "docs", "events", pages.where(own).select("page", F.lit("events").alias("source"), F.col("value").alias("payload")), buckets=8)
    return _state_values(store.table("docs", "events"))


# ---- U7: dense ids ----------------------------------------------------------------------
def q_dense_ids(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return dense_ids(o, ["o_orderdate", "o_orderkey"], "id").select("o_orderkey", "id")


# ---- F1-F3, F8-F11 --------------------------------------------------------------------
def q_aspect_type(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    n = F.col("l_linenumber") % 3
    text = (F.when(n == 0, F.concat(F.lit('{"type": "'), F.col("l_returnflag"), F.lit('"}')))
            .when(n == 1, F.concat(F.lit('{"x":{"type" : "'), F.col("l_linestatus"), F.lit('"},"type":"'),
                                   F.col("l_returnflag"), F.lit('"}')))
            .otherwise(F.col("l_returnflag")))
    return li.select("l_orderkey", "l_linenumber", text.alias("evaluationaspect"),
                     fc.aspect_type(text).alias("aspect"))


def q_postcode_split(spark, sf_dir):
    return whole_properties(spark, sf_dir).select("property_id", "postcode_prefix", "postcode_suffix")


def whole_properties(spark, sf_dir, **options) -> DataFrame:
    """The cleaned properties of every customer, from the CSV source."""
    return oc.clean_properties(R.reference_csv(spark, sf_dir, "propriedades", gaps=False), **options)


def whole_mapping(spark, sf_dir) -> DataFrame:
    return oc.clean_mapping(R.reference_csv(spark, sf_dir, "id_mapping", gaps=False))


def q_postcode_zero(spark, sf_dir):
    c = whole_properties(spark, sf_dir, zero_is_null=True)
    return c.select(F.col("property_id"),
                    ft.to_nullable_int("postcode_prefix", "int").alias("postcode_prefix"),
                    ft.to_nullable_int("postcode_suffix", "int").alias("postcode_suffix"))


def _part_floors(spark, sf_dir) -> DataFrame:
    p = read(spark, sf_dir, "part")
    n = len(R.FLOORS) + 3
    i = F.col("p_size") % n
    floors = F.element_at(F.array(*[F.lit(x).cast("string") for x in R.FLOORS]), (i + 1).cast("int"))
    txt = (F.when(i == len(R.FLOORS), F.concat(F.lit("Piso "), (F.col("p_size") % 5).cast("string"),
                                               F.lit(" - "), F.col("p_brand")))
           .when(i == len(R.FLOORS) + 1, F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(" ")))
           .when(i == len(R.FLOORS) + 2, F.concat(F.lit("rc "), F.col("p_name")))
           .otherwise(floors))
    return p.select(F.col("p_partkey").alias("id"), txt.alias("andar"))


def q_floor_standardise(spark, sf_dir):
    f = _part_floors(spark, sf_dir)
    return f.select(F.col("id").alias("p_partkey"), F.col("andar").alias("floor_before"),
                    fc.standardise_floor("andar").alias("floor"))


def q_floor_audit(spark, sf_dir):
    return oc.floor_audit(_part_floors(spark, sf_dir))


def q_gps_split(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    a = F.col("c_acctbal").cast("string")
    k = F.col("c_custkey") % 4
    txt = (F.when(k == 0, F.concat(a, F.lit(", "), (-F.col("c_acctbal")).cast("string")))
           .when(k == 1, F.concat(a, F.lit(",")))
           .when(k == 2, F.concat(a, F.lit(".1.2, 5")))
           .otherwise(F.concat(a, F.lit(" , "), F.col("c_nationkey").cast("string"))))
    lat, lon = fc.split_gps(txt)
    return c.select("c_custkey", txt.alias("gps_coordinates"), lat.alias("latitude"), lon.alias("longitude"))


def q_typed_relational(spark, sf_dir):
    return orl.build_reviews(model(spark, sf_dir).clean["reviews"])[0]


def q_typed_properties(spark, sf_dir):
    return orl.build_properties(whole_properties(spark, sf_dir))[0]


def q_typed_mapping(spark, sf_dir):
    return orl.build_mapping(whole_mapping(spark, sf_dir))[0]


def q_stale_inactive(spark, sf_dir):
    c = whole_properties(spark, sf_dir, clear_stale_inactive=True)
    return c.select("property_id", "is_inactive", "inactive_date")


# ---- F12, C1, C2 -----------------------------------------------------------------------
def q_length_limits(spark, sf_dir):
    return orl.length_violations(read(spark, sf_dir, "part"), "part",
                                 {"p_name": 10, "p_brand": 8, "p_type": 6})


def q_pk_violations(spark, sf_dir):
    li = orl.pk_violations(read(spark, sf_dir, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"])
    o = orl.pk_violations(read(spark, sf_dir, "orders"), "orders", ["o_orderkey"])
    m = model(spark, sf_dir).rel["property_id_mapping"]
    u = orl.pk_violations(m, "property_id_mapping", ["external_property_id"], nulls_allowed=True)
    return li.unionByName(o).unionByName(u)


# ---- J1-J5 -----------------------------------------------------------------------------
def q_review_report(spark, sf_dir):
    r = model(spark, sf_dir).rel
    m = r["property_id_mapping"].select("external_property_id", "property_id")
    p = r["properties"].select("property_id", "team")
    return (r["reviews"].select("review_id", "external_property_id", "overall_score")
            .join(m, "external_property_id", "left").join(p, "property_id", "left")
            .select("review_id", "external_property_id", "property_id", "team", "overall_score"))


def q_orphan_counts(spark, sf_dir):
    r = model(spark, sf_dir).rel
    a = orl.fk_orphans(r["reviews"], r["property_id_mapping"], "external_property_id")
    b = orl.fk_orphans(r["property_id_mapping"], r["properties"], "property_id")
    c = orl.fk_orphans(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), "doc_id")
    return a.agg(F.count(F.lit(1)).alias("orphans")).select(F.lit("reviews->mapping").alias("relation"), "orphans") \
        .unionByName(b.agg(F.count(F.lit(1)).alias("orphans")).select(F.lit("mapping->properties").alias("relation"), "orphans")) \
        .unionByName(c.agg(F.count(F.lit(1)).alias("orphans")).select(F.lit("documents->labels").alias("relation"), "orphans"))


def _surviving_orders(spark, sf_dir):
    return read(spark, sf_dir, "orders").where(F.col("o_orderkey") % ORDER_GAP_MOD != 0)


def q_orphan_aspects(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    return orl.fk_orphans(li, _surviving_orders(spark, sf_dir), "l_orderkey", "o_orderkey")


def q_fk_enforce(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    out = []
    for name, parent in (("lineitem->orders", read(spark, sf_dir, "orders")),
                         ("lineitem->surviving_orders", _surviving_orders(spark, sf_dir))):
        try:
            orl.enforce_fk(li, parent, "l_orderkey", "o_orderkey")
            status = "ok"
        except orl.ConstraintViolation:
            status = "violated"
        n = orl.fk_orphans(li, parent, "l_orderkey", "o_orderkey").agg(F.count(F.lit(1)).alias("orphans"))
        out.append(n.select(F.lit(name).alias("relation"), "orphans", F.lit(status).alias("status")))
    return out[0].unionByName(out[1])


def q_cascade_delete(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    return orl.cascade_delete(li, _surviving_orders(spark, sf_dir), "l_orderkey", "o_orderkey")


# ---- J2, X1, X2 ------------------------------------------------------------------------
def q_value_parity(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("n_chars") > 1000, 1).otherwise(0).cast("double").alias("a"))
    lab = read(spark, sf_dir, "labels").where(F.col("quality").isNotNull()).select(
        "doc_id", F.col("quality").cast("double").alias("b"))
    return ock.value_parity(d, lab, "doc_id", "a", "b")


def q_key_parity(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    shifted = o.where(k % 10 != 0).select(F.when(k % 10 == 1, k + SHIFT_OFFSET).otherwise(k).alias("o_orderkey"))
    return ock.key_parity(o, shifted, "o_orderkey")


def q_key_parity_property(spark, sf_dir):
    r = model(spark, sf_dir).rel
    return ock.key_parity(r["reviews"], r["property_id_mapping"], "external_property_id")


# ---- G1, G3, V*: checks --------------------------------------------------------------
_check_layers = R.check_layers


def q_row_parity(spark, sf_dir):
    return ock.row_counts(_check_layers(model(spark, sf_dir)))


def q_score_distribution(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    return ock.score_distribution(li.select("l_returnflag", (F.col("l_quantity") / 5).alias("score")), "l_returnflag")


def q_validation_report(spark, sf_dir):
    return ock.run_checks(_check_layers(model(spark, sf_dir)), R.AS_OF)


def q_validation_faults(spark, sf_dir):
    """The check report over layers with faults of every family."""
    layers = {lyr: dict(tables) for lyr, tables in _check_layers(model(spark, sf_dir)).items()}
    clean, rel = layers["clean"], layers["rel"]
    k = F.col("review_id").cast("bigint")
    clean["reviews"] = clean["reviews"].where(k % 101 != 0).withColumns({
        "overall_score": F.when(k % 50 == 1, F.lit(11.0)).otherwise(F.col("overall_score")),
        "sales_channel_code": F.when(k % 31 != 2, F.col("sales_channel_code")),
        "departure_date": F.when(k % 41 == 3, F.lit("1990-01-01")).otherwise(F.col("departure_date")),
        "created_at": F.when(k % 43 == 4, F.lit("2030-01-01 00:00:00")).otherwise(F.col("created_at"))})
    some = rel["reviews"].where(k % 97 != 5)
    rel["reviews"] = some.unionByName(some.where(k % 89 == 6)) \
        .withColumn("overall_score", F.when(k % 53 == 7, F.col("overall_score") - 20).otherwise(F.col("overall_score")))
    clean["review_aspects"] = clean["review_aspects"].withColumn("aspect", F.when(F.col("aspect_id") % 59 != 0, F.col("aspect")))
    rel["review_aspects"] = rel["review_aspects"].withColumn(
        "review_id", F.when(F.col("aspect_id") % 61 == 0, F.lit("x")).otherwise(F.col("review_id")))
    clean["properties"] = clean["properties"].where(F.col("property_id").cast("bigint") < 5)
    return ock.run_checks(layers, R.AS_OF)


# ---- D1-D6: star --------------------------------------------------------------------
def q_dim_date(spark, sf_dir):
    return star.dim_date(model(spark, sf_dir).rel["reviews"])


def q_dim_property(spark, sf_dir):
    return star.dim_property(orl.build_properties(whole_properties(spark, sf_dir))[0], orl.build_mapping(whole_mapping(spark, sf_dir))[0])


def q_dim_sales_channel(spark, sf_dir):
    return star.dim_sales_channel(model(spark, sf_dir).rel["reviews"])


def q_dim_aspect(spark, sf_dir):
    return star.dim_aspect(model(spark, sf_dir).rel["review_aspects"])


def q_fact_reviews(spark, sf_dir):
    s = star_tables(spark, sf_dir)
    return star.fact_reviews(model(spark, sf_dir).rel["reviews"], s["dim_property"], s["dim_sales_channel"])


def q_fact_review_aspects(spark, sf_dir):
    s = star_tables(spark, sf_dir)
    return star.fact_review_aspects(model(spark, sf_dir).rel["review_aspects"], s["fact_reviews"], s["dim_aspect"])


QUERIES = {
    "pages_explode": q_pages_explode,
    "pages_quarantine": q_pages_quarantine,
    "incremental_scan": q_incremental_scan,
    "increment_passes": q_increment_passes,
    "run_commit": q_run_commit,
    "csv_all_string": q_csv_all_string,
    "refresh_counts": q_refresh_counts,
    "guarded_load": q_guarded_load,
    "publish_roundtrip": q_publish_roundtrip,
    "dead_letter": q_dead_letter,
    "dead_letter_all": q_dead_letter_all,
    "sanitize_names": q_sanitize_names,
    "infer_types": q_infer_types,
    "schema_drift": q_schema_drift,
    "shred_parent": q_shred_parent,
    "shred_children": q_shred_children,
    "shred_counts": q_shred_counts,
    "rename_clean": q_rename_clean,
    "first_present": q_first_present,
    "field_upsert": q_field_upsert,
    "upsert_metrics": q_upsert_metrics,
    "page_stream_upsert": q_page_stream_upsert,
    "two_day_upsert": q_two_day_upsert,
    "row_upsert": q_row_upsert,
    "content_hash": q_content_hash,
    "child_dedup": q_child_dedup,
    "change_detect": q_change_detect,
    "replace_children": q_replace_children,
    "incremental_build": q_incremental_build,
    "drift_applied": q_drift_applied,
    "delta_batches": q_delta_batches,
    "dense_ids": q_dense_ids,
    "aspect_type": q_aspect_type,
    "postcode_split": q_postcode_split,
    "postcode_zero": q_postcode_zero,
    "floor_standardise": q_floor_standardise,
    "floor_audit": q_floor_audit,
    "gps_split": q_gps_split,
    "typed_relational": q_typed_relational,
    "typed_properties": q_typed_properties,
    "typed_mapping": q_typed_mapping,
    "stale_inactive": q_stale_inactive,
    "length_limits": q_length_limits,
    "pk_violations": q_pk_violations,
    "review_report": q_review_report,
    "orphan_counts": q_orphan_counts,
    "orphan_aspects": q_orphan_aspects,
    "fk_enforce": q_fk_enforce,
    "cascade_delete": q_cascade_delete,
    "value_parity": q_value_parity,
    "key_parity": q_key_parity,
    "key_parity_property": q_key_parity_property,
    "row_parity": q_row_parity,
    "score_distribution": q_score_distribution,
    "validation_report": q_validation_report,
    "validation_faults": q_validation_faults,
    "dim_date": q_dim_date,
    "dim_property": q_dim_property,
    "dim_sales_channel": q_dim_sales_channel,
    "dim_aspect": q_dim_aspect,
    "fact_reviews": q_fact_reviews,
    "fact_review_aspects": q_fact_review_aspects,
}
