"""Review model on the driver's tables, raw -> clean -> relational -> star.

Stand-ins (SURVEY §7.4): a review is an ``orders`` row, its aspects are the
order's ``lineitem`` rows, a property is a ``customer`` row. The inputs are
packed into the shapes the reference ingests — JSON documents with a nested
list, all-string property and id-mapping rows — so every operator runs on
real text. The packing rules below are fixed so that the oracle SQL can
compute the same answers straight from the tables.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from layerflow.operators import clean as oc
from layerflow.operators import relational as orl
from layerflow.operators import star
from layerflow.operators.keys import dense_ids
from layerflow.operators.schema import check_name_collisions, discover_schema
from layerflow.operators.shred import child_counts, shred_children, shred_parent, with_items
from layerflow.session import cut_lineage, shared_dir
from layerflow.sources.csv import read_csv_all_string, write_csv
from layerflow.sources.layers import LayerStore, LoadGuardError

# Fixed stand-in parameters (shared with the oracle SQL).
EXTERNAL_ID_OFFSET = 100000
LOADED_AT = "2024-06-01 00:00:00"
AS_OF = "2026-01-01 00:00:00"
MAPPING_GAP_MOD, MAPPING_GAP_REM = 10, 3      # customers missing from the id mapping
PROPERTY_GAP_MOD, PROPERTY_GAP_REM = 10, 7    # customers missing from the property file
CHANNELS = [("1-URGENT", "AIRBNB"), ("2-HIGH", "BOOKING"), ("3-MEDIUM", "HOMEAWAY"),
            ("4-NOT SPECIFIED", "DIRECT")]
LANGUAGES = ["en", "pt", "es", "fr"]
FLOORS = ["0", "0º", "Piso 0", "3", "2°", "r/c esq", "RC-Esq", "RCD", "Piso 2 - Esq", ".", None, "1º Dto",
          "\u00a03", "2\u00a0º", "Piso\u00a02\u2003- Esq"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def review_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, doc VARIANT): one JSON review per order, aspects nested. A
    document is one row; its list is one order's lines (a group bounded by
    the order, as a review's aspects are bounded by the review)."""
    o = read(spark, sf_dir, "orders")
    li = read(spark, sf_dir, "lineitem")
    aspect = F.struct(F.struct(F.col("l_returnflag").alias("type")).alias("evaluationAspect"),
                      (F.col("l_quantity") / 5).alias("valoration"))
    lines = (li.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.struct(F.col("l_linenumber").alias("n"), aspect.alias("a")))).alias("ls"),
        F.max("l_shipdate").alias("max_ship")))
    j = o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
    k = F.col("o_orderkey")
    channel = F.lit("OTHER")
    for pri, code in reversed(CHANNELS):
        channel = F.when(F.col("o_orderpriority") == pri, F.lit(code)).otherwise(channel)
    doc = F.struct(
        k.cast("string").alias("id"),
        (F.col("o_custkey") + EXTERNAL_ID_OFFSET).alias("accommodationId"),
        k.alias("bookingId"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("createdAt"),
        F.concat(F.lit("Guest "), F.col("o_custkey").cast("string")).alias("customerName"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("arrivalDate"),
        F.date_format("max_ship", "yyyy-MM-dd").alias("departureDate"),
        ((k % 101) / 10.0).alias("globalValoration"),
        F.element_at(F.array(*[F.lit(x) for x in LANGUAGES]), (F.col("o_custkey") % 4 + 1).cast("int")).alias("language"),
        channel.alias("saleschannelCode"),
        (F.col("o_orderstatus") == "F").alias("validated"),
        F.when(k % 3 == 0, F.lit("Thank you")).alias("response"),
        F.when(k % 3 == 0, F.date_format(F.date_add(F.col("o_orderdate").cast("date"), 2), "yyyy-MM-dd")).alias("responseDate"),
        F.when(k % 2 == 0, F.lit("Great stay")).otherwise(F.lit(" ")).alias("positiveComment"),
        F.when(k % 5 == 0, F.lit("Noisy")).alias("negativeComment"),
        F.lit("ok").alias("neutralComment"),
        F.col("o_orderstatus").alias("title"),
        F.when(k % 4 == 0, k % 7).alias("likes"),
        F.when(F.size("ls") > 0, F.col("ls.a")).alias("evaluationAspects"),
    )
    return j.select(k.cast("string").alias("id"), F.parse_json(F.to_json(doc)).alias("doc"))


def property_rows(spark: SparkSession, sf_dir: str, gaps: bool = True) -> DataFrame:
    """All-string ``propriedades`` rows from ``customer`` (as read from CSV);
    with ``gaps`` some are missing, so that joins have unmatched members."""
    c = read(spark, sf_dir, "customer")
    if gaps:
        c = c.where(F.col("c_custkey") % PROPERTY_GAP_MOD != PROPERTY_GAP_REM)
    k = F.col("c_custkey")
    p4 = F.lpad((k % 10000).cast("string"), 4, "0")
    s3 = F.lpad((k % 1000).cast("string"), 3, "0")
    code = (F.when(k % 5 == 0, F.concat(p4, F.lit("-"), s3)).when(k % 5 == 1, p4)
            .when(k % 5 == 2, F.concat(F.lit("\u00a0"), p4, F.lit(" -\u00a0"), s3, F.lit(" ")))
            .when(k % 5 == 3, F.lit("0000-000")))
    zone = F.when(k % 3 == 1, s3).when(k % 3 == 2, F.lit("nan"))
    gps = F.when(k % 6 == 5, F.concat(F.lit("38.1.2, -9.") , (k % 10).cast("string"))).otherwise(
        F.concat(F.lit("38."), (k % 100).cast("string"), F.lit(", -9."), (k % 1000).cast("string")))
    floor = F.element_at(F.array(*[F.lit(x).cast("string") for x in FLOORS]), (k % len(FLOORS) + 1).cast("int"))
    flag = lambda m: F.when(k % m == 0, F.lit("1")).otherwise(F.lit("0"))
    return c.select(
        k.cast("string").alias("id"),
        F.col("c_mktsegment").alias("equipa"),
        F.concat(F.lit("Zone "), F.col("c_nationkey").cast("string")).alias("bairro"),
        code.alias("wc_codpostal"), zone.alias("wc_zonapostal"), gps.alias("coordsgps"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(flag(7)).alias("inativo"),
        F.concat(F.lit("2020-01-"), F.lpad((k % 28 + 1).cast("string"), 2, "0")).alias("data_inicio"),
        F.when(k % 7 == 0, F.lit("2023-06-30")).when(k % 13 == 0, F.lit("2022-01-01")).alias("data_inativo"),
        floor.alias("andar"),
        flag(2).alias("elevador"),
        F.when(k % 17 == 0, F.lit("3.0")).otherwise((k % 8 + 1).cast("string")).alias("m_x_ocupa_o"),
        (F.col("c_nationkey") % 3).cast("string").alias("numwcduche"),
        F.when(k % 9 == 0, F.lit("x")).otherwise(F.lit("1")).alias("numwcbasico"),
        F.when(k % 4 == 0, F.concat(F.lit("Garage "), k.cast("string"))).alias("lugar_garagem"),
        flag(2).alias("rcm_maqroupa"),
        F.when(k % 3 == 0, F.lit("1")).alias("rcm_maqloica"),
        F.lit("1").alias("rcm_arcond"),
        flag(5).alias("autocheckin"),
    )


def mapping_rows(spark: SparkSession, sf_dir: str, gaps: bool = True) -> DataFrame:
    """All-string ``id_mapping`` rows: internal id -> external id."""
    c = read(spark, sf_dir, "customer")
    if gaps:
        c = c.where(F.col("c_custkey") % MAPPING_GAP_MOD != MAPPING_GAP_REM)
    return c.select(F.col("c_custkey").cast("string").alias("internal_id"),
                    (F.col("c_custkey") + EXTERNAL_ID_OFFSET).cast("string").alias("external_id"))


# Fixed stand-in CSV headers: P2 cleans them to the raw column names.
PROPERTY_CSV_HEADERS = ["ID", "Equipa", "Bairro", "WC CodPostal", "WC ZonaPostal", "CoordsGPS", "Inativo",
                        "Data Inicio", "Data Inativo", "Andar", "Elevador", "Máx.Ocupação", "NumWCDuche",
                        "NumWCBasico", "Lugar Garagem", "RCM MaqRoupa", "RCM MaqLoica", "RCM ArCond", "AutoCheckin"]
MAPPING_CSV_HEADERS = ["Internal Id", "External Id"]


def reference_csv(spark: SparkSession, sf_dir: str, name: str, gaps: bool = True) -> DataFrame:
    """Stage the property or id-mapping rows as a CSV file with human headers
    in the shared folder and load it back with the all-string CSV source
    (S5-S7, P2), as the reference loads its reference files."""
    rows, headers = ((property_rows(spark, sf_dir, gaps), PROPERTY_CSV_HEADERS) if name == "propriedades"
                     else (mapping_rows(spark, sf_dir, gaps), MAPPING_CSV_HEADERS))
    expected = rows.columns
    path = shared_dir(spark, f"csv_{name}")
    # a file with quoted newlines is read by one task: as many files as cores, however few splits the table has
    write_csv(rows.repartition(spark.sparkContext.defaultParallelism).toDF(*headers), path)
    return read_csv_all_string(spark, path, expected_columns=expected)


@dataclass
class Model:
    raw: dict = field(default_factory=dict)
    clean: dict = field(default_factory=dict)
    rel: dict = field(default_factory=dict)
    dead_letter: DataFrame | None = None
    counters: Observation | None = None
    store: LayerStore | None = None
    mapping_columns: tuple[str, str] = oc.MAPPING_COLUMNS
    aside: dict = field(default_factory=dict)   # layer -> table -> path, written but not yet live
    grouped: dict = field(default_factory=dict)  # raw tables kept as deltas, written by the increment
    extras: dict = field(default_factory=dict)   # layer -> what its publish sets beside the tables


def raw_layer(spark: SparkSession, sf_dir: str | None, docs: DataFrame | None = None,
              properties: DataFrame | None = None, mapping: DataFrame | None = None,
              loaded_at: str = LOADED_AT) -> Model:
    """Documents -> raw parent and child tables (P3, P5, P6, U7), plus the
    all-string property and id-mapping tables from the CSV source. Without
    explicit inputs the stand-ins of ``sf_dir`` are used."""
    docs = docs if docs is not None else review_documents(spark, sf_dir)
    docs, schema_rows = ordered_documents(docs)
    check_name_collisions(schema_rows)     # B14: two fields, one column -> error
    counters = Observation("shred")
    parent = shred_parent(docs, schema_rows, counters=counters)
    children = {}
    for r in schema_rows:
        if r["scope"] == "parent" and r["role"] == "list_hash":
            scope = r["child_scope"]
            ch = shred_children(docs, schema_rows, scope, r["source_field"], loaded_at=loaded_at)
            ch = dense_ids(ch, ["parent_id", "pos"], "id", presorted=True, counts=child_counts(docs, scope, r["source_field"])).drop("pos")
            children[f"reviews_{scope}"] = ch
    m = Model(counters=counters)
    m.raw = {"reviews": parent, **children,
             "propriedades": properties if properties is not None else reference_csv(spark, sf_dir, "propriedades"),
             "id_mapping": mapping if mapping is not None else reference_csv(spark, sf_dir, "id_mapping")}
    return m


def ordered_documents(docs: DataFrame) -> tuple[DataFrame, list]:
    """The documents in id order in fixed partitions, with the objects of their
    lists, and their discovered schema (one row per column: the only collect
    here). Both shredders read them, and child rows exploded from them are
    already in (parent, position) order and get their dense ids without another
    shuffle. They are stored once before: discovery and range partitioning
    (bounds, then rows) read them too."""
    stored = cut_lineage(docs)
    schema_rows = discover_schema(stored).collect()
    ordered = stored.repartitionByRange("id").sortWithinPartitions("id")
    return cut_lineage(with_items(ordered, schema_rows)), schema_rows


# The child table of the aspect list, when no document carried one.
EMPTY_ASPECTS = ("id bigint, parent_id string, row_hash string, created_at timestamp_ntz, "
                 "evaluationaspect string, valoration double")


# The smallest row counts a clean table may be replaced with.
CLEAN_FLOORS = {"reviews": 1, "review_aspects": 1, "property_id_mapping": 1, "properties": 1}


def clean_layer(m: Model) -> Model:
    if "reviews_evaluationaspects" not in m.raw:
        spark = m.raw["reviews"].sparkSession
        m.raw["reviews_evaluationaspects"] = spark.createDataFrame([], EMPTY_ASPECTS)
    mapping, m.dead_letter = orl.split_errors(m.raw["id_mapping"], "property_id_mapping", m.mapping_columns[0],
                                              oc.mapping_errors(m.raw["id_mapping"], m.mapping_columns))
    m.clean = {
        "reviews": oc.clean_reviews(m.raw["reviews"]),
        "review_aspects": oc.clean_aspects(m.raw["reviews_evaluationaspects"]),
        "property_id_mapping": oc.clean_mapping(mapping, columns=m.mapping_columns),
        "properties": oc.clean_properties(m.raw["propriedades"]),
    }
    return m


def rel_layer(m: Model) -> Model:
    """The typed tables, and one dead letter for the rows of all of them that
    an integer column cannot hold; the aspects of such a review go with it."""
    builders = {"properties": orl.build_properties, "property_id_mapping": orl.build_mapping,
                "reviews": orl.build_reviews, "review_aspects": orl.build_aspects}
    for table, build in builders.items():
        m.rel[table], bad = build(m.clean[table])
        if table == "reviews":
            # stored once, for the dead letter and the two joins: by its size on disk
            # Spark tells whether the aspects have to move to meet it
            path = shared_dir(bad.sparkSession, "dead_reviews")
            bad.write.mode("overwrite").parquet(path)
            bad = bad.sparkSession.read.parquet(path)
            lost = bad.select(F.col("key").alias("review_id"))
        if table == "review_aspects":
            gone = m.rel[table].join(lost, "review_id", "left_semi")
            m.rel[table] = m.rel[table].join(lost, "review_id", "left_anti")
            bad = bad.unionByName(orl.split_errors(gone, table, "aspect_id", F.lit("its review is in the dead letter"))[1])
        m.dead_letter = bad if m.dead_letter is None else m.dead_letter.unionByName(bad)
    return m


def enforce_floors(m: Model, floors: dict[str, int]) -> None:
    """Nothing is replaced by a table below its floor."""
    for table, least in floors.items():
        if least > 0 and m.clean[table].limit(least).count() < least:
            raise LoadGuardError(f"clean.{table}: fewer than {least} rows, build refused")


def enforce_constraints(m: Model) -> None:
    """The relational build fails, and nothing is published, when a key,
    foreign key or column size is violated (C1, C2, J4, F12)."""
    r = m.rel
    orl.enforce_table(r["properties"], "properties", ["property_id"], orl.PROPERTY_SIZES)
    orl.enforce_table(r["property_id_mapping"], "property_id_mapping", ["property_id"])
    orl.enforce_table(r["property_id_mapping"], "property_id_mapping", ["external_property_id"],
                      nulls_allowed=True)
    orl.enforce_table(r["reviews"], "reviews", ["review_id"], orl.REVIEW_SIZES)
    orl.enforce_table(r["review_aspects"], "review_aspects", ["aspect_id"], orl.ASPECT_SIZES)
    orl.enforce_fk(r["review_aspects"], r["reviews"], "review_id")


# The reference's lookup indexes, re-aimed as write layout (files hold
# key ranges, row groups are sorted, so min/max statistics skip). Each
# lookup column is followed by the primary key, so one hot value (a date
# with a third of all reviews) is still split across many files and tasks.
REL_LAYOUT = {"reviews": ["arrival_date", "review_id"], "review_aspects": ["review_id", "aspect_id"],
              "properties": ["property_id"], "property_id_mapping": ["external_property_id", "property_id"]}


def _aside(m: Model, layer: str, tables: dict, version: str, layouts: dict | None = None) -> dict:
    """Write every table of a layer without switching it live, and hand back
    readers of what is stored (checks then verify stored data)."""
    m.aside[layer] = m.store.build_aside(layer, tables, version, layouts)
    return {t: m.store.spark.read.parquet(path) for t, path in m.aside[layer].items()}


def stage_layers(m: Model, store: LayerStore, version: str | None = None, floors: dict[str, int] | None = None) -> Model:
    """Write the raw, clean and relational layers aside, each from what is
    stored of the one before. Floors, keys, foreign keys and column sizes must
    hold; a violation raises and leaves every live layer as it was."""
    version = version or uuid.uuid4().hex[:12]
    m.store = store
    m.raw = {**_aside(m, "raw", {t: df for t, df in m.raw.items() if t not in m.grouped}, version), **m.grouped}
    clean_layer(m)
    m.clean = _aside(m, "clean", m.clean, version)
    enforce_floors(m, floors or {})
    rel_layer(m)
    stored = _aside(m, "rel", {**m.rel, "dead_letter": m.dead_letter}, version, REL_LAYOUT)
    m.dead_letter, m.rel = stored.pop("dead_letter"), stored
    enforce_constraints(m)
    return m


def publish_aside(m: Model, others: dict | None = None) -> None:
    """Switch live what has been written aside, all layers in one commit, with
    the (tables, state) of ``others``."""
    m.store.publish_together({**(others or {}), **{layer: (tables, m.extras.get(layer)) for layer, tables in m.aside.items()}})
    m.aside, m.extras = {}, {}


def publish_layers(m: Model, store: LayerStore, version: str | None = None) -> Model:
    """Write all layers aside, check them, then switch them live."""
    stage_layers(m, store, version)
    publish_aside(m)
    return m


def build_model(spark: SparkSession, sf_dir: str, store: LayerStore | None = None,
                version: str | None = None) -> Model:
    """The whole layered build on the stand-ins of ``sf_dir``."""
    store = store or LayerStore(spark, shared_dir(spark, "review_model"))
    return publish_layers(raw_layer(spark, sf_dir), store, version)


def check_layers(m: Model) -> dict:
    """The tables the cross-layer checks compare."""
    return {"raw": {"reviews": m.raw["reviews"], "reviews_evaluationaspects": m.raw["reviews_evaluationaspects"],
                    "propriedades": m.raw["propriedades"]},
            "clean": {t: m.clean[t] for t in ("reviews", "review_aspects", "properties")},
            "rel": {t: m.rel[t] for t in ("reviews", "review_aspects", "properties")}}


def star_schema(m: Model, publish: bool = True) -> dict[str, DataFrame]:
    """Dimensions, then facts keyed on the stored dimensions; with a
    layer store every table is written aside first and the whole star is
    switched live in one publish (shadow build and swap)."""
    r = m.rel
    store = m.store
    version = uuid.uuid4().hex[:12]
    written: dict[str, str] = {}

    def stage(name: str, df: DataFrame) -> DataFrame:
        if store is None:
            return df
        written[name] = store.write_version("star", name, df, version).path
        return m.store.spark.read.parquet(written[name])

    dims = {"dim_date": stage("dim_date", star.dim_date(r["reviews"])),
            "dim_property": stage("dim_property", star.dim_property(r["properties"], r["property_id_mapping"])),
            "dim_sales_channel": stage("dim_sales_channel", star.dim_sales_channel(r["reviews"])),
            "dim_aspect": stage("dim_aspect", star.dim_aspect(r["review_aspects"]))}
    f_rev = stage("fact_reviews", star.fact_reviews(r["reviews"], dims["dim_property"], dims["dim_sales_channel"]))
    f_asp = stage("fact_review_aspects", star.fact_review_aspects(r["review_aspects"], f_rev, dims["dim_aspect"]))
    if store is not None:
        m.aside["star"] = written
        if publish:
            publish_aside(m)
    return {**dims, "fact_reviews": f_rev, "fact_review_aspects": f_asp}
