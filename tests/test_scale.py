"""What keeps the review model's work in proportion to its tables."""
import json

from pyspark.sql import functions as F

from layerflow.functions import typing as ft
from layerflow.operators import relational as orl
from layerflow.operators import schema as osch
from layerflow.operators import shred as osh
from layerflow.plans import catalog as C
from layerflow.plans import reviews as R


def _docs(spark, docs):
    return spark.createDataFrame([(str(d.get("id")) if isinstance(d, dict) else None, json.dumps(d)) for d in docs], "id string, j string") \
        .select("id", F.parse_json("j").alias("doc"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reference_files_are_written_and_read_by_several_tasks(spark, sf_dir):
    for name, rows in (("propriedades", R.property_rows(spark, sf_dir)), ("id_mapping", R.mapping_rows(spark, sf_dir))):
        read = R.reference_csv(spark, sf_dir, name)
        assert read.rdd.getNumPartitions() > 1
        assert read.count() == rows.count()


def test_lists_are_decoded_once_for_parents_counts_and_children(spark):
    docs, rows = R.ordered_documents(_docs(spark, [{"id": str(i), "l": [{"k": i}, {"k": 1}, {"k": i}]} for i in range(20)]))
    children = osh.shred_children(docs, rows, "l", "l")
    for df in (osh.shred_parent(docs, rows), children, osh.child_counts(docs, "l", "l")):
        assert "lambda" not in _plan(df) and "to_json" not in _plan(df)
    assert children.count() == 39 == osh.child_counts(docs, "l", "l").agg(F.sum("__n")).first()[0]


def test_stored_lists_change_no_result(spark):
    docs = _docs(spark, [{"id": "a", "l": [{"k": 1}, 5, "{", {"k": 1}, {"k": 2.5, "t": None}]}, {"id": "b", "l": "text"}, {"id": "c", "l": []},
                         {"id": "d"}, {"id": None, "l": [{"k": 7}]}, {"l": [{"k": 8}]}, [1], 7, {"id": 5, "l": [{"x": [{"y": 1}]}]}])
    rows = osch.discover_schema(docs).collect()
    kept = osh.with_items(docs, rows)
    for make in (lambda d: osh.shred_parent(d, rows), lambda d: osh.shred_children(d, rows, "l", "l"), lambda d: osh.child_counts(d, "l", "l").select("__n")):
        assert sorted(map(repr, make(kept).collect())) == sorted(map(repr, make(docs).collect()))
    parents = {r.id: r for r in osh.shred_parent(kept, rows).collect()}
    assert set(parents) == {"a", "b", "c", "d", "5"} and parents["b"].l == "text" and parents["b"].hash_l is None
    assert [(r.parent_id, r.pos, r.k) for r in osh.shred_children(kept, rows, "l", "l").orderBy("parent_id", "pos").collect()] \
        == [("5", 0, None), ("a", 0, 1.0), ("a", 1, 2.5)]


def test_discovery_tells_types_without_lambdas(spark):
    docs = _docs(spark, [{"id": "1", "a": [1, {"k": 1}], "b": [[{"z": 1}], 1], "c": ["{"], "d": [None, {}], "e": [1, "x"]}])
    found = osch.discover_schema(docs)
    assert "lambda" not in _plan(found)
    assert {(r.scope, r.field) for r in found.collect()} == {("parent", "hash_a"), ("a", "k"), ("parent", "b"), ("parent", "c"), ("parent", "hash_d"), ("parent", "e")}


def test_keys_that_no_path_can_name(spark):
    keys = ["a.b", "it's", 'say "x"', "$", "[0]", "", "clé", "sp ace", "0"]
    docs = _docs(spark, [{"id": "1", **{k: i for i, k in enumerate(keys)}, "l": [{k: i for i, k in enumerate(keys)}]}])
    for i, k in enumerate(keys):
        assert docs.select(osh.field_of(F.col("doc"), k)("bigint")).first()[0] == i
    rows = osch.discover_schema(docs).collect()
    child = osh.shred_children(docs, rows, "l", "l").first()
    assert sorted(v for c, v in child.asDict().items() if c not in ("parent_id", "pos", "row_hash", "created_at")) == sorted(
        {r["field"]: keys.index(r["source_field"]) for r in rows if r["scope"] == "l"}.values())


def test_replaced_children_decode_each_list_once(spark, sf_dir):
    df = C.q_replace_children(spark, sf_dir)
    assert "to_json" not in _plan(df)


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_parents_are_decoded_in_one_pass(spark):
    few, many = ({"id": "1", **{f"f{i}": str(i) for i in range(n)}} for n in (2, 12))
    looks = []
    for doc in (few, many):
        docs = _docs(spark, [doc, {"id": "2"}])
        parent = osh.shred_parent(docs, osch.discover_schema(docs).collect())
        looks.append(_optimized(parent).count("variant_get"))
        assert {r["f1"] for r in parent.collect()} == {"1", None}
    assert looks[0] == looks[1]      # the look-ups do not grow with the fields


def test_values_of_every_type_and_keys_that_differ_in_case(spark):
    docs = _docs(spark, [{"id": "1", "b": True, "n": 5, "x": 1.5, "s": "t", "o": {"k": 1}, "l": [1, "a"], "v": None},
                         {"id": 2, "b": "no", "x": 3, "s": 7}, [1], None])
    rows = osch.discover_schema(docs).collect()
    got = {r["id"]: r.asDict() for r in osh.shred_parent(docs, rows).collect()}
    assert got["1"] | {"_id": 0} == {"id": "1", "_id": 0, "b": "true", "n": 5, "x": 1.5, "s": "t", "o": '{"k":1}', "l": '[1,"a"]', "v": None}
    assert got["2"] | {"_id": 0} == {"id": "2", "_id": 0, "b": "no", "n": None, "x": 3.0, "s": "7", "o": None, "l": None, "v": None}
    case = _docs(spark, [{"id": "1", "a": "x", "A": "y"}])
    df, value_of = osh.with_values(case, F.col("doc"), [("a", "STRING"), ("A", "STRING")])
    assert df.select(value_of("a", "STRING"), value_of("A", "STRING")).first()[:] == ("x", "y")


def test_strings_that_look_like_objects_are_no_items(spark):
    docs = _docs(spark, [{"id": "1", "l": [{"k": 1}, '{"k":2}', None, {"k": 1}]}, {"id": "2", "l": [{"k": 3}, {"k": 3}]},
                         {"id": "3", "l": {"k": 4}}, {"id": "4", "l": ["{"]}, {"id": "5"}])
    items = docs.select("id", osh.list_objects(F.col("doc"), "l").alias("items"))
    assert "ArrayType(StringType" in _optimized(items)
    assert dict(items.collect()) == {"1": ['{"k":1}'], "2": ['{"k":3}'], "3": None, "4": [], "5": None}


def test_discovery_types_only_the_fields_of_lists_in_its_second_pass(spark):
    docs = _docs(spark, [{"id": "1", "l": [{"k": 1}, {"k": None}], "m": [{"q": 1}]}, {"id": "2", "l": {"z": 1}, "m": [1]}])
    schema = osch.discover_schema(docs)
    assert "array_max" not in _optimized(schema)      # the test for lists is not repeated
    assert {(r.scope, r.field): r.data_type for r in schema.collect()} == {
        ("parent", "l"): "STRING", ("parent", "m"): "STRING", ("parent", "hash_l"): "STRING", ("parent", "hash_m"): "STRING",
        ("l", "k"): "STRING", ("m", "q"): "BIGINT"}


def test_review_documents_are_packed_without_lambdas(spark, sf_dir):
    assert "lambda" not in _optimized(R.review_documents(spark, sf_dir))


def test_plain_numerals_are_told_without_trimming(spark):
    values = ["1", "123456789", "1234567890", " 1 ", "x", "", None, "1.5", "inf"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert [r[0] for r in df.select(ft.is_small_int("v")).collect()] == [True, True] + [False] * 7
    good, bad = orl.build_properties(df.select(F.lit("7").alias("property_id"), F.col("v").alias("max_occupancy")))
    assert [r.max_occupancy for r in good.collect()] == [1, 123456789, 1234567890, 1, None, None, None]
    assert [r.error for r in bad.collect()] == ["fractional value in max_occupancy", "infinite value in max_occupancy"]


def test_dates_with_outer_white_space(spark):
    values = ["2024-01-02", " 2024-01-02", "2024-01-02\u00a0", "\u20032024-01-02\n", "", None, "x"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert [str(r[0]) for r in df.select(ft.to_date("v")).collect()] == ["2024-01-02"] * 4 + ["None"] * 3
    assert [r[0] for r in df.select(ft.trimmed_mostly("v")).collect()] == ["2024-01-02"] * 4 + ["", None, "x"]


def test_the_second_discovery_pass_looks_its_lists_up(spark):
    docs = _docs(spark, [{"id": "1", "l": [{"k": 1}, 5], "a b": [{"q": None}], "x": 1}, {"id": "2", "l": {"z": 1}, "a b": "t"}, {"id": "3", "l": None}, [1]])
    schema = osch.discover_schema(docs)
    assert _optimized(schema).count("Generate variant_explode") == 2     # lists and their elements, not all values
    assert {(r.scope, r.field): r.data_type for r in schema.collect()} == {
        ("parent", "l"): "STRING", ("parent", "hash_l"): "STRING", ("parent", "a_b"): "STRING", ("parent", "hash_a_b"): "STRING",
        ("parent", "x"): "BIGINT", ("l", "k"): "BIGINT", ("a_b", "q"): "STRING"}
    plain = osch.discover_schema(_docs(spark, [{"id": "1", "x": 1}, {"id": "2", "l": [1]}]))
    assert {(r.scope, r.field) for r in plain.collect()} == {("parent", "x"), ("parent", "l")}


def test_aspects_stay_where_they_are_when_few_reviews_are_dead(spark):
    m = R.Model()
    m.clean = {"properties": spark.createDataFrame([("1", "2")], "property_id string, max_occupancy string"),
               "property_id_mapping": spark.createDataFrame([("1", 7)], "property_id string, external_property_id bigint"),
               "reviews": spark.createDataFrame([("a", "7"), ("b", "7.5"), ("c", None), (None, "8.5")], "review_id string, external_property_id string"),
               "review_aspects": spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0), (4, None, 4.0), (5, "z", 5.0)],
                                                       "aspect_id bigint, review_id string, score double")}
    R.rel_layer(m)
    aspects = m.rel["review_aspects"]
    assert sorted(r.aspect_id for r in aspects.collect()) == [1, 3, 4, 5]
    assert "SortMergeJoin" not in _plan(aspects)
    assert sorted((r.table_name, r.key or "", r.error) for r in m.dead_letter.collect()) == [
        ("review_aspects", "2", "its review is in the dead letter"), ("reviews", "", "fractional value in external_property_id"),
        ("reviews", "b", "fractional value in external_property_id")]


def test_typed_texts_are_trimmed_by_pattern_only_at_need(spark):
    values = ["1", " 2", "3 ", " 4\n", "5.0", "", None, "x", "1.5"]
    clean = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "property_id string, max_occupancy string")
    good, bad = orl.build_properties(clean)
    assert "substring(max_occupancy" in _optimized(good)
    assert {r.property_id: r.max_occupancy for r in good.collect()} == {0: 1, 1: 2, 2: 3, 3: 4, 4: 5, 5: None, 6: None, 7: None}
    assert [r.key for r in bad.collect()] == ["8"]


def test_dates_without_a_time_are_not_searched_for_a_zone(spark):
    values = ["2024-01-02", "2024-01-02 03:04:05", "2024-01-02T03:04:05+02:00", "2024-01-02 03:04:05Z", None, "x:y", ""]
    df = spark.createDataFrame([(v,) for v in values], "v string").select(ft.to_datetime("v").alias("t"))
    assert "Contains(" in _optimized(df)
    assert [str(r.t) for r in df.collect()] == ["2024-01-02 00:00:00", "2024-01-02 03:04:05", "2024-01-02 01:04:05", "2024-01-02 03:04:05", "None", "None", "None"]
