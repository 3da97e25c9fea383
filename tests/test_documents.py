"""Golden and property tests for documents: pages (S1-S3), field upsert
(U1, T2), type lattice (P3), shredding and child handling (P5, P6, U4-U6)."""
import json

from pyspark.sql import functions as F

from layerflow.operators import schema as osch
from layerflow.operators import shred as osh
from layerflow.operators import upsert as ou
from layerflow.sources import pages as sp


def docs_df(spark, docs):
    rows = [(str(i), json.dumps(d)) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "rid string, j string").select(
        F.col("rid"), F.parse_json("j").alias("doc"),
        F.expr("try_variant_get(parse_json(j), '$.id', 'string')").alias("id"))


def test_pages_split(spark):
    pages = spark.createDataFrame([
        (1, json.dumps({"data": [{"id": "a", "x": 1}, 5, "s", {"x": 2}, {"id": None, "y": 1}]})),
        (2, json.dumps({"data": []})),
        (3, json.dumps({"nodata": 1})),
        (4, json.dumps({"data": {"id": "x"}})),
        (5, "{not json" + "x" * 20_000),
    ], "page int, payload string")
    split = sp.split_pages(pages, source_col=None)
    el = sorted((r.page, r.pos, r.id) for r in split.elements.collect())
    assert el == [(1, 0, "a"), (1, 4, None)]          # id: null passes S3
    rej = sorted((r.page, r.reason, r.dropped) for r in split.rejects.collect())
    assert rej == [(1, "no_id", 1), (1, "not_object", 2)]
    q = sorted((r.page, r.reason) for r in split.quarantine.collect())
    assert q == [(3, "data_not_list"), (4, "data_not_list"), (5, "bad_json")]
    assert max(len(r.payload) for r in split.quarantine.collect()) == 20_009      # whole payloads


def _upsert(spark, batches):
    state = None
    for seq, docs in enumerate(batches):
        d = docs_df(spark, docs)
        state = ou.field_upsert(state, ou.document_fields(d, F.lit(seq)))
    return {(r.id, r.field): r.value_json for r in state.collect()}


def test_field_upsert_fixtures(spark):
    s = _upsert(spark, [[{"id": "1", "a": 1, "b": 2}], [{"id": "1", "b": None, "c": 3}]])
    assert s == {("1", "id"): '"1"', ("1", "a"): "1", ("1", "b"): "null", ("1", "c"): "3"}
    s = _upsert(spark, [[{"id": "1", "a": {"x": 1, "y": 2}}], [{"id": "1", "a": {"x": 9}}]])
    assert s[("1", "a")] == '{"x":9}'                  # shallow
    s = _upsert(spark, [[{"id": "1", "a": 1}], [{"id": "1"}]])
    assert s[("1", "a")] == "1"                        # absent keeps old value


def test_field_upsert_replay_is_idempotent(spark):
    batches = [[{"id": "1", "a": 1}, {"id": "2", "a": 5}], [{"id": "1", "a": 2, "b": None}]]
    once = _upsert(spark, batches)
    twice = _upsert(spark, batches + [batches[1]])     # page re-delivered
    assert once == twice


def test_upsert_metrics(spark):
    b = ou.field_upsert(None, ou.document_fields(docs_df(spark, [{"id": "1", "a": 1}, {"id": "2", "a": 1}]), F.lit(0)))
    a = ou.field_upsert(b, ou.document_fields(docs_df(spark, [{"id": "1", "a": 1}, {"id": "2", "a": 2},
                                                             {"id": "3", "a": 1}]), F.lit(1)))
    m = ou.upsert_metrics(b, a).first()
    assert (m.upserted, m.matched, m.modified, m.total) == (1, 2, 1, 3)


def _types(spark, docs):
    rows = osch.discover_schema(docs_df(spark, docs)).collect()
    return {(r.scope, r.field): r.data_type for r in rows}


def test_type_lattice(spark):
    t = _types(spark, [{"id": "1", "a": True, "b": 3, "c": 3, "d": [], "e": [1], "f": {}},
                       {"id": "2", "a": 3, "b": 2.5, "c": None, "d": [{"k": 1}], "g": 23.0}])
    assert t[("parent", "a")] == "BIGINT"
    assert t[("parent", "b")] == "DOUBLE"
    assert t[("parent", "c")] == "STRING"
    assert t[("parent", "d")] == "STRING" and t[("parent", "hash_d")] == "STRING" and t[("d", "k")] == "BIGINT"
    assert t[("parent", "e")] == "STRING" and t[("parent", "f")] == "STRING"
    assert t[("parent", "g")] == "DOUBLE"


def _children(spark, docs):
    d = docs_df(spark, docs)
    rows = osch.discover_schema(d).collect()
    return osh.shred_children(d, rows, "l", "l")


def _list_hash(spark, lst):
    d = docs_df(spark, [{"id": "p", "l": lst}])
    return d.select(osh.list_hash(F.col("doc").try_cast("map<string,variant>")["l"])).first()[0]


def test_child_change_rules(spark):
    x, y = {"a": 1, "b": 2}, {"a": 3}
    h = lambda lst: _list_hash(spark, lst)
    assert h([x, y]) == h([x, y, x])                  # dedup first
    assert h([x, y]) != h([y, x])                     # order is part of the hash
    assert h([{"a": 1, "b": 2}]) == h([{"b": 2, "a": 1}])   # keys sorted
    assert h([{"a": 1}]) != h([{"a": 1, "b": None}])        # explicit null counts
    assert h([{"a": 1}]) == h([{"a": 1.0}])                 # B19 (ours)
    ch = _children(spark, [{"id": "p", "l": [x, 5, "s", y, x]}])
    assert [(r.parent_id, r.pos, r.a) for r in ch.orderBy("pos").collect()] == [("p", 0, 1), ("p", 1, 3)]


def test_replace_children(spark):
    stored = spark.createDataFrame([("p", "h1"), ("q", "h2"), ("r", "h3")], "parent_id string, list_hash string")
    new = spark.createDataFrame([("p", "h1"), ("q", "hX"), ("s", "h4")], "parent_id string, list_hash string")
    st = {r.parent_id: r.status for r in ou.change_detect(stored, new).collect()}
    assert st == {"p": "unchanged", "q": "changed", "s": "new"}
    old_c = spark.createDataFrame([("p", 1), ("q", 1), ("q", 2), ("r", 1)], "parent_id string, v int")
    new_c = spark.createDataFrame([("p", 9), ("q", 7), ("s", 4)], "parent_id string, v int")
    out = sorted(tuple(r) for r in ou.replace_children(old_c, new_c, ou.change_detect(stored, new)).collect())
    assert out == [("p", 1), ("q", 7), ("r", 1), ("s", 4)]


def test_row_upsert(spark):
    t = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, c string, v double")
    u = spark.createDataFrame([(2, None), (3, 5.0)], "k int, v double")
    out = sorted(tuple(r) for r in ou.row_upsert(t, u, ["k"]).collect())
    assert out == [(1, "a", 1.0), (2, "b", None), (3, None, 5.0)]


def test_shred_parent_skips_null_ids(spark):
    from pyspark.sql import Observation
    d = docs_df(spark, [{"id": "1", "a": 1, "l": [{"k": 1}]}, {"id": None, "a": 2}, {"a": 3}])
    rows = osch.discover_schema(d).collect()
    obs = Observation("t")
    p = osh.shred_parent(d, rows, counters=obs)
    got = [(r.id, r.a) for r in p.collect()]
    assert got == [("1", 1)]
    assert obs.get == {"processed": 3, "skipped": 2, "failed": 0}
    assert "hash_l" in p.columns and "l" not in p.columns


def test_name_collision(spark):
    import pytest
    d = docs_df(spark, [{"id": "1", "a b": 1, "a_b": 2}, {"id": "2", "c": 3}])
    rows = osch.discover_schema(d).collect()
    with pytest.raises(ValueError):
        osch.check_name_collisions(rows)
    # a field that only the last of many documents has is found, and so is an empty object's list
    late = osch.discover_schema(docs_df(spark, [{"id": str(i), "x": 1} for i in range(300)] + [{"id": "z", "late": 1.5, "l": [{}]}, 7, [1]])).collect()
    assert {(r.scope, r.field, r.data_type) for r in late} == {("parent", "x", "BIGINT"), ("parent", "late", "DOUBLE"), ("parent", "hash_l", "STRING")}
    assert [r.child_scope for r in late if r.role == "list_hash"] == ["l"]


def test_schema_drift(spark):
    old = osch.discover_schema(docs_df(spark, [{"id": "1", "a": 1}]))
    new = osch.discover_schema(docs_df(spark, [{"id": "1", "a": 1.5, "b": True}]))
    got = sorted((r.field, r.old_type, r.new_type, r.change) for r in osch.schema_drift(old, new).collect())
    assert got == [("a", "BIGINT", "DOUBLE", "widened"), ("b", None, "BOOLEAN", "added")]
