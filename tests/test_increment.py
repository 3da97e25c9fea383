import json
import random

import pytest
from pyspark.sql import functions as F

from layerflow.operators import increment as oi
from layerflow.operators.schema import discover_schema, merge_schemas
from layerflow.operators.shred import shred_children, shred_parent
from layerflow.session import shared_dir
from layerflow.sources.groups import GroupedTable, files_of, parts_bound, publish_changes
from layerflow.sources.layers import LayerStore


def docs_of(spark, docs):
    rows = [(str(d["id"]), json.dumps(d)) for d in docs]
    return spark.createDataFrame(rows, "id string, text string").select("id", F.parse_json("text").alias("doc"))


def review(i, n=2, **more):
    return {"id": f"r{i}", "score": i, "items": [{"name": f"a{k}", "v": k * 10 + i % 3} for k in range(n)], **more}


def store_of(spark):
    return LayerStore(spark, shared_dir(spark, "increment-test"))


def step(store, docs, **kw):
    inc = oi.shred_increment(store, "raw", "reviews", docs, **kw)
    store.publish("raw", {}, inc.extra)
    return inc


def rows_of(df, columns=None):
    return sorted((tuple(r[c] for c in columns or sorted(df.columns)) for r in df.collect()), key=str)


def states(store):
    return store.current("raw")["groups"]


def test_only_changed_documents_are_shredded(spark):
    store = store_of(spark)
    day1 = [review(i) for i in range(12)]
    step(store, docs_of(spark, day1))
    before = states(store)
    again = step(store, docs_of(spark, day1))
    assert again.rows_written == {"reviews": 0, "reviews_items": 0} and states(store) == before
    assert {r["status"] for r in again.feed.collect()} == {"unchanged"}
    # one list changed, one scalar changed, one document is new, one list goes
    day2 = [review(3, 3), {**review(4), "score": 99}, review(50), {"id": "r5", "score": 5}, review(6)]
    inc = step(store, docs_of(spark, day2))
    assert inc.rows_written == {"reviews": 4, "reviews_items": 3 + 2 + 1}  # r5's children end in one row that is not live
    assert files_of(before["reviews_items"]) <= files_of(states(store)["reviews_items"])
    kids = {}
    for r in store.table("raw", "reviews_items").collect():
        kids.setdefault(r["parent_id"], []).append(r["name"])
    assert sorted(kids["r3"]) == ["a0", "a1", "a2"] and "r5" not in kids and len(kids) == 12
    assert {r["id"]: r["score"] for r in store.table("raw", "reviews").collect()}["r4"] == 99


def test_equal_to_a_full_build_over_random_days(spark):
    r = random.Random(8)
    store, now = store_of(spark), {}
    for _ in range(5):
        day = [review(r.randrange(30), r.randrange(4), **({"note": r.choice(("x", None))} if r.random() < 0.3 else {})) for _ in range(9)]
        day = list({d["id"]: d for d in day}.values())
        now |= {d["id"]: d for d in day}
        step(store, docs_of(spark, day), max_parts=2, buckets=3)
    full = docs_of(spark, now.values())
    schema = merge_schemas(oi.stored_schema(store, "raw", "reviews"), discover_schema(full)).collect()
    parent, kids = shred_parent(full, schema), shred_children(full, schema, "items", "items")
    assert rows_of(store.table("raw", "reviews")) == rows_of(parent)
    columns = ["parent_id", "row_hash", "name", "v"]
    assert rows_of(store.table("raw", "reviews_items"), columns) == rows_of(kids, columns)
    ids = [x["id"] for x in store.table("raw", "reviews_items").collect()]
    assert len(set(ids)) == len(ids) and parts_bound(states(store)["reviews_items"]) <= 2


def test_ids_stay_over_runs_and_retries(spark):
    store = store_of(spark)
    known = []
    for n in (2, 3, 2, 4):
        docs = docs_of(spark, [review(i, n if i % 2 else 2) for i in range(8)] + [review(100 + n, 1)])
        oi.shred_increment(store, "raw", "reviews", docs)  # a run that dies before its publish
        step(store, docs)
        known.append({(r["parent_id"], r["row_hash"]): r["id"] for r in store.table("raw", "reviews_items").collect()})
    for a, b in zip(known, known[1:], strict=False):
        assert all(b[k] == v for k, v in a.items() if k in b)
        assert not set(b.values()) - set(a.values()) or min(set(b.values()) - set(a.values())) > max(a.values())
    assert sorted(known[0].values()) == list(range(1, len(known[0]) + 1))


def test_drift_adds_and_widens_columns(spark):
    store = store_of(spark)
    step(store, docs_of(spark, [{"id": "a", "n": 1, "f": True, "items": [{"v": 1}]}, {"id": "b", "n": 2, "items": [{"v": 2}]}]))
    first = files_of(states(store)["reviews"])
    step(store, docs_of(spark, [{"id": "c", "n": 2.5, "f": "x", "new": "y", "items": [{"v": "text", "w": 7}]}]))
    table = store.table("raw", "reviews")
    types = dict(table.dtypes)
    assert (types["n"], types["f"], types["new"]) == ("double", "string", "string")
    assert {r["id"]: (r["n"], r["f"], r["new"]) for r in table.collect()} == \
        {"a": (1.0, "true", None), "b": (2.0, None, None), "c": (2.5, "x", "y")}
    assert {(r["parent_id"], r["v"], r["w"]) for r in store.table("raw", "reviews_items").collect()} == \
        {("a", "1", None), ("b", "2", None), ("c", "text", 7)}
    assert first <= files_of(states(store)["reviews"]) and len(states(store)["reviews"]["schemas"]) == 2
    # a narrower value later changes nothing
    step(store, docs_of(spark, [{"id": "d", "n": 3, "items": []}]))
    assert dict(store.table("raw", "reviews").dtypes)["n"] == "double"


def test_schema_by_parts_equals_full_discovery(spark):
    r = random.Random(5)
    values = [1, 2.5, "x", True, None, "2024-01-01", [1], [{"k": 1}], {"o": 1}]
    docs = [{"id": str(i), **{k: r.choice(values) for k in "pqrst" if r.random() < 0.7}} for i in range(40)]
    want = rows_of(discover_schema(docs_of(spark, docs)))
    for cut in (7, 20):
        parts = [docs_of(spark, docs[:cut]), docs_of(spark, docs[cut:])]
        assert rows_of(merge_schemas(discover_schema(parts[0]), discover_schema(parts[1]))) == want


def test_delete_takes_the_children_along(spark):
    store = store_of(spark)
    step(store, docs_of(spark, [review(i) for i in range(6)]))
    written = oi.delete_documents(store, "raw", "reviews", spark.createDataFrame([("r1",), ("r4",), ("none",)], "id string"))
    assert written == {"reviews": 2, "reviews_items": 2}
    assert {r["id"] for r in store.table("raw", "reviews").collect()} == {"r0", "r2", "r3", "r5"}
    assert {r["parent_id"] for r in store.table("raw", "reviews_items").collect()} == {"r0", "r2", "r3", "r5"}
    step(store, docs_of(spark, [review(1)]))  # it may come back, with new ids
    ids = [r["id"] for r in store.table("raw", "reviews_items").where("parent_id = 'r1'").collect()]
    assert len(ids) == 2 and min(ids) > 12


def test_concurrent_change_is_refused(spark):
    store = store_of(spark)
    table = GroupedTable(store, "raw", "t", "g")
    rows = spark.createDataFrame([("a", 1)], "g string, x int")
    one, two = table.replace(rows, rows), table.replace(rows, rows)
    store.publish("raw", {}, publish_changes({"t": (table, one)}))
    with pytest.raises(RuntimeError):
        store.publish("raw", {}, publish_changes({"t": (table, two)}))


def test_empty_batches_and_clashing_names(spark):
    store = store_of(spark)
    inc = step(store, docs_of(spark, []))
    assert inc.rows_written == {"reviews": 0} and inc.tables["reviews"].count() == 0
    step(store, docs_of(spark, [{"id": "a", "bucket": 1, "run": 2, "items": [{"id": 5, "bucket": "z", "parent_id": "q"}]}]))
    row, kid = store.table("raw", "reviews").first(), store.table("raw", "reviews_items").first()
    assert (row["bucket"], row["run"]) == (1, 2)
    assert (kid["item_id"], kid["bucket"], kid["item_parent_id"], kid["id"]) == (5, "z", "q", 1)


def test_outgrown_buckets_are_dealt_anew(spark, monkeypatch):
    import layerflow.sources.groups as g
    monkeypatch.setattr(g, "BUCKET_ROWS", 5)
    store = store_of(spark)
    for day in range(4):
        step(store, docs_of(spark, [review(100 * day + i, 1) for i in range(60)]))
    assert states(store)["reviews"]["count"] >= 16
    assert store.table("raw", "reviews").count() == store.table("raw", "reviews_items").count() == 240
