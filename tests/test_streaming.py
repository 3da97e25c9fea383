"""Page files -> streaming field upsert; replays change nothing."""
import json
import os
import tempfile

from pyspark.sql import functions as F

from layerflow.sources import layers as sl
from layerflow.streaming import pages as st


def _state(store):
    return {(r.id, r.field): r.value_json for r in store.table("docs", "reviews").collect()}


def test_page_stream_upsert_and_replay(spark):
    root = tempfile.mkdtemp()
    os.makedirs(f"{root}/in")
    pages = [{"page": 1, "data": [{"id": "a", "x": 1, "y": 1}, {"id": "b", "x": 5}]},
             {"page": 2, "data": [{"id": "a", "y": None}, 7, {"z": 1}]},
             {"page": 3, "data": [{"id": "a", "x": 3}]}]
    for p in pages:
        with open(f"{root}/in/page-{p['page']:04d}.json", "w") as f:
            f.write(json.dumps(p) + "\n")
    store = sl.LayerStore(spark, f"{root}/store")
    st.run_page_upsert(spark, f"{root}/in", store, "docs", "reviews", f"{root}/ckpt",
                       max_files_per_trigger=1).awaitTermination()
    want = {("a", "id"): '"a"', ("a", "x"): "3", ("a", "y"): "null", ("b", "id"): '"b"', ("b", "x"): "5"}
    assert _state(store) == want
    # U2 totals: a, b new on page 1; a matched and modified on pages 2 and 3
    assert store.current("docs")["stream_metrics"]["reviews"] == {"upserted": 2, "matched": 2, "modified": 2}
    seq_before = store.current("docs")["seq"]
    # a replayed micro-batch (same query and id) is a no-op
    batch = spark.createDataFrame([(2, "x", json.dumps(pages[1]))], "page bigint, source string, payload string")
    st.upsert_batch(store, "docs", "reviews", batch, 0, query_id=st.query_id(f"{root}/ckpt", spark))
    assert store.current("docs")["seq"] == seq_before
    # restarting from the checkpoint finds nothing new
    st.run_page_upsert(spark, f"{root}/in", store, "docs", "reviews", f"{root}/ckpt").awaitTermination()
    assert store.current("docs")["seq"] == seq_before and _state(store) == want
    # rejected elements are stored with the batch
    assert {(r.reason, r.dropped) for r in store.table("docs", "reviews__rejects").collect()} == {("not_object", 1), ("no_id", 1)}
    # another stream's batch 0 counts; its page comes later, whatever its number
    new = spark.createDataFrame([(1, "y", json.dumps({"data": [{"id": "a", "x": 9}]}))], "page bigint, source string, payload string")
    st.upsert_batch(store, "docs", "reviews", new, 0, query_id="another stream")
    assert _state(store) == {**want, ("a", "x"): "9"}


def test_page_stream_whole_file_pages(spark):
    root = tempfile.mkdtemp()
    os.makedirs(f"{root}/in")
    for n, data in ((1, [{"id": "a", "x": 1}]), (2, [{"id": "a", "x": 2}, {"id": "b", "x": 9}])):
        with open(f"{root}/in/page-{n:04d}.json", "w") as f:
            json.dump({"data": data}, f, indent=2)      # multi-line: one page per file
    store = sl.LayerStore(spark, f"{root}/store")
    st.run_page_upsert(spark, f"{root}/in", store, "docs", "reviews", f"{root}/ckpt",
                       whole_file=True).awaitTermination()
    assert _state(store) == {("a", "id"): '"a"', ("a", "x"): "2", ("b", "id"): '"b"', ("b", "x"): "9"}


def _pages(spark, rows):
    return spark.createDataFrame([(n, f"p{n}", json.dumps({"data": data})) for n, data in rows], "page bigint, source string, payload string")


def test_bad_pages_are_stored_and_other_tables_published_between(spark):
    store = sl.LayerStore(spark, tempfile.mkdtemp())
    bad = spark.createDataFrame([(1, "s", "{oops"), (2, "s", '{"data": [{"id": "a", "x": 1}]}')], "page bigint, source string, payload string")
    st.upsert_batch(store, "docs", "reviews", bad, 0, query_id="q")
    assert [(r.reason, r.payload) for r in store.table("docs", "reviews__quarantine").collect()] == [("bad_json", "{oops")]
    store.guarded_load("docs", "other", spark.range(2).toDF("x"))
    st.upsert_batch(store, "docs", "reviews", _pages(spark, [(1, [{"id": "b", "x": 2}])]), 1, query_id="q")
    assert _state(store)[("a", "x")] == "1" and _state(store)[("b", "x")] == "2"
    assert st.upsert_batch(store, "docs", "reviews", _pages(spark, [(1, [{"id": "b", "x": 3}])]), 1, query_id="q") is None


def test_bucket_count_is_stored_and_changed_whole(spark):
    store = sl.LayerStore(spark, tempfile.mkdtemp())
    first = [{"id": f"d{i}", "x": i} for i in range(40)]
    st.upsert_batch(store, "docs", "reviews", _pages(spark, [(5, first)]), buckets=8)
    assert store.current("docs")["bucket_counts"] == {"reviews": 8}
    st.upsert_batch(store, "docs", "reviews", _pages(spark, [(1, [{"id": "d1", "x": 100}])]))          # keeps 8
    assert store.current("docs")["bucket_counts"] == {"reviews": 8}
    st.upsert_batch(store, "docs", "reviews", _pages(spark, [(1, [{"id": "d2", "x": 200}])]), buckets=3)
    state = _state(store)
    assert store.current("docs")["bucket_counts"] == {"reviews": 3} and len(store.current("docs")["buckets"]["reviews"]) <= 3
    assert store.table("docs", "reviews").count() == 80 == len(state)
    assert state[("d1", "x")] == "100" and state[("d2", "x")] == "200" and state[("d3", "x")] == "3"
