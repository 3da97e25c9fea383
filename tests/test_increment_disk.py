"""What an increment needs on disk between its steps (round 4, F1)."""
import os

import pytest
from pyspark.sql import functions as F

from layerflow import session
from layerflow.operators import increment as oi
from layerflow.session import Aside, checkpoint_root, shared_dir
from layerflow.sources import groups
from layerflow.sources.groups import GroupedTable, publish_changes
from layerflow.sources.layers import LayerStore


def docs_of(spark, keys, lines=3, shift=0):
    """Orders with lines; ``shift`` changes the lines of every third order."""
    k = F.col("k")
    q = k * 10 + F.when(k % 3 == 0, F.lit(shift)).otherwise(F.lit(0))
    parts = [F.concat(F.lit(f'{{"n":{n},"q":'), q.cast("string"), F.lit("}")) for n in range(lines)]
    text = F.concat(F.lit('{"id":"'), k.cast("string"), F.lit('","lines":['), F.concat_ws(",", *parts), F.lit("]}"))
    return spark.range(keys.start, keys.stop).toDF("k").select(k.cast("string").alias("id"), F.parse_json(text).alias("doc"))


def three_days(spark):
    store = LayerStore(spark, shared_dir(spark, "increment-disk"))
    for docs in (docs_of(spark, range(0, 60)), docs_of(spark, range(30, 90), shift=1), docs_of(spark, range(0, 90), shift=2)):
        store.publish("raw", {}, oi.shred_increment(store, "raw", "orders", docs).extra)
    return store


def rows_of(store):
    columns = ["id", "parent_id", "row_hash", "n", "q"]
    return sorted(tuple(r) for r in store.table("raw", "orders_lines").select(*columns).collect())


def test_no_document_or_child_row_is_checkpointed(spark, monkeypatch):
    """Checkpoints are plain rows that stay until the garbage is collected: an
    increment makes none of documents, items or child rows, and leaves nothing of
    what it set aside."""
    frame = type(spark.range(1))
    seen, plain = [], frame.checkpoint

    def checkpoint(self, *args, **options):
        seen.append(set(self.columns))
        return plain(self, *args, **options)

    monkeypatch.setattr(frame, "checkpoint", checkpoint)
    three_days(spark)
    assert not [c for c in seen if c & {"doc", "row_hash", "item_json", "parent_id", "new_hash"}]
    own = f"{checkpoint_root(spark).replace('file:', '')}/layerflow"
    assert not [d for d in os.listdir(own) if d.startswith("aside-")]


def test_passes_change_no_row_and_no_id(spark, monkeypatch):
    want = rows_of(three_days(spark))
    monkeypatch.setattr(groups, "PASS_ROWS", 20)
    store = three_days(spark)
    assert rows_of(store) == want
    assert [r[0] for r in want] == sorted({r[0] for r in want}) and len(want) == 90 * 3
    stored = {r["id"]: r["q"] for r in store.table("raw", "orders_lines").select(F.col("parent_id").alias("id"), "q").collect()}
    assert stored["3"] == 32 and stored["4"] == 40


def test_rows_of_the_last_file_are_not_shuffled(spark):
    """Of a bucket with several files only the earlier ones' rows meet a join."""
    store = LayerStore(spark, shared_dir(spark, "increment-disk"))
    table = GroupedTable(store, "raw", "t", "g", buckets=1)
    for rows, touched in (([("a", 1), ("b", 1), ("c", 1)], "abc"), ([("a", 2), ("a", 3)], "a"), ([("b", 4)], "bc")):
        new = spark.createDataFrame(rows, "g string, x int")
        change = table.replace(new, spark.createDataFrame([(g,) for g in touched], "g string"))
        store.publish("raw", {}, publish_changes({"t": (table, change)}))
    got = table.read()
    assert sorted(map(tuple, got.collect())) == [("a", 2), ("a", 3), ("b", 4)]
    plan = got._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("Join") == 1
    assert "Union" in plan.toString().split("Join")[0]


def test_writes_drop_their_shuffles_and_restore_the_setting(spark):
    before = spark.conf.get(session.SHUFFLE_CLEANUP, None)
    with pytest.raises(RuntimeError), Aside(spark, "t") as aside:
        kept = aside.keep(spark.range(5).toDF("x"), spark.range(5, 7).toDF("x"))
        assert sorted(r["x"] for r in kept.collect()) == list(range(7))
        path = aside.root.replace("file:", "")
        assert os.path.isdir(path)
        raise RuntimeError("a run that dies")
    assert not os.path.exists(path)
    assert spark.conf.get(session.SHUFFLE_CLEANUP, None) == before
