"""Sources and sinks: CSV (S5-S7, P2), layer store (S8-S10), dense ids
(U7), checks (V*), and plan properties."""
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from layerflow.operators import checks
from layerflow.operators.keys import dense_ids
from layerflow.sources import csv as scsv
from layerflow.sources import layers as sl


def _write(path, text, bom=False):
    with open(path, "wb") as f:
        if bom:
            f.write(b"\xef\xbb\xbf")
        f.write(text.encode("utf-8"))
    return path


def test_csv_all_string(spark):
    d = tempfile.mkdtemp()
    p = _write(os.path.join(d, "Propriedades.csv"),
               'Id,Máx.Ocupação,  ,A b,a_b,Note\n1,3,x,NA,None,"two\nlines"\n2,,y,n/a,ok,plain\n', bom=True)
    df = scsv.read_csv_all_string(spark, p)
    assert df.columns == ["id", "m_x_ocupa_o", "unnamed_column", "a_b", "a_b_1", "note"]
    assert all(t == "string" for _, t in df.dtypes)
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [("1", "3", "x", None, None, "two\nlines"), ("2", None, "y", None, "ok", "plain")]


def test_csv_expected_columns_and_empty(spark):
    d = tempfile.mkdtemp()
    p = _write(os.path.join(d, "t.csv"), "a,b\n")
    df = scsv.read_csv_all_string(spark, p, expected_columns=["a"])
    assert df.isEmpty()                              # S6: the daily job keeps the live table
    with pytest.raises(scsv.SchemaMismatch) as e:
        scsv.read_csv_all_string(spark, p, expected_columns=["a", "zz"])
    assert "zz" in str(e.value)


def test_publish_is_all_or_nothing(spark):
    store = sl.LayerStore(spark, tempfile.mkdtemp())
    a = spark.range(5).toDF("x")
    store.build_and_publish("rel", {"a": a, "b": a.limit(2)})

    def boom():
        raise RuntimeError("fail")
    with pytest.raises(RuntimeError):
        store.build_and_publish("rel", {"a": a.limit(1), "b": boom})
    assert store.table("rel", "a").count() == 5 and store.table("rel", "b").count() == 2
    with pytest.raises(sl.LoadGuardError):
        store.guarded_load("rel", "a", a.limit(0), min_rows=1)
    assert store.table("rel", "a").count() == 5
    res = store.write_version("rel", "c", a)
    assert res.rows_observed == res.rows_stored == 5


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_dense_ids(spark, parts):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    out = dense_ids(df, ["k"], "rid", num_partitions=parts).collect()
    ids = sorted(r.rid for r in out)
    assert ids == list(range(1, 1001))
    assert all(r.rid == r.k + 1 for r in out)


def _layers(spark, bad=None):
    n = 120
    rev = spark.range(n).select(F.col("id").cast("string").alias("review_id"),
                                F.lit(7.0).alias("overall_score"), F.lit("2024-01-01").alias("arrival_date"),
                                F.lit("2024-01-03").alias("departure_date"),
                                F.lit("2024-01-01 00:00:00").alias("created_at"),
                                F.lit(1).alias("external_property_id"), F.lit("DIRECT").alias("sales_channel_code"))
    asp = spark.range(n).select(F.col("id").alias("aspect_id"), F.col("id").cast("string").alias("review_id"),
                                F.lit("A").alias("aspect"), F.lit(6.0).alias("score"))
    props = spark.range(20).select(F.col("id").alias("property_id"))
    raw = {"reviews": rev, "reviews_evaluationaspects": asp, "propriedades": props}
    clean = {"reviews": rev, "review_aspects": asp, "properties": props}
    if bad == "V2":
        small = props.where(F.col("property_id") < 5)
        raw["propriedades"], clean["properties"] = small, small
    rel = dict(clean)
    if bad == "V1":
        rel["reviews"] = rev.where(F.col("review_id") != "7")
    if bad == "V3":
        rel["review_aspects"] = asp.withColumn("aspect_id", F.when(F.col("aspect_id") == 1, 2).otherwise(F.col("aspect_id")))
    if bad == "V4":   # both layers, so score parity (V9) still holds
        clean["reviews"] = rel["reviews"] = rev.withColumn(
            "overall_score", F.when(F.col("review_id") == "3", 11.0).otherwise(7.0))
    if bad == "V5":
        clean["reviews"] = rel["reviews"] = rev.withColumn("overall_score", F.lit(2.0))
    if bad == "V6":
        rel["reviews"] = rev.withColumn("departure_date", F.lit("2023-12-01"))
    if bad == "V7":
        rel["reviews"] = rev.withColumn("sales_channel_code", F.when(F.col("review_id") == "5", None)
                                        .otherwise(F.col("sales_channel_code")))
    if bad == "V8":
        rel["review_aspects"] = asp.withColumn("review_id", F.when(F.col("aspect_id") == 1, "zz")
                                               .otherwise(F.col("review_id")))
    if bad == "V9":
        rel["reviews"] = rev.withColumn("review_id", F.when(F.col("review_id") == "9", "x9").otherwise(F.col("review_id")))
    return {"raw": raw, "clean": clean, "rel": rel}


def test_checks_pass_and_mutations(spark):
    rep = {r.check_id: r for r in checks.run_checks(_layers(spark), "2026-01-01 00:00:00").collect()}
    assert len(rep) == 44
    assert all(r.status == "PASS" for r in rep.values())
    # non-PASS (family, status) pairs each single mutation must produce: a
    # review missing from the relational layer also orphans its aspect and
    # breaks id parity
    expect = {"V1": {("V1", "FAIL"), ("V8", "FAIL"), ("V9", "FAIL")}, "V2": {("V2", "FAIL")},
              "V3": {("V3", "FAIL")}, "V4": {("V4", "FAIL")}, "V5": {("V5", "WARN")}, "V6": {("V6", "WARN")},
              "V7": {("V7", "FAIL")}, "V8": {("V8", "FAIL")}, "V9": {("V8", "FAIL"), ("V9", "FAIL")}}
    for fam, want in expect.items():
        r = checks.run_checks(_layers(spark, fam), "2026-01-01 00:00:00")
        hit = {(x.family, x.status) for x in r.where(F.col("status") != "PASS").collect()}
        assert hit == want, (fam, hit)


def test_incremental_resume_pushes_filter(spark, sf_dir):
    df = sl.scan_after(spark.read.parquet(f"{sf_dir}/orders.parquet"), "o_orderkey", 100)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderkey), GreaterThan(o_orderkey,100)]" in plan


def test_incremental_load_resumes(spark):
    store = sl.LayerStore(spark, tempfile.mkdtemp())
    src = spark.range(1, 101).toDF("k")
    store.commit_increment("raw", "t", src.where("k <= 40"), "k", done=False)
    assert store.high_water_mark("raw", "t") == 40
    store.commit_increment("raw", "t", sl.scan_after(src, "k", 40), "k", done=True)
    assert store.high_water_mark("raw", "t") is None
    got = sorted(r.k for r in store.increments("raw", "t").collect())
    assert got == list(range(1, 101))
    # a second full pass overwrites by key, even while it is not complete
    again = src.withColumn("v", F.lit("new"))
    store.commit_increment("raw", "t", again.where("k <= 70"), "k", done=False)
    rows = store.increments("raw", "t", "run").collect()
    assert sorted(r.k for r in rows) == list(range(1, 101)) and sum(r.v == "new" for r in rows) == 70
    store.commit_increment("raw", "t", sl.scan_after(again, "k", 70), "k", done=True)
    rows = store.increments("raw", "t", "run").collect()
    assert sorted(r.k for r in rows) == list(range(1, 101)) and {r.run for r in rows} == {3, 4}


def _expected(passes):
    """Rows (key, value, run) of the latest pass of each key; a pass: its runs,
    each a list of (key, value)."""
    held, run = {}, 0
    for runs in passes:
        own = {}
        for rows in runs:
            run += 1
            for k, v in rows:
                own.setdefault(k, []).append((k, v, run))
        held |= own
    return sorted((r for rows in held.values() for r in rows), key=str)


def test_increments_fold_to_a_bounded_plan(spark):
    store = sl.LayerStore(spark, tempfile.mkdtemp())
    store.FOLD_AT = 3
    rng, passes, sizes = random.Random(7), [], []
    for n in range(50):
        open_pass = n % 5 == 3                     # its second run comes next
        rows = [(rng.choice([None, *range(12)]), n) for _ in range(rng.randrange(6))]
        rows += rows[:1]                           # a repeated row stays, within its pass
        if n % 5 == 4:
            passes[-1].append(rows)
        else:
            passes.append([rows])
        store.commit_increment("raw", "t", spark.createDataFrame(rows, "k int, v int").coalesce(1), "k", done=not open_pass)
        parts = sl.increment_state(store.current("raw"), "t")["parts"]
        sizes.append(len(parts))
        if n in (13, 31, 49):
            got = sorted(((r.k, r.v, r.run) for r in store.increments("raw", "t", "run").collect()), key=str)
            assert got == _expected(passes), n
    assert max(sizes) <= store.FOLD_AT * store.LEVELS and parts[0]["level"] == store.LEVELS
    plan = store.increments("raw", "t")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") <= 2 * store.FOLD_AT * store.LEVELS
    before = len(store.fs.list_names(f"{store.root}/raw/t__part"))
    store.vacuum("raw", keep=1, min_age=0)          # folded parts can go
    assert len(store.fs.list_names(f"{store.root}/raw/t__part")) == len(parts) < before
    assert sorted(((r.k, r.v, r.run) for r in store.increments("raw", "t", "run").collect()), key=str) == _expected(passes)


def test_fold_loses_to_another_writer_and_survives_a_crash(spark, monkeypatch):
    store = sl.LayerStore(spark, tempfile.mkdtemp())
    store.FOLD_AT = 2
    fold, publish = sl.LayerStore.fold_increments, sl.LayerStore.publish
    monkeypatch.setattr(sl.LayerStore, "fold_increments", lambda *a: None)  # each writer ends before it folds
    for n in range(3):
        store.commit_increment("raw", "t", spark.createDataFrame([(1, n), (n + 10, n)], "k int, v int"), "k", done=True)
    want = [(1, 2), (10, 0), (11, 1), (12, 2)]
    assert sorted(map(tuple, store.increments("raw", "t").collect())) == want

    def beaten(self, *args):
        monkeypatch.setattr(sl.LayerStore, "publish", publish)
        fold(self, "raw", "t")                     # another writer folds first
        return publish(self, *args)

    monkeypatch.setattr(sl.LayerStore, "publish", beaten)
    fold(store, "raw", "t")
    assert len(sl.increment_state(store.current("raw"), "t")["parts"]) == 1
    assert sorted(map(tuple, store.increments("raw", "t").collect())) == want


def test_increments_with_clashing_names_new_columns_and_old_manifests(spark):
    store = sl.LayerStore(spark, tempfile.mkdtemp())
    store.FOLD_AT = 2
    store.commit_increment("raw", "t", spark.createDataFrame([(1, 5, 6), (2, 5, 6)], "`a.k` int, __pass int, __RUN int"), "a.k", done=True)
    store.commit_increment("raw", "t", spark.createDataFrame([(2, 7)], "`a.k` bigint, extra int"), "a.k", done=True)
    store.commit_increment("raw", "t", spark.createDataFrame([], "`a.k` bigint, extra int"), "a.k", done=True)
    rows = sorted(tuple(r[c] for c in ("a.k", "__pass", "__RUN", "extra", "load")) for r in store.increments("raw", "t", "load").collect())
    assert rows == [(1, 5, 6, None, 1), (2, None, None, 7, 2)]
    with pytest.raises(ValueError):
        store.commit_increment("raw", "t", spark.range(1).toDF("other"), "other", done=True)
    # the form that earlier releases wrote
    paths = [store.write_version("raw", "u__part", spark.createDataFrame([(1, n)], "k int, v int")).path for n in range(2)]
    store.publish("raw", {}, lambda cur: {"parts": {**cur["parts"], "u": {
        "key": "k", "open": False, "runs": 2, "passes": [[{"path": paths[0], "run": 1}], [{"path": paths[1], "run": 2}]]}}})
    assert [tuple(r) for r in store.increments("raw", "u", "run").collect()] == [(1, 1, 2)]
    store.commit_increment("raw", "u", spark.createDataFrame([(3, 3)], "k int, v int"), "k", done=True)
    assert sorted(map(tuple, store.increments("raw", "u", "run").collect())) == [(1, 1, 2), (3, 3, 3)]


def test_publish_keeps_the_other_state_of_a_layer(spark):
    store = sl.LayerStore(spark, tempfile.mkdtemp())
    a = spark.range(3).toDF("x")
    store.build_and_publish("docs", {"a": a}, extra=lambda cur: {"marks": {"q": 1}})
    store.guarded_load("docs", "b", a)
    now = store.current("docs")
    assert now["marks"] == {"q": 1} and set(now["tables"]) == {"a", "b"}
    # a lost race: the state is computed again from the manifest that won
    seen = []

    def counted(cur):
        if not seen:
            seen.append(cur["seq"])
            sl.LayerStore(spark, store.root).publish("docs", {}, lambda c: {"n": c.get("n", 0) + 1})
        return {"n": cur.get("n", 0) + 1}
    store.publish("docs", {}, counted)
    assert store.current("docs")["n"] == 2 and store.current("docs")["marks"] == {"q": 1}
    assert not store.fs.create_new(f"{store.root}/_commits/{1:012d}.json", "{}")   # never replaced


def test_csv_surplus_fields_and_differing_headers(spark):
    d = tempfile.mkdtemp()
    _write(os.path.join(d, "a.csv"), 'a,b\n1,2\n1,2,3\n4\n5,6,\n"x,y",""\n')
    got = scsv.read_csv(spark, d)
    assert sorted((tuple(r) for r in got.rows.collect()), key=str) == sorted([("1", "2"), ("4", None), ("5", "6"), ("x,y", None)], key=str)
    assert [r.record for r in got.rejects.collect()] == ['["1","2","3"]']
    _write(os.path.join(d, "b.csv"), "b,a\n1,2\n")
    with pytest.raises(scsv.SchemaMismatch):
        scsv.read_csv(spark, d)


def test_no_machine_local_folder_on_a_cluster(spark, monkeypatch):
    from layerflow import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


def test_no_python_udf_in_model_plans(spark, sf_dir):
    from layerflow.plans.catalog import QUERIES
    for name in ("fact_reviews", "typed_properties", "floor_audit", "shred_children"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_relational_layout_skips_row_groups(spark, sf_dir):
    from layerflow.plans.catalog import model
    m = model(spark, sf_dir)
    r = m.rel["reviews"]
    plan = r.where(F.col("arrival_date") == F.lit("1996-01-02").cast("date"))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PushedFilters: [IsNotNull(arrival_date), EqualTo(arrival_date" in plan
    # files hold disjoint, sorted ranges of the lookup column
    ranges = (r.groupBy(F.spark_partition_id().alias("p"))
              .agg(F.min("arrival_date").alias("lo"), F.max("arrival_date").alias("hi"))
              .orderBy("lo").collect())
    assert all(a.hi <= b.lo for a, b in zip(ranges, ranges[1:]))


def test_vacuum_drops_old_versions(spark):
    store = sl.LayerStore(spark, tempfile.mkdtemp())
    a = spark.range(3).toDF("x")
    store.build_and_publish("rel", {"a": a})
    store.build_and_publish("rel", {"a": a.limit(1)})
    assert store.vacuum("rel", keep=1) == []               # too young: another run may still write it
    dropped = store.vacuum("rel", keep=1, min_age=0)
    assert len(dropped) == 1 and store.table("rel", "a").count() == 1
    # committed increments are live, whatever layer state names them
    store.commit_increment("rel", "inc", a, "x", done=False)
    store.guarded_load("rel", "b", a)
    store.vacuum("rel", keep=1, min_age=0)
    assert store.increments("rel", "inc").count() == 3 and store.high_water_mark("rel", "inc") == 2


def test_constraint_gate(spark):
    from layerflow.operators import relational as orl
    ok = spark.createDataFrame([(1, "ab"), (2, "c")], "k int, t string")
    orl.enforce_table(ok, "t", ["k"], {"t": 5})
    for bad in (spark.createDataFrame([(1, "a"), (1, "b")], "k int, t string"),
                spark.createDataFrame([(None, "a")], "k int, t string"),
                spark.createDataFrame([(1, "toolong")], "k int, t string")):
        with pytest.raises(orl.ConstraintViolation):
            orl.enforce_table(bad, "t", ["k"], {"t": 5})
    # a UNIQUE key allows any number of NULLs but no repeated value
    orl.enforce_table(spark.createDataFrame([(None,), (None,), (1,)], "k int"), "u", ["k"], nulls_allowed=True)
    with pytest.raises(orl.ConstraintViolation):
        orl.enforce_table(spark.createDataFrame([(1,), (1,)], "k int"), "u", ["k"], nulls_allowed=True)


def test_csv_separator_and_encoding(spark):
    d = tempfile.mkdtemp()
    p = os.path.join(d, "props.csv")
    with open(p, "wb") as f:
        f.write("Código;Bairro\n1;Belém\n2;NULL\n".encode("latin-1"))
    df = scsv.read_csv_all_string(spark, p, sep=";", encoding="ISO-8859-1")
    assert df.columns == ["c_digo", "bairro"]
    assert sorted(tuple(r) for r in df.collect()) == [("1", "Belém"), ("2", None)]


def test_check_details(spark):
    rep = checks.with_details(checks.run_checks(_layers(spark, "V2"), "2026-01-01 00:00:00"))
    d = {r.check_name: r.detail for r in rep.collect()}
    assert d["raw.propriedades: at least 10 rows"] == "5 rows"
    assert d["raw/clean.reviews: equal row counts"] == "ok: row delta 0"


def test_dense_ids_presorted_matches_sorted(spark):
    df = spark.range(0, 500).select((F.col("id") * 13 % 500).alias("k"))
    base = {r.k: r.rid for r in dense_ids(df, ["k"], "rid").collect()}
    from layerflow.session import cut_lineage
    pre = cut_lineage(df.repartitionByRange(5, "k").sortWithinPartitions("k"))
    got = {r.k: r.rid for r in dense_ids(pre, ["k"], "rid", presorted=True).collect()}
    assert got == base


def test_csv_windows_line_endings(spark):
    d = tempfile.mkdtemp()
    p = _write(os.path.join(d, "m.csv"), 'Internal Id,External Id\r\n1,5000\r\n2,"50\r\n01"\r\n')
    df = scsv.read_csv_all_string(spark, p)
    assert df.columns == ["internal_id", "external_id"]
    # row-ending CRLFs leave no stray \r; a CRLF inside a quoted value is
    # normalised to \n by Spark's CSV parser
    assert sorted(tuple(r) for r in df.collect()) == [("1", "5000"), ("2", "50\n01")]


def test_one_commit_over_layers_survives_a_crash_at_any_step(spark):
    store = sl.LayerStore(spark, tempfile.mkdtemp())

    def change(n):
        return {layer: (store.build_aside(layer, {"t": spark.range(n)}), lambda now, n=n: {"run": n}) for layer in ("docs", "raw", "rel")}

    def seen(reader):
        return {(reader.table(layer, "t").count(), reader.current(layer)["run"]) for layer in ("docs", "raw", "rel")}

    store.publish_together(change(1))
    real = store.fs.create_new
    for step in range(4):                       # three manifests, then the commit
        after = change(2)
        for fails_before in (True, False) if step < 3 else (True,):
            calls = iter(range(10))

            def crash(path, text):
                if next(calls) == step:
                    if not fails_before:
                        real(path, text)
                    raise OSError("lost")
                return real(path, text)

            store.fs.create_new = crash
            with pytest.raises(OSError):
                store.publish_together(after)
            store.fs.create_new = real
            assert seen(sl.LayerStore(spark, store.root)) == {(1, 1)}
    reader = store.pinned()
    store.publish_together(change(2))
    store.vacuum("raw", keep=2, min_age=0)      # the pinned run is among the kept ones
    assert seen(store) == {(2, 2)} and seen(reader) == {(1, 1)}
    with pytest.raises(RuntimeError, match="pinned"):
        reader.publish("raw", {})
    store.vacuum("raw", keep=1, min_age=0)
    assert seen(store) == {(2, 2)}


def test_a_lost_race_starts_from_the_other_commit(spark):
    store, other = (sl.LayerStore(spark, root) for root in [tempfile.mkdtemp()] * 2)
    paths = {n: store.write_version("rel", n, spark.range(2)).path for n in ("a", "b")}
    runs = []

    def extra(now):
        if not runs:                            # the other writer is faster once
            other.publish("rel", {"b": paths["b"]}, lambda now: {"other": 1})
            other.publish("raw", {"b": paths["b"]})
        runs.append(now["seq"])
        return {"own": now["seq"]}

    store.publish_together({"rel": ({"a": paths["a"]}, extra)})
    cur = store.current("rel")
    assert runs == [0, 1] and set(cur["tables"]) == {"a", "b"} and (cur["other"], cur["own"], cur["seq"]) == (1, 1, 2)
    assert store.table("raw", "b").count() == 2
    assert len(store.fs.list_names(f"{store.root}/rel/_manifests")) == 2   # the lost one is gone


def test_a_layer_published_before_commits_were_kept(spark):
    import json
    store = sl.LayerStore(spark, tempfile.mkdtemp())
    path = store.write_version("rel", "a", spark.range(4)).path
    store.fs.create_new(f"{store.root}/rel/_manifests/{3:012d}.json", json.dumps({"seq": 3, "tables": {"a": path}}))
    assert store.table("rel", "a").count() == 4 and store.vacuum("rel", min_age=0) == []
    store.publish("rel", {"b": path})
    assert store.table("rel", "a").count() == 4 and store.current("rel")["seq"] == 4
