"""Property tests against brute-force models on small generated fixtures."""
import hashlib
import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from layerflow.functions import names
from layerflow.operators import shred as osh
from layerflow.operators import upsert as ou

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))

scalars = st.one_of(st.none(), st.booleans(), st.integers(-5, 5), st.text("ab", max_size=2))
docs = st.lists(st.tuples(st.sampled_from(["1", "2", "3"]),
                          st.dictionaries(st.sampled_from(["a", "b", "c"]), scalars, max_size=3)),
                min_size=1, max_size=8)


def _canon(v):
    return json.dumps(v, separators=(",", ":"), sort_keys=True)


@SETTINGS
@given(docs)
def test_field_upsert_matches_sequential_set(spark, batch):
    # brute force: apply each document's fields in delivery order
    model: dict = {}
    for i, (k, d) in enumerate(batch):
        model.setdefault(k, {"id": k}).update(d)
    rows = [(k, json.dumps({"id": k, **d}), i) for i, (k, d) in enumerate(batch)]
    df = spark.createDataFrame(rows, "id string, j string, seq int").select(
        "id", F.parse_json("j").alias("doc"), "seq")
    state = ou.field_upsert(None, ou.document_fields(df, "seq"))
    got = {(r.id, r.field): r.value_json for r in state.collect()}
    want = {(k, f): _canon(v) for k, d in model.items() for f, v in d.items()}
    assert got == want
    # replaying any prefix of the batch changes nothing
    again = ou.field_upsert(state, ou.document_fields(df.where(F.col("seq") < len(rows) // 2), "seq"))
    assert {(r.id, r.field): r.value_json for r in again.collect()} == got


items = st.lists(st.dictionaries(st.sampled_from(["x", "y"]), st.integers(0, 2), min_size=1, max_size=2),
                 max_size=6)


@SETTINGS
@given(items)
def test_child_dedup_keeps_first_occurrence(spark, lst):
    seen, want = set(), []
    for it in lst:
        c = _canon(it)
        if c not in seen:
            seen.add(c)
            want.append(it)
    df = spark.createDataFrame([("p", json.dumps({"id": "p", "l": lst}))], "id string, j string") \
        .select("id", F.parse_json("j").alias("doc"))
    got = df.select(F.explode(osh.dedup_objects_json(F.col("doc").try_cast("map<string,variant>")["l"]))).collect()
    assert [json.loads(r[0]) for r in got] == want


@SETTINGS
@given(st.lists(st.text(max_size=80), min_size=1, max_size=10))
def test_sanitize_column_equals_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(names.sanitize_identifier_col("v")).collect()]
    for name, v in zip(got, values):
        plain = "".join(c.lower() if c.isascii() and (c.isalnum() or c == "_") else "_" for c in v).strip("_") or "col"
        cut = plain if len(plain) <= 64 else f"{plain[:55]}_{hashlib.md5(plain.encode()).hexdigest()[:8]}"
        # Java counts a character outside the basic plane as two
        assert name == cut or any(ord(c) > 0xFFFF for c in v)


@SETTINGS
@given(st.lists(st.text(max_size=12), min_size=1, max_size=15))
def test_clean_column_names_unique_and_well_formed(spark, headers):
    import re
    out = names.clean_column_names(spark, headers)
    assert len(out) == len(headers) and len(set(out)) == len(out)
    assert all(re.fullmatch(r"[a-z0-9_]+", n) and not n.startswith("_") for n in out)


@SETTINGS
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60, unique=True), st.integers(1, 7))
def test_dense_ids_are_one_to_n_in_key_order(spark, keys, parts):
    from layerflow.operators.keys import dense_ids
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    got = sorted((r.k, r.rid) for r in dense_ids(df, ["k"], "rid", num_partitions=parts).collect())
    assert [rid for _, rid in got] == list(range(1, len(keys) + 1))
