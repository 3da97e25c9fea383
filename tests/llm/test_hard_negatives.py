import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from layerflow.llm import hard_negatives as m

SCHEMA = "vec_id bigint, embedding array<double>, label int, rank int, anchor string"


def brute(rows):
    """Rows (id, vector, label) -> the contract's rows, in Python integers."""
    good = {(i, label, tuple(v)) for i, v, label in rows
            if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v)}
    good = [(i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]) for i, label, v in good]
    out = []
    for a, la, va in good:
        if a % 50:
            continue
        score = [(sum(p * q for p, q in zip(va, v, strict=True)), -i, label == la) for i, label, v in good if i != a and len(v) == len(va)]
        for ps, pid, _ in sorted((s for s in score if s[2]), reverse=True)[:5]:
            near = sorted((s for s in score if not s[2] and 50 * ps <= 100 * s[0] <= 95 * ps), reverse=True)[:3]
            out += [(a, -pid, r + 1, -n[1], ps, n[0]) for r, n in enumerate(near)]
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, label, 1, "x") for i, v, label in rows], SCHEMA)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = m.mine(df, F.col("vec_id") % 50 == 0, label=label, **kw)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def clustered(n, dim, seed=2, spread=0.6):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(6, dim))
    return [(i, (centres[i % 6] + spread * r.normal(size=dim)).tolist(), int(r.integers(0, 4))) for i in range(n)]


@pytest.mark.parametrize("dim", [3, 64, 100])
def test_matches_brute_force(spark, dim):
    rows = clustered(700, dim)
    want = brute(rows)
    assert want and run(spark, rows, block=150) == want


def test_intervals_hold_every_score_and_prune():
    r = np.random.default_rng(1)
    for dim, scale in ((1, 1), (5, 300), (64, 40), (200, 1000)):
        x, q = np.floor(r.normal(size=(400, dim)) * scale), np.floor(r.normal(size=(30, dim)) * scale)
        x[0] = 0
        low, high = m.Anchors(q).intervals(*m.coded(x))
        score = q @ x.T
        assert (low <= score).all() and (score <= high).all()
    side = np.where(np.arange(400) % 2 == 0, 1, -1)[:, None]  # rows near the anchor, and rows opposite
    low, high = m.Anchors(q[:1]).intervals(*m.coded(side * q[:1] + np.floor(r.normal(size=(400, 200)) * 100)))
    assert (high[0] < np.sort(low[0])[-5]).mean() == 0.5


def test_rotation_keeps_products():
    r = np.random.default_rng(1)
    x = r.integers(-300, 300, (20, 48)).astype(float)
    y = m.turned(x)
    assert y.shape == (20, 64) and np.array_equal(y @ y.T, 64 * (x @ x.T))


def test_ties_copies_and_hot_vectors(spark):
    """A third of the rows are one vector; scores tie everywhere."""
    rows = [(i, [1.0, 0.5, 0.0], i % 3) for i in range(300)] + [(300 + i, [0.5, 0.5, float(i % 4)], i % 2) for i in range(300)]
    assert run(spark, rows, block=64) == brute(rows)
    assert run(spark, rows + rows[:200], block=64) == brute(rows)


def test_rows_that_take_no_part_and_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(120, 4) + [(200, None, 1), (250, [nan, 1.0, 1.0, 1.0], 1), (300, [inf, 1.0, 1.0, 1.0], 1), (350, [None, 1.0, 1.0, 1.0], 1),
                                (400, [1.0] * 4, None), (None, [1.0] * 4, 1), (450, [0.0] * 4, 1), (500, [], 1), (501, [], 1), (502, [], 2)]
    rows += [(1000 + i, v, label) for i, v, label in clustered(90, 6, 5)]
    got = run(spark, rows)
    assert got == brute(rows) and {r[0] for r in got} >= {0, 50, 500, 1000, 1050}


def test_huge_components_are_exact(spark):
    rows = [(i, [x * 2.0 ** 20 for x in v], label) for i, v, label in clustered(120, 5)]
    assert max(abs(r[4]) for r in run(spark, rows)) > 2 ** 53
    assert run(spark, rows) == brute(rows)


def test_empty_and_single(spark):
    assert run(spark, []) == [] and run(spark, [(0, [1.0], 1)]) == []


def test_query_matches_sql(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{sf_dir}/embeddings.parquet'")
    want = sorted(con.sql(m.ORACLE).fetchall())
    assert want and sorted(tuple(r) for r in m.op11_hard_negatives(spark, sf_dir).collect()) == want
