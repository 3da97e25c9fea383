import random
import re

import duckdb
import numpy as np
from pyspark.sql import functions as F

from layerflow.llm import jaccard_join as m
from layerflow.llm.components import components
from tests.llm.cases import corpus, edited, frame, prose


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """Set size and group (as a frozenset of row numbers) of each row."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    return [(len(s), groups[find(i)]) for i, s in enumerate(sets)]


def expected(rows):
    out = []
    for (d, _), (n, members) in zip(rows, brute(rows)):
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        out.append((d, n, min(ids) if ids and n else d))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0))


def run(spark, rows):
    found = m.near_copies(frame(spark, rows))
    least = found.groupBy("group").agg(F.min("doc_id").alias("least")).where("group is not null")
    got = found.join(least, "group", "left").select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("c")).collect()
    return sorted((tuple(r) for r in got), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0))


def test_matches_brute_force(spark):
    rows = [r[:2] for r in corpus()]
    assert run(spark, rows) == expected(rows)


def test_all_sizes_around_the_boundary_and_chains(spark):
    rows, r = [], random.Random(8)
    for n in range(1, 60):  # every size, light and heavy, with drops at its ends
        words = prose(1000 + n, n + 4).split()
        for k in range(4):
            rows.append((len(rows), " ".join(words[r.randrange(3):len(words) - r.randrange(3)])))
    text = prose(5, 120)
    for i in range(12):  # a chain: neighbours link, its ends do not
        rows.append((len(rows), text))
        text = edited(text, 50 + i, 2)
    assert run(spark, rows) == expected(rows)


def test_boundary_is_the_cheapest():
    assert m.boundary({4: 100}) > 4  # one subset of each against lists
    assert m.boundary({24: 10 ** 6}) < 24  # C(24, 21) subsets each cost more than a prefix
    for n in range(1, 25):  # every linked light pair has a common subset size
        for k in range(n, 25):
            if 5 * n >= 4 * k:
                assert m.need(n, k) in m.subset_sizes(n, 24) and m.need(n, k) in m.subset_sizes(k, 24) or m.need(n, k) > n


def test_prefix_holds_the_promised_share():
    r = np.random.default_rng(1)
    for _ in range(200):
        n, k = int(r.integers(20, 300)), 0
        both = int(r.integers(int(0.85 * n), n + 1))
        order = r.permutation(2000)
        common, left, right = order[:both], order[both:n], order[n:n + (n - both)]
        a, b = np.sort(np.concatenate([common, left])), np.sort(np.concatenate([common, right]))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            k = len(np.intersect1d(a[:int(m.prefix(len(a)))], b[:int(m.prefix(len(b)))]))
            assert k >= min(m.share(len(a)), m.share(len(b)))


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 200), (200, 100), (7, 7)], "u bigint, v bigint")
    got = {r["node"]: r["component"] for r in components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 200: 100}
    assert components(links.limit(0)).count() == 0


def test_stage_keeps_one_of_each_group(spark):
    rows = [r[:2] for r in corpus()]
    docs = frame(spark, rows).withColumn("node", F.lit(1)).withColumn("id", F.lit(2)).withColumn("hash", F.lit(3))
    out = m.stage(spark, docs, "")
    assert out.columns == docs.columns
    kept = [r["doc_id"] for r in out.collect()]
    want = []
    for (d, _), (n, members) in zip(rows, brute(rows)):
        if not n or d is not None and d == min(rows[i][0] for i in members if rows[i][0] is not None) or \
                all(rows[i][0] is None for i in members):
            want.append(d)
    assert sorted(kept, key=str) == sorted(want, key=str)
    assert m.stage(spark, docs.limit(0), "").count() == 0


def test_query_matches_sql(spark, sf_dir):
    import __spark_entry__ as E

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    cur = con.execute(E.oracle_sql()["op5_jaccard_join"])
    names = [d[0] for d in cur.description]
    assert sorted(tuple(r) for r in E.queries()["op5_jaccard_join"](spark, sf_dir).select(*names).collect()) == sorted(cur.fetchall())


def test_large_groups_with_common_shingles(spark, monkeypatch):
    """Groups in which most shingles are common, with copies on either side of
    the limit: the bound by unshared shingles must lose no link."""
    monkeypatch.setattr(m, "COMMON_AT_ALL", 4)  # read on the driver
    rows = []
    for g in range(3):
        base = prose(900 + g, 90 + 30 * g)
        for i in range(30):
            rows.append((len(rows), edited(base, 40 * g + i, i % 8)))
        rows += [(len(rows) + i, edited(edited(base, 40 * g + i, 5), 7, 1)) for i in range(6)]  # twins by a shared edit
    assert run(spark, rows) == expected(rows)
