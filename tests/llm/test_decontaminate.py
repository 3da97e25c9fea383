import re

import duckdb
from pyspark.sql import functions as F

from layerflow.llm import decontaminate as m
from tests.llm.cases import LONG, frame, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = {}
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for item, text in items:
            v = words(text)
            n = min(10, len(v))
            windows = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if v else set()
            for i in range(len(w) - n + 1 if n else 0):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    ids.add("" if item is None else str(item))
        out[d] = (len(w), len(hit), sorted(ids))
    return out


ITEMS = [(1, prose(1, 30)), (2, "Short ITEM, two"), (3, prose(1, 14)), (4, None), (5, "..."), (None, "no id at all here"), (2, "another text of item two é")]


def cases():
    p = prose(1, 30)
    return [(1, "x " + p + " y"), (2, p.upper().replace(" ", " -- ")), (3, "a short item TWO b short item two"), (4, None), (5, ""), (6, prose(9, 50)),
            (7, "No-id at\nall HERE"), (8, LONG + " " + " ".join(p.split()[3:14]) + " " + LONG), (9, "another text of item two é"),
            (10, " ".join(p.split()[:9])), (11, "short item")]


def run(spark, docs, items, **kw):
    bench = spark.createDataFrame([(i, t) for i, t in items], "item_id bigint, text string")
    got = m.contamination(frame(spark, docs), bench, **kw).select("doc_id", "text", "contamination.*").collect()
    return {r["doc_id"]: r for r in got}


def test_matches_brute_force_whole_and_in_slices(spark):
    want = brute(cases(), ITEMS)
    for size in (m.SLICE_BYTES, 40):
        got = run(spark, cases(), ITEMS, slice_bytes=size)
        for d, (n, hit, ids) in want.items():
            assert (got[d]["n_words"], got[d]["n_hit"], got[d]["items"]) == (n, hit, ids), (d, size)
            covered = [w for s in got[d]["spans"] for w in words(got[d]["text"][s["start"]:s["stop"]])]
            assert len(covered) == hit


def test_empty_tables_and_repeats(spark):
    assert run(spark, [], ITEMS) == {}
    got = run(spark, cases(), [])
    assert all(r["n_hit"] == 0 and r["items"] == [] for r in got.values())
    docs = frame(spark, [(1, prose(1, 30))] * 3).withColumn("contamination", F.lit(1)).withColumn("item_id", F.lit(2))
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert m.contamination(docs, bench, into="found").where("found.n_hit = 30").count() == 3


def test_query_matches_sql(spark, sf_dir):
    import __spark_entry__ as E

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    cur = con.execute(E.oracle_sql()["op7_decontaminate"])
    names = [d[0] for d in cur.description]
    got = E.queries()["op7_decontaminate"](spark, sf_dir)
    assert sorted(tuple(r) for r in got.select(*names).collect()) == sorted(cur.fetchall())
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert m.stage(spark, docs, sf_dir).count() == got.where("not contaminated").count()
