import random
import re
import zlib
from collections import Counter

import duckdb
import pytest

from layerflow.llm import spelling_variants as m
from tests.llm.cases import corpus, frame


def counted(rows, min_length=6, min_count=5):
    held = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            held[run] += 1
    return {w: n for w, n in held.items() if len(w) >= min_length and n >= min_count}


def one_edit(u, v):
    if len(u) > len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(x != y for x, y in zip(u, v, strict=True)) == 1
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1:] == u for i in range(len(v)))


def brute(words):
    out = {}
    for w, n in words.items():
        near = [(-words[v], v) for v in words if v != w and abs(len(v) - len(w)) < 2 and one_edit(w, v)]
        best = min(near) if near else None
        form = best[1] if best and -best[0] >= 5 * n else None
        out[w] = [form, n, len(near), words[form] if form else None]
    for w in out:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w] = (out[w][0], root, *out[w][1:4])
    return out


def got(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return {r["word"]: tuple(r)[1:] for r in df.collect()}


def test_counts_match_brute_force(spark):
    rows = [(i, t) for i, t, *_ in corpus()] + [(9, "ÀÉÎÕÜÿ " * 7 + "Straße×÷ " * 6)]
    docs = frame(spark, rows)
    assert {r["word"]: r["n"] for r in m.vocabulary(docs).collect()} == counted(rows)


@pytest.mark.parametrize("group", [2, 7, 1024])
def test_variants_match_brute_force(spark, group):
    """Random words over a small alphabet have many near words, and small
    groups part many times; every pair must be met once."""
    r = random.Random(group)
    words = {}
    for _ in range(400):
        words["".join(r.choice("abé") for _ in range(r.randrange(6, 9)))] = r.choice((5, 6, 30, 31, 200, 1000, 5000))
    stem = "q" * 300
    words |= {stem: 500, stem + "x": 5, stem[:150] + "x" + stem[150:]: 7, stem[:-1]: 7, "x" + stem[2:] + "x": 9}
    df = spark.createDataFrame([(w, n, "clash") for w, n in words.items()], "word string, n bigint, k string")
    assert got(m.variants(df, group=group)) == brute(words)


def test_near_pairs_against_single_edits():
    r = random.Random(4)
    for k in (6, 7, 11):
        words = sorted({"ab" + "".join(r.choice("xyz") for _ in range(r.choice((k - 4, k - 5)))) + "cd" for _ in range(300)})
        pairs = m.near_pairs(words, k, 2, 2, 2 ** 31)
        want = {(u, v) for u in words for v in words if u < v and max(len(u), len(v)) == k and one_edit(u, v)}
        assert len(pairs) == len(want) and {tuple(sorted((words[i], words[j]))) for i, j in pairs} == want


def test_chains_and_ties(spark):
    words = {"colour": 5000, "colours": 800, "colourss": 100, "colourz": 5000, "colouq": 999, "zolour": 5}
    found = got(m.variants(spark.createDataFrame(list(words.items()), "word string, n bigint")))
    assert found == brute(words)
    assert found["colourss"][1] == "colour" and found["zolour"][0] == "colour"


def test_odd_rows(spark):
    rows = [(None, "abcdefg " * 5), (1, None), (2, ""), (3, "a b c 123 \u0000"), (4, "abcdefg"), (4, "abcdefg")]
    rows += [(10 + i, "z" * 100_000 + " ") for i in range(6)] + [(20 + i, "z" * 100_001) for i in range(6)]
    words = counted(rows)
    assert got(m.variants(m.vocabulary(frame(spark, rows)))) == brute(words)
    assert got(m.variants(m.vocabulary(frame(spark, [])))) == {}


def test_query_matches_sql(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    want = {r[0]: tuple(r)[1:] for r in con.sql(m.ORACLE).fetchall()}
    assert want and got(m.op13_spelling_variants(spark, sf_dir)) == want
