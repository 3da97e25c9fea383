import hashlib
import random

import numpy as np

from layerflow.llm import suffix_dedup as m
from tests.llm.cases import corpus, frame


def brute(rows):
    """(n_bytes, n_removed, n_spans, sha256) per row, by all spans."""
    rows = [(m._LAST if d is None else d, (t or "").encode()) for d, t in rows]
    first = {}
    for d, t in rows:
        for i in range(len(t) - m.SPAN + 1):
            s = t[i:i + m.SPAN]
            first[s] = min(first.get(s, d), d)
    out = []
    for d, t in rows:
        mark = bytearray(len(t))
        for i in range(len(t) - m.SPAN + 1):
            if first[t[i:i + m.SPAN]] < d:
                mark[i:i + m.SPAN] = b"\1" * m.SPAN
        kept = bytes(b for b, x in zip(t, mark) if not x)
        runs = sum(1 for i, x in enumerate(mark) if x and not (i and mark[i - 1]))
        out.append((len(t), len(t) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return out


def run(spark, rows):
    return m.cuts_of(frame(spark, rows)).mapInArrow(m._digests, m._RESULT).collect()


def test_matches_brute_force(spark):
    rows = [(d, t[:20_000] if t else t) for d, t, *_ in corpus()]
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in run(spark, rows))
    want = sorted((d is None, d or 0, *x) for (d, _), x in zip(rows, brute(rows)))
    assert got == want


def test_random_small_alphabets(spark):
    r = random.Random(4)
    base = "".join(r.choice("abé ") for _ in range(400))
    rows = []
    for i in range(40):
        a = r.randrange(300)
        rows.append((i, "".join(r.choice("ab") for _ in range(r.randrange(90))) + base[a:a + r.randrange(30, 120)] + "ab" * r.randrange(60)))
    got = {x["doc_id"]: (x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in run(spark, rows)}
    assert [got[d] for d, _ in rows] == brute(rows)


def test_spans_share_their_anchor():
    text = bytes(random.Random(9).choice(b"abc") for _ in range(5000))
    at = {}
    for h, _, start, stop in zip(*m.pieces_of(text)):
        for i in range(start, stop - m.SPAN + 1):
            assert at.setdefault(text[i:i + m.SPAN], h) == h
    assert sum(b - a - m.SPAN + 1 for a, b in zip(*m.pieces_of(text)[2:])) == len(text) - m.SPAN + 1


def test_pieces_of_long_texts_join_without_gaps():
    text = bytes(random.Random(2).choice(b"abcdefgh ") for _ in range(m._SEGMENT + 500))
    _, _, start, stop = m.pieces_of(text)
    assert start[0] == 0 and (start[1:] == stop[:-1] - m.SPAN + 1).all() and stop[-1] == len(text)
    assert (stop - start <= m.WIDEST).all()


def test_merged_transforms_give_order_prefixes_and_intervals():
    r = random.Random(6)
    strings = [bytes(r.choice(b"ab") for _ in range(r.randrange(50, 77))) for _ in range(30)]
    codes = [np.frombuffer(s, np.uint8) + np.uint8(1) for s in strings]
    shards = [m.transform(codes[a:a + 7]) for a in range(0, 30, 7)]
    row, prefix = m.merged(shards, m.SPAN)
    string = np.concatenate([s[2] + a for s, a in zip(shards, range(0, 30, 7))])[row]
    offset = np.concatenate([s[3] for s in shards])[row]
    suffixes = [strings[s][o:o + m.SPAN] for s, o in zip(string, offset)]
    assert suffixes == sorted(suffixes)
    for i in range(1, len(row)):
        common = next((k for k, (x, y) in enumerate(zip(suffixes[i - 1], suffixes[i])) if x != y), min(len(suffixes[i - 1]), len(suffixes[i])))
        assert prefix[i] == common // 2 * 2  # two codes a round


def test_empty_table(spark):
    assert run(spark, []) == []


def test_query_keeps_first_copies(spark, sf_dir):
    import __spark_entry__ as E

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = dict(zip((d for d, _ in rows), brute(rows)))
    got = E.queries()["op3_suffix_dedup"](spark, sf_dir).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == want
