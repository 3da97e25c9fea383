import hashlib

from pyspark.sql import functions as F

from layerflow.llm import line_dedup as m
from tests.llm.cases import corpus, frame, prose


def brute(rows):
    """Per (null id last, id, text) what stays by the stated rule: every chunk
    of every seed whose bytes occur earlier, extended line by line, all at once
    over plain lists; rows equal in id and text are one document."""
    keys = sorted({(d is None, d or 0, t) for d, t in rows if t is not None})
    texts = [k[2].encode().split(b"\n") for k in keys]
    first, out = {}, {}
    chunks = [sorted({c for seed in m.SEEDS for c in m.chunks_of(k[2].encode(), seed)[1]}) for k in keys]
    for d, (lines, parts) in enumerate(zip(texts, chunks)):
        for a, b in parts:
            first.setdefault(tuple(lines[a:b]), (d, a))
    for d, (lines, parts) in enumerate(zip(texts, chunks)):
        gone = set()
        for a, b in parts:
            s, at = first[tuple(lines[a:b])]
            if not any(x.strip() for x in lines[a:b]) or s == d and a < at + b - a:
                continue
            there, lo, hi = texts[s], a, b
            while lo and lo - a + at and lines[lo - 1] == there[lo - 1 - a + at]:
                lo -= 1
            while hi < len(lines) and hi - a + at < len(there) and lines[hi] == there[hi - a + at]:
                hi += 1
            hi = min(hi, lo + a - at) if s == d else hi
            full = [i for i in range(lo, hi) if lines[i].strip()]
            if len(full) >= m.MIN_LINES:
                gone.update(range(full[0], full[-1] + 1))
        out[keys[d]] = b"\n".join(x for i, x in enumerate(lines) if i not in gone).decode()
    return out


def test_matches_brute_force(spark):
    rows = [r for r in corpus() if r[0] is not None]  # ids that differ: the order needs no text hash
    got = m.dedup_lines(frame(spark, rows)).select("row.doc_id", F.col("row.text"), F.col("kept.text").alias("kept")).collect()
    want = brute([r[:2] for r in rows])
    assert len(got) == len(rows)
    for r in got:
        assert r["kept"] == (None if r["text"] is None else want[(False, r["doc_id"], r["text"])])


def test_shift_resistant_boundaries():
    body = prose(5, 400)
    a, b = m.chunks_of(body.encode()), m.chunks_of(("new line\n" + body).encode())
    sets = [{b"\n".join(lines[x:y]) for x, y in parts} for lines, parts in (a, b)]
    assert len(sets[0] & sets[1]) >= len(sets[0]) - 2


def test_null_ids_repeats_and_clashing_columns(spark):
    text = prose(7, 200)
    docs = frame(spark, [(None, text), (1, text), (1, text), (2, None), (3, "")]) \
        .withColumn("row", F.lit(1)).withColumn("kept", F.lit(2)).withColumn("gone", F.lit(3))
    out = m.stage(spark, docs, "")
    assert out.columns == docs.columns
    got = {(r["doc_id"], r["text"]) for r in out.collect()}
    assert out.count() == 5 and (1, text) in got and (2, None) in got and (3, "") in got
    assert next(t for d, t in got if d is None) != text  # the row without id comes last
    assert out.where("row = 1 and kept = 2 and gone = 3").count() == 5


def test_empty_table(spark):
    assert m.stage(spark, frame(spark, []), "").count() == 0


def test_query_digest(spark, sf_dir):
    import __spark_entry__ as E

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    want = brute(list(docs.items()))
    for r in E.queries()["op1_line_dedup"](spark, sf_dir).collect():
        kept = want[(False, r["doc_id"], docs[r["doc_id"]])]
        assert r["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()


def runs_brute(rows):
    """Per (null id last, id, text) the lines outside every run of two lines
    that are not blank (and the blank ones between) which an earlier document
    or an earlier place of the same one holds; no chunks, no hashes."""
    def pairs(lines):
        full = [i for i, x in enumerate(lines) if x.strip()]
        return [(a, b + 1) for a, b in zip(full, full[1:])]

    earlier, out = [], {}
    for key in sorted({(d is None, d or 0, t) for d, t in rows if t is not None}):
        lines = key[2].encode().split(b"\n")
        gone = set()
        for a, b in pairs(lines):
            run = lines[a:b]
            if any(run == old[i:i + b - a] for old in earlier for i in range(len(old))) or \
                    any(run == lines[i:j] for i, j in pairs(lines) if j <= a):
                gone.update(range(a, b))
        out[key] = b"\n".join(x for i, x in enumerate(lines) if i not in gone).decode()
        earlier.append(lines)
    return out


def test_recall_against_runs_without_chunks(spark):
    """Runs planted in fresh prose: what goes is never more than the repeated
    runs, and long runs go whole."""
    two = "first shared line of two\nsecond shared line of two"
    rows = [(200 + i, prose(500 + i, 30) + "\n" + two + "\n" + prose(600 + i, 30)) for i in range(6)]
    rows += [(1000 * n + i, prose(700 * n + i, 40) + "\n" + prose(800 * n + i % 20, 9 * n) + "\n" + prose(900 * n + i, 20))
             for n in (2, 3, 5, 8, 12) for i in range(40)]
    rows += [(220, "a b\n" * 7 + "c\n\n \nd\n\ne"), (221, "x\nc\n\n \nd\n\ny"), (222, "x\nlone\nz"), (223, "w\nlone\nv"), (225, "")]
    got = m.dedup_lines(frame(spark, rows)).select("row.doc_id", "row.text", F.col("kept.text").alias("kept"), "kept.n_removed_lines").collect()
    want, rule = runs_brute(rows), brute(rows)
    assert len(got) == len(rows)
    share = {}
    for r in got:
        most = len(r["text"].split("\n")) - len(want[False, r["doc_id"], r["text"]].split("\n")) if r["text"] else 0
        assert r["kept"] == rule[False, r["doc_id"], r["text"]] and r["n_removed_lines"] <= most + 1
        old = share.get(r["doc_id"] // 1000, (0, 0))
        share[r["doc_id"] // 1000] = (old[0] + r["n_removed_lines"], old[1] + most)
    recall = {n: round(x / y, 2) for n, (x, y) in share.items() if n}
    print("recall by lines of a run", recall)
    assert recall[2] > 0.4 and recall[3] > 0.6 and recall[5] > 0.9 and recall[8] > 0.95 and recall[12] > 0.99
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert kept[222] == "x\nlone\nz" and kept[223] == "w\nlone\nv"  # a single line stays


def test_runs_join_and_extend():
    assert m.runs_of([(4, 2, 3, 1, 7, 8, 14), (6, 1, 2, 5, 7, 8, 16), (9, 1, 1, 1, 7, 8, 30), (5, 1, 1, 1, 7, 8, 15)]) == \
        [(4, 3, 3, 5, 7, 8, 14), (9, 1, 1, 1, 7, 8, 30)]
    own, there = [b"a", b"b", b"c", b"d", b""], [b"x", b"b", b"c", b"d", b""]
    assert m.extended(own, there, 2, 1, None) == (1, 4) and m.extended(own, there, 0, 1, None) is None
    assert m.extended([b"q", b"q", b"q"], [b"q", b"q", b"q"], 1, 1, 1) is None  # both places would overlap
