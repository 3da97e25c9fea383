"""Line dedup: content-defined chunks of lines, repeated runs are removed.

A rolling hash over the hashes of ``WINDOW`` neighbouring lines ends a chunk
where ``DIVISOR`` divides it, so boundaries depend on the lines beside them alone
and an inserted line moves none that follow. Each of ``SEEDS`` rolling hashes
cuts the text in its own way; a passage too short to hold a whole chunk of one
may hold a chunk of another.

A chunk (of one line, too) that occurs earlier - in a smaller document id, or
further up in the same document without overlap - anchors a repeat. Anchors that
follow each other here and at the earlier place are one run. The lines of a run
are compared, byte by byte, with those at the earlier place and the run is
extended line by line on both sides, into the chunks beside it, as long as both
places go on alike. A run of ``MIN_LINES`` or more lines that are not blank then
goes as a whole, whatever the chunks' ends were.

What stays: passages of one line, blank lines around a run, the earliest
occurrence of every line, and repeated runs that hold no whole chunk of any seed
(short ones; see the recall test). Nothing goes that no earlier place holds.

The first pass ships 16-byte hashes of chunks only; texts are dealt out by
document once, and that exchange serves both the fetching of the runs to compare
and the removal. A first occurrence ships each place it is asked for once, in the
longest form asked. A run that a third of the rows hold is met by the map-side
minimum and by the splitting of skewed joins.

Defined results: null text stays null and has no lines; empty text has one
blank line and stays; kept lines are joined by line feeds; a document may
become empty but never goes. Occurrences are ordered by (id, text hash, place),
null ids last; rows equal in id and text are one document and keep the same
lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.llm.common import mix64, release, staged, table, wrapped

WINDOW = 2
DIVISOR = 2
SEEDS = (0, 1, 2)
MIN_LINES = 2
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def cuts_of(hashes: np.ndarray, seed: int) -> list[tuple[int, int]]:
    """The (start, stop) line numbers of a seed's chunks, by the line hashes."""
    own = mix64(hashes ^ np.uint64(seed))
    rolling = own.copy()
    with np.errstate(over="ignore"):
        for k in range(1, WINDOW):
            rolling[k:] += own[:-k] * _FACTOR ** np.uint64(k)
        ends = np.flatnonzero(mix64(rolling) % np.uint64(DIVISOR) == 0) + 1
    cuts = [0, *ends.tolist()]
    if cuts[-1] != len(hashes):
        cuts.append(len(hashes))
    return list(zip(cuts, cuts[1:], strict=False))


def chunks_of(text: bytes, seed: int = SEEDS[0]) -> tuple[list[bytes], list[tuple[int, int]]]:
    """The lines of a text and the chunks of one seed."""
    lines = text.split(b"\n")
    return lines, cuts_of(line_hashes(lines), seed)


def line_hashes(lines: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, lines), np.uint64, len(lines))


def anchors_of(text: bytes) -> list[tuple[int, int, int, int, bytes]]:
    """(first line, lines, lines of the chunk before and of the one after, hash
    of the bytes) of every chunk that is not blank; a chunk that several seeds
    cut alike comes once, with the widest neighbours."""
    lines = text.split(b"\n")
    hashes, found = line_hashes(lines), {}
    for seed in SEEDS:
        parts = cuts_of(hashes, seed)
        for i, (a, b) in enumerate(parts):
            before = min(a, a - parts[i - 1][0] + WINDOW - 1) if i else 0  # what cut that chunk may lie outside the repeat
            after = parts[i + 1][1] - b if i + 1 < len(parts) else 0
            old = found.get((a, b), (0, 0))
            found[a, b] = (max(before, old[0]), max(after, old[1]))
    return [(a, b - a, *beside, xxhash.xxh3_128_digest(body)) for (a, b), beside in sorted(found.items())
            if (body := b"\n".join(lines[a:b])).strip()]


_AT_ONCE = 1000  # documents whose anchors a worker holds at a time
_ANCHORS = "doc_id bigint, text_hash bigint, no int, n int, before int, after int, anchor binary"


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "text_hash", "no", "n", "before", "after", "anchor"]
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
    for batch in batches:
        for at in range(0, len(batch), _AT_ONCE):
            part = batch.slice(at, _AT_ONCE)
            rows = [(doc_id, text_hash, *a) for doc_id, text_hash, text in zip(*[c.to_pylist() for c in part.columns], strict=True)
                    if text is not None for a in anchors_of(text)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names)
    release()


def runs_of(repeats: list[tuple]) -> list[tuple]:
    """Repeated chunks (no, n, before, after, id, hash and line of the first
    occurrence) of one document -> its runs: (line, lines, lines to try before
    and after, id, hash and line there). Chunks of one run share the distance
    to the earlier place and touch or overlap."""
    runs: dict[tuple, list[list]] = {}
    for no, n, before, after, doc_id, text_hash, at in sorted(repeats, key=lambda r: r[:2]):
        own = runs.setdefault((doc_id, text_hash, no - at), [])
        if own and no <= own[-1][1]:
            last = own[-1]
            if no + n > last[1]:
                last[1], last[3] = no + n, after
            elif no + n == last[1]:
                last[3] = max(last[3], after)
            if no == last[0]:
                last[2] = max(last[2], before)
        else:
            own.append([no, no + n, before, after])
    return sorted((no, stop - no, min(before, no, no - apart), after, doc_id, text_hash, no - apart)
                  for (doc_id, text_hash, apart), own in runs.items() for no, stop, before, after in own)


_REPEAT = ("no", "n", "before", "after", "doc_id", "text_hash", "at")
_RUN = pa.list_(pa.struct([("no", pa.int32()), ("n", pa.int32()), ("before", pa.int32()), ("after", pa.int32()), ("doc_id", pa.int64()),
                           ("text_hash", pa.int64()), ("at", pa.int32())]))


def _joiner():
    @F.arrow_udf("array<struct<no:int,n:int,before:int,after:int,doc_id:bigint,text_hash:bigint,at:int>>")
    def joined(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for repeats in batches:
            rows = [runs_of([tuple(r[c] for c in _REPEAT) for r in x]) for x in repeats.to_pylist()]
            yield pa.array([[dict(zip(_REPEAT, r, strict=True)) for r in x] for x in rows], _RUN)

    return joined


def extended(own: list[bytes], there: list[bytes], before: int, n: int, apart: int | None) -> tuple[int, int] | None:
    """The lines of a run and of its earlier place, both from ``before`` lines
    ahead of it -> start and stop of the lines alike around it, without blank
    lines at the ends; None where the run itself differs or is too short.
    ``apart``: lines between both places if they are in one text."""
    if own[before:before + n] != there[before:before + n]:
        return None
    start, stop = before, before + n
    while start and own[start - 1] == there[start - 1]:
        start -= 1
    while stop < min(len(own), len(there)) and own[stop] == there[stop]:
        stop += 1
    if apart is not None:
        stop = min(stop, start + apart)  # the earlier place itself stays
    full = [i for i in range(start, stop) if own[i].strip()]
    return (full[0], full[-1] + 1) if len(full) >= MIN_LINES else None


def _fetcher(text: str):
    """Documents with the places asked of them -> the lines there."""
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text_hash", "line", "first", "run", "body"]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(),
                 pa.struct([("before", pa.int32()), ("n", pa.int32()), ("apart", pa.int32()), ("doc_id", pa.int64()), ("text_hash", pa.int64()),
                            ("line", pa.int32())]), pa.binary())
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [], [])
            texts = batch.column(0).field(text)
            for i, (doc_id, text_hash, wanted) in enumerate(zip(*[c.to_pylist() for c in batch.columns[1:]], strict=True)):
                lines = texts[i].as_py().encode().split(b"\n")
                for w in wanted:
                    body = b"\n".join(lines[w["line"]:w["line"] + w["lines"]])
                    for held, value in zip(rows, (doc_id, text_hash, w["line"], w["run"] is None, w["run"], body), strict=True):
                        held.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, kinds, strict=True)], names=names)

    return fetch


def _comparer():
    @F.arrow_udf("struct<start:int,stop:int>")
    def compared(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for own, there, line, run in batches:
            rows = []
            for x, y, at, r in zip(own, there, line.to_pylist(), run.to_pylist(), strict=True):
                found = extended(x.as_py().split(b"\n"), y.as_py().split(b"\n"), r["before"], r["n"], r["apart"])
                rows.append(found and {"start": at + found[0], "stop": at + found[1]})
            yield pa.array(rows, pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    return compared


_KEPT = pa.struct([("text", pa.string()), ("n_lines", pa.int64()), ("n_chunks", pa.int64()), ("n_removed_chunks", pa.int64()),
                   ("n_removed_lines", pa.int64())])


def _keeper():
    @F.arrow_udf("struct<text:string,n_lines:bigint,n_chunks:bigint,n_removed_chunks:bigint,n_removed_lines:bigint>")
    def kept(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, gone in batches:
            rows = []
            for text, runs in zip(texts, gone.to_pylist(), strict=True):
                text = text.as_py()
                if text is None:
                    rows.append({"text": None, "n_lines": 0, "n_chunks": 0, "n_removed_chunks": 0, "n_removed_lines": 0})
                    continue
                lines, parts = chunks_of(text.encode())
                drop = {i for r in runs or () for i in range(r["start"], r["stop"])}
                rows.append({"text": b"\n".join([x for i, x in enumerate(lines) if i not in drop]).decode() if drop else text,
                             "n_lines": len(lines), "n_chunks": len(parts),
                             "n_removed_chunks": sum(drop.issuperset(range(a, b)) for a, b in parts) if drop else 0, "n_removed_lines": len(drop)})
            yield pa.array(rows, _KEPT)
        release()

    return kept


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A struct ``row`` with the columns of ``docs`` as they were, and a
    struct ``kept``: the remaining text and counts (of chunks: the first seed's)."""
    key, body = docs[f"`{doc_id}`"].cast("bigint"), docs[f"`{text}`"].cast("string")
    found = staged(docs.select(key, F.xxhash64(body), body.cast("binary")).toDF("doc_id", "text_hash", "text")
                   .mapInArrow(_hashed, _ANCHORS), "anchors")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "no")
    several = staged(found.groupBy("anchor").agg(F.min(place).alias("first"), F.count("*").alias("c")).where("c > 1").select("anchor", "first"),
                     "repeated-anchors")
    here = (F.col("doc_id").eqNullSafe(F.col("first.doc_id"))) & (F.col("text_hash") == F.col("first.text_hash"))
    repeats = found.join(several, "anchor").where(~here | (F.col("no") >= F.col("first.no") + F.col("n"))) \
        .groupBy("doc_id", "text_hash") \
        .agg(F.collect_set(F.struct("no", "n", "before", "after", "first.doc_id", "first.text_hash", F.col("first.no").alias("at"))).alias("r"))
    run = F.col("run")  # at most the chunks of one document are collected
    runs = staged(repeats.select("doc_id", "text_hash", F.explode(_joiner()("r")).alias("run")), "runs")
    lines = run["before"] + run["n"] + run["after"]
    same = run["doc_id"].eqNullSafe(F.col("doc_id")) & (run["text_hash"] == F.col("text_hash"))
    compared = F.struct(run["before"].alias("before"), run["n"].alias("n"), F.when(same, run["no"] - run["at"]).alias("apart"),
                        run["doc_id"].alias("doc_id"), run["text_hash"].alias("text_hash"), (run["at"] - run["before"]).alias("line"))
    own = runs.select("doc_id", "text_hash", F.struct((run["no"] - run["before"]).alias("line"), lines.alias("lines"), compared.alias("run")).alias("w"))
    sources = runs.select(run["doc_id"].alias("doc_id"), run["text_hash"].alias("text_hash"), (run["at"] - run["before"]).alias("line"),
                          lines.alias("lines")) \
        .groupBy("doc_id", "text_hash", "line").agg(F.max("lines").alias("lines"))
    asked = own.union(sources.select("doc_id", "text_hash", F.struct("line", "lines", F.lit(None).cast(own.schema["w"].dataType["run"].dataType).alias("run")))) \
        .groupBy("doc_id", "text_hash").agg(F.collect_set("w").alias("wanted"))
    rows = wrapped(docs, id=key, hash=F.xxhash64(body))

    def of_row(other: DataFrame):
        return rows["id"].eqNullSafe(other["doc_id"]) & (rows["hash"] == other["text_hash"])

    bodies = rows.join(asked, of_row(asked)).select("row", "doc_id", "text_hash", "wanted").mapInArrow(
        _fetcher(text), "doc_id bigint, text_hash bigint, line int, first boolean, "
                        "run struct<before:int,n:int,apart:int,doc_id:bigint,text_hash:bigint,line:int>, body binary")
    first = bodies.where("first").select(F.col("doc_id").alias("f_id"), F.col("text_hash").alias("f_hash"), F.col("line").alias("f_line"),
                                         F.col("body").alias("there")).dropDuplicates(["f_id", "f_hash", "f_line"])
    met = F.col("run.doc_id").eqNullSafe(F.col("f_id")) & (F.col("run.text_hash") == F.col("f_hash")) & (F.col("run.line") == F.col("f_line"))
    gone = bodies.where("not first").join(first, met) \
        .select("doc_id", "text_hash", _comparer()("body", "there", "line", "run").alias("span")).where("span is not null") \
        .groupBy("doc_id", "text_hash").agg(F.collect_set("span").alias("gone"))
    return rows.join(gone, of_row(gone), "left").select("row", _keeper()(F.col("row")[text], F.col("gone")).alias("kept"))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: what is removed and the digest of what stays."""
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("row.doc_id", "kept.n_lines", "kept.n_chunks", "kept.n_removed_chunks", "kept.n_removed_lines",
                       F.sha2(F.coalesce("kept.text", F.lit("")), 256).alias("kept_sha256"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: texts without their repeated runs of lines; all documents stay."""
    kept = dedup_lines(docs)
    return kept.select(*[F.col("kept.text").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
