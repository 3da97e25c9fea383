"""Removal of repeated byte strings by merged Burrows-Wheeler transforms.

A byte goes if it lies in a string of ``SPAN`` bytes that also starts in a
document with a smaller id; strings are judged on the whole input.

1. Pieces. Every span has one anchor, the ``GRAM``-byte string in it with the
   smallest hash (the first of equals), so equal spans have equal anchors.
   Neighbouring spans with one anchor form a piece of at most
   ``SPAN + SPAN - GRAM`` bytes. Anchor hashes are shipped in packed arrays to
   hash buckets, which tell the pieces whose anchor no other document has:
   these cannot repeat. They leave here; all others go on.
2. Transforms. Pieces are dealt to buckets by anchor, so all equal spans meet.
   In a bucket the distinct pieces are cut into shards, and each shard's
   suffixes are sorted once into its Burrows-Wheeler transform. The shards are
   merged by interleave refinement: a round reads the two bytes before every
   suffix in the present order and deals the rows out by them, which leaves all
   suffixes of all shards in the order of two more bytes. A boundary that
   appears in round r is a common prefix of 2 (r - 1) bytes or one more. After
   ``SPAN / 2`` rounds the stretches without a boundary are the intervals of
   equal spans; the smallest document id of an interval decides. No suffix is
   sorted again. A piece whose anchor has no other text has nothing to be
   merged with: its spans are repeated where the whole piece is.
3. Removal. The spans to remove are put together per document and cut out.

Equal texts are one document in steps 1 and 2 (the smallest id stands for
them): all others of at least ``SPAN`` bytes go whole. Buckets are as many as
the input needs and are worked through in batches of whole anchors, so no task
holds more than a bucket; copies of a piece are merged before its transform.

Defined results: null text counts as empty; texts shorter than a span keep all
bytes; null ids come after all others; rows with the same id are never each
other's cause. Anchors are compared by 48 hash bits within a bucket (equal
ones only lead to more checking) and texts by 256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.llm.common import mix64, parts_for, staged, table, utf8

SPAN = 50
GRAM = 24
WINDOW = SPAN - GRAM + 1
WIDEST = 2 * SPAN - GRAM
BLOCK = 1 << 21
BUCKET_BYTES = 8 << 20
BATCH_CHARS = 1 << 20
SHARD_CHARS = 1 << 15
_SEGMENT = 1 << 17
_LAST = (1 << 63) - 1


def _powers(base: int) -> np.ndarray:
    out = np.full(_SEGMENT + 2 * SPAN, base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


_BASE = 0x9E3779B97F4A7C15
_UP, _DOWN = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


# ---- pieces ---------------------------------------------------------------

def first_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the first smallest value of each window, by doubling."""
    at, size = np.arange(len(values)), 1
    while size < width:
        step = min(size, width - size)
        left, right = values[:-step], values[step:]
        later = right < left
        values, at = np.where(later, right, left), np.where(later, at[step:], at[:-step])
        size += step
    return at


def gram_hashes(body: np.ndarray) -> np.ndarray:
    """Hashes of all strings of GRAM bytes, of a body of at most one segment."""
    with np.errstate(over="ignore"):
        sums = np.zeros(len(body) + 1, np.uint64)
        np.cumsum((body + np.uint64(1)) * _UP[:len(body)], out=sums[1:])
        return mix64((sums[GRAM:] - sums[:-GRAM]) * _DOWN[:len(body) - GRAM + 1])


def anchors_of(pieces: list[bytes]) -> np.ndarray:
    """The anchor hash of each piece: the smallest of all its grams, as each of
    its spans has it."""
    out, step = [], _SEGMENT // WIDEST
    for at in range(0, len(pieces), step):
        part = pieces[at:at + step]
        sizes = np.array([len(p) for p in part])
        ends = np.cumsum(sizes)
        grams = np.append(gram_hashes(np.frombuffer(b"".join(part), np.uint8)), np.full(GRAM - 1, np.iinfo(np.uint64).max))
        for k in range(1, GRAM):  # grams across the end of a piece
            grams[ends - k] = np.iinfo(np.uint64).max
        out.append(np.minimum.reduceat(grams, ends - sizes))
    return np.concatenate(out)


def pieces_of(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, anchor place, start and stop of each piece."""
    body = np.frombuffer(text, np.uint8)
    found: tuple[list, list, list, list] = ([], [], [], [])
    for at in range(0, max(0, len(body) - SPAN + 1), _SEGMENT):
        part = body[at:at + _SEGMENT + SPAN - 1]
        grams = gram_hashes(part)
        anchor = first_smallest(grams, WINDOW)
        starts = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        stops = np.append(starts[1:], len(anchor)) + SPAN - 1
        for held, new in zip(found, (grams[anchor[starts]], anchor[starts] + at, starts + at, stops + at), strict=True):
            held.append(new)
    return tuple(np.concatenate(x) if x else np.zeros(0, np.uint64 if n == 0 else np.int64) for n, x in enumerate(found))


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the runs of equal keys."""
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return np.concatenate([[0], cuts]), np.append(cuts, len(keys))


_ANCHORS = "bucket int, block bigint, low binary, high binary, doc binary, place_low binary, place_high binary, texts binary"


def _anchors(buckets: int):
    """Anchors of blocks of documents, packed by bucket, and for each block a
    row with the hashes of its texts."""
    names = ["bucket", "block", "low", "high", "doc", "place_low", "place_high", "texts"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, int]] = []
        hashes: dict[int, int] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            texts = np.array(list(hashes), np.int64)
            block = xxhash.xxh3_64_intdigest(texts.tobytes()) - (1 << 63)
            h = np.concatenate([x[0] for x in held])
            place = np.concatenate([x[1] for x in held])
            doc = np.concatenate([np.full(len(x[0]), x[2], np.uint16) for x in held])
            bucket = ((h >> np.uint64(40)) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            h, place, doc, bucket = h[order], place[order], doc[order], bucket[order]
            starts, stops = _runs(bucket)
            columns = (h.astype(np.uint32), (h >> np.uint64(32)).astype(np.uint16), doc, place.astype(np.uint16), (place >> 16).astype(np.uint16))
            for at in range(0, len(starts), 2048):
                s, e = starts[at:at + 2048], stops[at:at + 2048]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[s]), pa.array(np.full(len(s), block, np.int64))]
                    + [pa.array([c[a:b].tobytes() for a, b in zip(s, e, strict=True)], pa.binary()) for c in columns]
                    + [pa.nulls(len(s), pa.binary())], names=names)
            none = [pa.nulls(1, pa.binary())] * 5
            yield pa.RecordBatch.from_arrays([pa.array([block % buckets], pa.int32()), pa.array([block], pa.int64()), *none,
                                              pa.array([texts.tobytes()], pa.binary())], names=names)

        for batch in batches:
            for text_hash, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if text_hash in hashes:
                    continue
                h, place, _, _ = pieces_of(text.as_py())
                if not len(h):
                    continue
                if len(place) and place[-1] >= 1 << 32:
                    raise ValueError("a text of 4 GiB or more")
                once = np.unique(h, return_index=True)[1]  # one place of an anchor tells
                held.append((h[once], place[once], len(hashes)))
                hashes[text_hash] = len(hashes)
                size += len(once)
                if size >= BLOCK or len(hashes) == 1 << 16:
                    yield from flush()
                    held, hashes, size = [], {}, 0
        if held:
            yield from flush()

    return pack


_REPEATED = "block bigint, doc binary, place binary, texts binary"


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of one bucket at a time (rows come sorted by bucket)."""
    bucket, held = None, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if row[0] != bucket and held:
                yield held
                held = []
            bucket = row[0]
            held.append(row)
    if held:
        yield held


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block the anchors that another document has too."""
    names = ["block", "doc", "place", "texts"]
    for rows in _by_bucket(batches):
        for r in rows:
            if r[7] is not None:
                yield pa.RecordBatch.from_arrays([pa.array([r[1]], pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
                                                  pa.array([r[7]], pa.binary())], names=names)
        rows = [r for r in rows if r[7] is None]
        if not rows:
            continue

        def column(n: int, kind, rows=rows) -> np.ndarray:
            return np.frombuffer(b"".join(r[n] for r in rows), kind)

        h = column(2, np.uint32).astype(np.uint64) | column(3, np.uint16).astype(np.uint64) << np.uint64(32)
        doc, place = column(4, np.uint16), column(5, np.uint16).astype(np.uint32) | column(6, np.uint16).astype(np.uint32) << np.uint32(16)
        row = np.repeat(np.arange(len(rows)), [len(r[4]) // 2 for r in rows])
        order = np.argsort(h, kind="stable")
        several = np.zeros(len(h), bool)
        starts, stops = _runs(h[order])
        several[order] = np.repeat(stops - starts > 1, stops - starts)
        starts, stops = _runs(row[several]) if several.any() else (np.zeros(0, int), np.zeros(0, int))
        doc, place, row = doc[several], place[several], row[several]
        if len(row):
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows[row[s]][1] for s in starts], pa.int64()),
                 pa.array([doc[s:e].tobytes() for s, e in zip(starts, stops, strict=True)], pa.binary()),
                 pa.array([place[s:e].tobytes() for s, e in zip(starts, stops, strict=True)], pa.binary()),
                 pa.nulls(len(starts), pa.binary())], names=names)


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text the places of its repeated anchors."""
    for rows in _by_bucket(batches):
        texts = next((np.frombuffer(r[3], np.int64) for r in rows if r[3] is not None), None)
        if texts is None:
            raise RuntimeError("a block without its list of texts")
        rows = [r for r in rows if r[3] is None]
        if not rows:
            continue
        doc = np.frombuffer(b"".join(r[1] for r in rows), np.uint16)
        place = np.frombuffer(b"".join(r[2] for r in rows), np.uint32)
        order = np.lexsort((place, doc))
        doc, place = doc[order], place[order]
        starts, stops = _runs(doc)
        yield pa.RecordBatch.from_arrays([pa.array(texts[doc[starts]]), pa.array([place[s:e].tobytes() for s, e in zip(starts, stops, strict=True)],
                                                                                 pa.binary())], names=["text_hash", "places"])


# ---- transforms -----------------------------------------------------------

def transform(codes: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """A shard's transform: for each suffix in order the two preceding codes as
    one number, the row of the suffix that starts with them (the mapping from
    last to first column, twice), its string and its offset; and for each string
    the rows of its end and of its last code, and that code. Codes are bytes plus
    one; a string's end sorts before every code, ends of several strings
    in the order of strings."""
    lengths = np.array([len(c) for c in codes])
    width = int(lengths.max()) + 1
    padded = np.zeros((len(codes), 2 * width), np.uint8)
    for row, c in zip(padded, codes, strict=True):
        row[:len(c)] = c
    string = np.repeat(np.arange(len(codes)), lengths + 1)
    offset = np.arange(len(string)) - np.repeat(np.cumsum(lengths + 1) - lengths - 1, lengths + 1)
    suffixes = np.lib.stride_tricks.sliding_window_view(padded, width, axis=1)[string, offset]
    order = np.argsort(np.ascontiguousarray(suffixes).view(f"S{width}").ravel(), kind="stable")
    string, offset = string[order], offset[order]
    pair = padded[string, np.maximum(offset, 2) - 2].astype(np.uint16) << 8 | padded[string, np.maximum(offset, 2) - 1]
    starts = np.cumsum(lengths + 1) - lengths - 1
    place = np.empty(len(string), np.int32)
    place[starts[string] + offset] = np.arange(len(string))
    return (pair, place[starts[string] + np.maximum(offset, 2) - 2], string, offset,
            place[starts + lengths], place[starts + lengths - 1], padded[np.arange(len(codes)), lengths - 1])


def merged(shards: list[tuple], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave the suffixes of all shards by their first ``length`` (even)
    codes: their rows in merged order, and a lower bound of the common prefix
    of each with the one before it, exact to two codes (``length`` where no
    boundary has appeared)."""
    base = np.cumsum([0, *(len(s[0]) for s in shards)])
    pairs = np.concatenate([s[0] for s in shards])
    two_before = np.concatenate([s[1] + np.int32(b) for s, b in zip(shards, base, strict=False)])
    long = np.concatenate([s[3] for s in shards]) >= 2       # rows with two codes before them
    # suffixes of no and of one code have no suffix two further: they come first, in the order of strings
    short_row = np.concatenate([s[i] + b for i in (4, 5) for s, b in zip(shards, base, strict=False)]).astype(np.int32)
    last = np.concatenate([s[6] for s in shards]).astype(np.uint16) << 8
    short_pair = np.concatenate([np.zeros(len(last), np.uint16), last])
    n, n_short = len(pairs), len(short_row)
    block, prefix = np.zeros(n, np.int32), np.full(n, length, np.int16)
    row = np.arange(n, dtype=np.int32)
    for done in range(0, length, 2):
        moving = long[row]
        before = row[moving]
        key = np.concatenate([short_pair, pairs[before]])
        order = np.argsort(key, kind="stable")
        row = np.concatenate([short_row, two_before[before]])[order]
        block = np.concatenate([np.arange(-n_short, 0, dtype=np.int32), block[moving]])[order]   # short ones are apart
        key = key[order]
        edge = np.ones(n, bool)
        edge[1:] = (key[1:] != key[:-1]) | (block[1:] != block[:-1])
        prefix[edge & (prefix == length)] = done
        block = np.cumsum(edge, dtype=np.int32)
    return row, prefix


def smallest_owner(strings: list[bytes], owners: np.ndarray, span: int) -> list[np.ndarray]:
    """For each string and each of its spans, the smallest owner of an equal
    span among all strings."""
    codes = [np.frombuffer(s, np.uint8) + np.uint8(1) for s in strings]
    sizes = np.cumsum([len(c) for c in codes])
    cut = np.flatnonzero(np.diff(sizes // SHARD_CHARS)) + 1
    edges = [0, *cut.tolist(), len(codes)]
    shards = [transform(codes[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
    row, prefix = merged(shards, span)
    string = np.concatenate([s[2] + a for s, a in zip(shards, edges, strict=False)])[row]
    offset = np.concatenate([s[3] for s in shards])[row]
    starts = np.flatnonzero(prefix < span)
    least = np.repeat(np.minimum.reduceat(owners[string], starts), np.diff(np.append(starts, len(row))))
    lengths = np.array([len(c) for c in codes])
    base = np.cumsum(lengths) - lengths
    flat = np.empty(int(lengths.sum()), np.int64)
    inside = offset < lengths[string]
    flat[base[string[inside]] + offset[inside]] = least[inside]
    return [flat[b:b + n - span + 1] for b, n in zip(base, lengths, strict=True)]


_PIECES = "bucket int, bytes binary, sizes binary, starts binary, docs binary, texts binary"


def _piece_rows(buckets: int):
    """Pieces with a repeated anchor, packed by the anchor's bucket."""
    names = ["bucket", "bytes", "sizes", "starts", "docs", "texts"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            bucket = np.concatenate([x[0] for x in held])
            order = np.argsort(bucket, kind="stable")
            bodies = [b for x in held for b in x[1]]
            sizes = np.array([len(b) for b in bodies], np.uint8)[order]
            starts = np.concatenate([x[2] for x in held]).astype(np.uint32)[order]
            docs = np.concatenate([np.full(len(x[0]), x[3], np.int64) for x in held])[order]
            texts = np.concatenate([np.full(len(x[0]), x[4], np.int64) for x in held])[order]
            bucket = bucket[order]
            s, e = _runs(bucket)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[s]), pa.array([b"".join([bodies[i] for i in order[a:b]]) for a, b in zip(s, e, strict=True)], pa.binary())]
                + [pa.array([c[a:b].tobytes() for a, b in zip(s, e, strict=True)], pa.binary()) for c in (sizes, starts, docs, texts)],
                names=names)

        for batch in batches:
            for doc_id, text_hash, text, places in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                h, place, start, stop = pieces_of(text)
                wanted = h[np.isin(place, np.frombuffer(places, np.uint32))]  # one place of an anchor was told
                on = np.flatnonzero(np.isin(h, wanted))
                bodies = [text[a:b] for a, b in zip(start[on].tolist(), stop[on].tolist(), strict=True)]
                held.append((((h[on] >> np.uint64(40)) % np.uint64(buckets)).astype(np.int32), bodies, start[on],
                             _LAST if doc_id is None else doc_id, text_hash))
                size += len(on)
                if size >= BLOCK // 8:
                    yield from flush()
                    held, size = [], 0
        if size:
            yield from flush()

    return pack


_CUTS = "part int, texts binary, starts binary, sizes binary"


def _cuts(parts: int):
    """Per bucket: merge the transforms, tell the stretches to remove."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_bucket(batches):
            sizes = np.frombuffer(b"".join(r[2] for r in rows), np.uint8).astype(np.int64)
            starts = np.frombuffer(b"".join(r[3] for r in rows), np.uint32).astype(np.int64)
            docs, texts = (np.frombuffer(b"".join(r[n] for r in rows), np.int64) for n in (4, 5))
            body = b"".join(r[1] for r in rows)
            ends = np.cumsum(sizes).tolist()
            distinct: dict[bytes, int] = {}
            which = np.array([distinct.setdefault(body[e - n:e], len(distinct)) for e, n in zip(ends, sizes.tolist(), strict=True)])
            owner = np.full(len(distinct), _LAST, np.int64)
            np.minimum.at(owner, which, docs)
            found: tuple[list, list, list] = ([], [], [])

            def tell(t, s, n, found=found) -> None:
                for held, new in zip(found, (t, s, n), strict=True):
                    held.append(new)

            copy = docs > owner[which]  # an equal piece of a smaller id: whole
            tell(texts[copy], starts[copy], sizes[copy])
            least = _least(list(distinct), owner)
            spans = np.concatenate([x for x in least])
            string = np.repeat(np.arange(len(distinct)), [len(x) for x in least])
            offset = np.arange(len(spans)) - np.repeat(np.cumsum([len(x) for x in least]) - [len(x) for x in least], [len(x) for x in least])
            on = spans < owner[string]
            string, offset = string[on], offset[on]
            if len(string):
                new = np.concatenate([[True], (string[1:] != string[:-1]) | (offset[1:] != offset[:-1] + 1)])
                a = np.flatnonzero(new)
                b = np.append(a[1:], len(string)) - 1
                run_string, run_at, run_size = string[a], offset[a], offset[b] - offset[a] + SPAN
                # every occurrence in the owner's own documents
                own = np.flatnonzero(~copy)
                order = own[np.argsort(which[own], kind="stable")]
                lo, hi = np.searchsorted(which[order], run_string), np.searchsorted(which[order], run_string, side="right")
                run = np.repeat(np.arange(len(a)), hi - lo)
                at = np.arange(len(run)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)
                member = order[at]
                tell(texts[member], starts[member] + run_at[run], run_size[run])
            t, s, n = (np.concatenate(x) for x in found)
            part = (t % parts).astype(np.int32)
            order = np.argsort(part, kind="stable")
            t, s, n, part = t[order], s[order].astype(np.uint32), n[order].astype(np.uint8), part[order]
            if len(part):
                a, b = _runs(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[a])] + [pa.array([c[i:j].tobytes() for i, j in zip(a, b, strict=True)], pa.binary()) for c in (t, s, n)],
                    names=["part", "texts", "starts", "sizes"])

    return cut


def _least(strings: list[bytes], owner: np.ndarray) -> list[np.ndarray]:
    """smallest_owner in batches of whole anchors: equal spans have equal
    anchors, so no span is missed, and a lone piece is its own."""
    if not strings:
        return []
    anchor = anchors_of(strings)
    out = [np.full(len(s) - SPAN + 1, o, np.int64) for s, o in zip(strings, owner.tolist(), strict=True)]
    order = np.argsort(anchor, kind="stable")
    starts, stops = _runs(anchor[order])
    order = order[np.repeat(stops - starts > 1, stops - starts)]
    held, size = [], 0
    for n, i in enumerate(order.tolist()):
        if size >= BATCH_CHARS and anchor[i] != anchor[order[n - 1]]:
            for j, x in zip(held, smallest_owner([strings[j] for j in held], owner[held], SPAN), strict=True):
                out[j] = x
            held, size = [], 0
        held.append(i)
        size += len(strings[i])
    if held:
        for j, x in zip(held, smallest_owner([strings[j] for j in held], owner[held], SPAN), strict=True):
            out[j] = x
    return out


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text its maximal stretches to remove."""
    for rows in _by_bucket(batches):
        t = np.frombuffer(b"".join(r[1] for r in rows), np.int64)
        s = np.frombuffer(b"".join(r[2] for r in rows), np.uint32).astype(np.int64)
        e = s + np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
        order = np.lexsort((s, t))
        t, s, e = t[order], s[order], e[order]
        a, b = _runs(t)
        names: tuple[list, list] = ([], [])
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            reach = np.maximum.accumulate(e[i:j])
            new = np.concatenate([[True], s[i + 1:j] > reach[:-1]])
            first = np.flatnonzero(new)
            names[0].append(int(t[i]))
            names[1].append(np.stack([s[i:j][first], reach[np.append(first[1:], j - i) - 1]], axis=1).astype(np.int64).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(names[0], pa.int64()), pa.array(names[1], pa.binary())], names=["text_hash", "cuts"])


# ---- removal --------------------------------------------------------------

_RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def kept_bytes(text: bytes, whole: bool, cuts: bytes | None) -> tuple[bytes, np.ndarray]:
    spans = np.array([[0, len(text)]]) if whole else np.frombuffer(cuts or b"", np.int64).reshape(-1, 2)
    edges = [0, *spans.ravel().tolist(), len(text)]
    return b"".join([text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]), spans


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for _, text, whole, cuts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            kept, spans = kept_bytes(text, bool(whole), cuts)
            rows.append((len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[i] for r in rows], pa.int64() if i < 3 else pa.string())
                                                             for i in range(4)]],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = [kept_bytes(t, bool(w), c)[0] for _, t, w, c in zip(*[c.to_pylist() for c in batch.columns], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary())], names=["doc_id", "kept"])


def cuts_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, text (bytes), whole (all goes) and
    cuts (packed pairs of start and stop of the maximal stretches that go)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), utf8(docs[f"`{text}`"]).alias("text")) \
        .select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    known = staged(rows.select("doc_id", "text_hash", F.unhex(F.sha2("text", 256)).alias("digest"),
                               F.octet_length("text").cast("bigint").alias("n_bytes")), "texts")
    total = known.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = parts_for(spark, total, BUCKET_BYTES)
    ordered = F.coalesce("doc_id", F.lit(_LAST))
    classes = known.groupBy("text_hash", "digest").agg(F.min(ordered).alias("least"), F.count("*").alias("c"))
    found = rows.select("text_hash", "text").mapInArrow(_anchors(buckets), _ANCHORS) \
        .repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_repeated, _REPEATED) \
        .repartition(parts_for(spark, total, 4 * BUCKET_BYTES), "block").sortWithinPartitions("block") \
        .mapInArrow(_assembled, "text_hash bigint, places binary")
    asked = staged(found.groupBy("text_hash").agg(F.max("places").alias("places"))
                   .join(classes.select("text_hash", "least"), "text_hash")
                   .select(F.expr(f"nullif(least, {_LAST}L)").alias("want"), F.col("text_hash").alias("want_hash"), "places"), "repeated-anchors")

    def of_row(other: DataFrame):
        return rows["doc_id"].eqNullSafe(other["want"]) & (rows["text_hash"] == other["want_hash"])

    cuts = rows.join(asked, of_row(asked)).select("doc_id", "text_hash", "text", "places").mapInArrow(_piece_rows(buckets), _PIECES) \
        .repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_cuts(buckets), _CUTS) \
        .repartition(buckets, "part").sortWithinPartitions("part").mapInArrow(_joined, "text_hash bigint, cuts binary")
    several = classes.where("c > 1").select("text_hash", "digest", "least")
    whole = known.where(f"n_bytes >= {SPAN}").join(several, ["text_hash", "digest"]).where(ordered > F.col("least")) \
        .select(F.col("doc_id").alias("want"), F.col("text_hash").alias("want_hash"), F.lit(True).alias("whole"),
                F.lit(None).cast("binary").alias("cuts")).distinct()
    some = cuts.join(classes.select("text_hash", "least"), "text_hash") \
        .select(F.expr(f"nullif(least, {_LAST}L)").alias("want"), F.col("text_hash").alias("want_hash"), F.lit(False).alias("whole"), "cuts")
    told = some.union(whole)
    return rows.join(told, of_row(told), "left").select("doc_id", "text", "whole", "cuts")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id and the remaining bytes (which need
    not be whole characters)."""
    return cuts_of(docs, doc_id, text).mapInArrow(_texts, "doc_id bigint, kept binary")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: what stays of every document."""
    return cuts_of(table(spark, sf_dir, "documents")).mapInArrow(_digests, _RESULT)
