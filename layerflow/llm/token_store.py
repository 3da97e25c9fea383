"""Token ids in binary shards, found by a minimal perfect hash.

File format of a shard (little endian)::

    magic "LFTOK1\\0\\0" | u64 header length | JSON header | index | payload

The payload is the raw ids of the shard's documents one after another, two
bytes each where the vocabulary allows it and four otherwise. The index maps a
document key to its place in constant time: a minimal perfect hash (levels of
bit arrays; a key sits in the first level where it is alone in its bit, its
slot is the rank of that bit), then per slot a 32-bit fingerprint of the key,
the offset of its first id and the number of its ids. A key that was never
stored is told by the fingerprint.

Documents are range-partitioned by id (where ids repeat, by id, text and the
number of the copy, so an id with a third of all rows spreads over tasks), so
shards follow each other in id order and a shard's base is the sum of the sizes
before it. A task streams its rows
and closes a shard every ``shard_ids`` ids, so memory does not grow with the
input. Files are written under a private name and renamed; a task that runs
again replaces its files by equal ones.

The key of a row is (id, k): the k-th row with that id, in order of text.
Null ids come first. Null text counts as empty; every document ends with the
end id, so an empty one has a single id. An empty table has no shards.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.llm.common import checkpoint_root, mix64, parts_for, shared_dir, staged, table, utf8

MAGIC = b"LFTOK1\0\0"
END_ID = 1
SHARD_IDS = 8 << 20
KNOWN_CHUNKS = 800_000
BLOCK_BYTES = 16 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder every executor reaches."""
    if "://" not in uri:
        return fs.LocalFileSystem(), uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


class ChunkEncoder:
    """Ids of texts by the tokenizers library, one call per distinct chunk.

    The tokenizer's normaliser and pre-tokenizer drop white space and never
    join characters across it, so the ids of a text are those of its
    space-separated chunks in order. A block of texts is split and its chunks
    numbered in Arrow; each distinct one is looked up once, and ids are gathered
    by number. Ids of about ``KNOWN_CHUNKS`` chunks are kept from block to block;
    when there are more, the later half goes, as common chunks come early.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(True) <= 1 << 16 else "<u4")
        self.known: dict[bytes, bytes] = {}

    def encode(self, text: bytes) -> bytes:
        return self.encode_block(pa.array([text], pa.binary()))[0].tobytes()

    def encode_block(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (UTF-8 bytes) one after another, and where each
        text's begin; one place more at the end."""
        split = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        coded = split.flatten().dictionary_encode()
        chunks = coded.dictionary.cast(pa.large_binary()).to_pylist()
        self._learn(chunks)
        known = self.known
        found = [known[c] for c in chunks]
        flat = np.frombuffer(b"".join(found), self.dtype)
        size = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        first = np.cumsum(size) - size
        number = coded.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(size[number])])
        at = np.repeat(first[number] - ends[:-1], size[number]) + np.arange(ends[-1])
        offsets = split.offsets.to_numpy()
        return flat[at], ends[offsets - offsets[0]]

    def _learn(self, chunks: list[bytes]) -> None:
        if len(self.known) > KNOWN_CHUNKS:
            self.known = dict(islice(self.known.items(), KNOWN_CHUNKS // 2))
        known = self.known
        parts = {c: self._parts(c) for c in chunks if c not in known}
        asked = list(dict.fromkeys(p for pair in parts.values() for p in pair if p not in known))
        encoded = self.tokenizer.encode_batch_fast([a.decode() for a in asked], add_special_tokens=False)
        found = {a: np.array(e.ids, self.dtype).tobytes() for a, e in zip(asked, encoded, strict=True)}
        known.update(found)
        for c, pair in parts.items():
            if c not in known:
                known[c] = b"".join([known[p] for p in pair])

    @staticmethod
    def _parts(chunk: bytes) -> tuple[bytes, ...]:
        """Pieces that are tokenised apart from each other: the tokenizer lower-
        cases, and one final point or comma after an ASCII letter or digit is a
        piece of its own. Chunks that may hold a special token stay as they are."""
        if b"<|" in chunk:
            return (chunk,)
        chunk = chunk.lower()
        if len(chunk) > 1 and chunk[-1:] in b".," and chunk[-2:-1].isalnum():
            return chunk[:-1], chunk[-1:]
        return (chunk,)


_encoders: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def key_hash(doc_id: int | None, k: int) -> int:
    return xxhash.xxh3_64_intdigest(f"{doc_id}#{k}")


def build_index(keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Bit arrays of the levels and the slot of each (distinct) key hash."""
    slots = np.zeros(len(keys), np.int64)
    levels, left, taken = [], np.arange(len(keys)), 0
    while len(left):
        size = max(64, 2 * len(left))
        at = level_place(keys[left], len(levels), size)
        bits = np.bincount(at, minlength=size) == 1
        ranks = np.cumsum(bits) - 1
        alone = bits[at]
        slots[left[alone]] = taken + ranks[at[alone]]
        taken += int(bits.sum())
        left = left[~alone]
        levels.append(bits)
    return levels, slots


def level_place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix64(keys + _STEP * np.uint64(level + 1)) % np.uint64(size)).astype(np.int64)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix64(~keys) >> np.uint64(32)).astype("<u4")


def shard_bytes(keys: list[int], payloads: list[bytes], dtype: np.dtype) -> bytes:
    hashes = np.array(keys, np.uint64)
    levels, slots = build_index(hashes)
    counts = np.array([len(p) // dtype.itemsize for p in payloads], np.int64)
    prints, offsets, lengths = np.zeros(len(keys), "<u4"), np.zeros(len(keys), "<u8"), np.zeros(len(keys), "<u4")
    prints[slots] = fingerprints(hashes)
    offsets[slots] = np.cumsum(counts) - counts
    lengths[slots] = counts
    index = b"".join(np.packbits(b, bitorder="little").tobytes() for b in levels)
    header = json.dumps({"docs": len(keys), "ids": int(counts.sum()), "width": dtype.itemsize,
                         "levels": [len(b) for b in levels], "bits": len(index)}).encode()
    return b"".join([MAGIC, len(header).to_bytes(8, "little"), header, index, prints.tobytes(), offsets.tobytes(),
                     lengths.tobytes(), *payloads])


class Shard:
    """Constant-time keyed access to a shard file."""

    def __init__(self, file):
        self.file = file
        file.seek(0)
        if file.read(8) != MAGIC:
            raise ValueError("not a token shard")
        size = int.from_bytes(file.read(8), "little")
        h = json.loads(file.read(size))
        raw, n = file.read(h["bits"]), h["docs"]
        self.levels, at, self.before = [], 0, [0]
        for bits in h["levels"]:
            took = -(-bits // 8)
            self.levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, took, at), count=bits, bitorder="little"))
            at += took
        self.ranks = [np.cumsum(b, dtype=np.int64) for b in self.levels]
        for r in self.ranks:
            self.before.append(self.before[-1] + int(r[-1]))
        self.prints = np.frombuffer(file.read(4 * n), "<u4")
        self.offsets = np.frombuffer(file.read(8 * n), "<u8").astype(np.int64)
        self.lengths = np.frombuffer(file.read(4 * n), "<u4").astype(np.int64)
        self.dtype = np.dtype(f"<u{h['width']}")
        self.start = 16 + size + h["bits"] + 16 * n

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key hash, -1 where no such key was stored."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            at = level_place(keys[left], level, len(bits))
            here = bits[at] == 1
            out[left[here]] = self.before[level] + self.ranks[level][at[here]] - 1
            left = left[~here]
        found = out >= 0
        found[found] = self.prints[out[found]] == fingerprints(keys[found])
        return np.where(found, out, -1)

    def ids(self, slot: int) -> np.ndarray:
        self.file.seek(self.start + int(self.offsets[slot]) * self.dtype.itemsize)
        return np.frombuffer(self.file.read(int(self.lengths[slot]) * self.dtype.itemsize), self.dtype)


_MANIFEST = "part int, seq int, file string, first_id bigint, first_k bigint, docs bigint, ids bigint"


def blocks_of(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[pa.Array]:
    """Consecutive slices of about ``most`` bytes, one text at least."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        yield texts.slice(at, to - at)
        at = to


def _writer(folder: str, tokenizer: str, end_id: int, shard_ids: int, first_k: dict[int, int]):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.dtype).tobytes()
        part, seq, held, total = TaskContext.get().partitionId(), 0, [], 0
        last: tuple = (False, None, -1)  # id and number of the row before; a first one may go on from the task before
        disk, top = filesystem(folder)

        def close() -> pa.RecordBatch:
            name = f"shard-{part:06d}-{seq:06d}.bin"
            private = f"{top}/.{name}.{uuid.uuid4().hex}"
            with disk.open_output_stream(private) as f:
                f.write(shard_bytes([key_hash(i, k) for i, k, _ in held], [p for _, _, p in held], enc.dtype))
            disk.move(private, f"{top}/{name}")
            row = (part, seq, name, held[0][0], held[0][1], len(held), total)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (
                pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                names=["part", "seq", "file", "first_id", "first_k", "docs", "ids"])

        for batch in batches:
            ids = iter(batch.column(0).to_pylist())
            for block in blocks_of(batch.column(1)):
                tokens, places = enc.encode_block(block)
                for at, to in zip(places[:-1].tolist(), places[1:].tolist(), strict=True):
                    doc_id = next(ids)
                    if not last[0]:
                        k = first_k.get(part, 0)
                    else:
                        k = last[2] + 1 if last[1] == doc_id else 0
                    last = (True, doc_id, k)
                    payload = tokens[at:to].tobytes() + end
                    held.append((doc_id, k, payload))
                    total += len(payload) // enc.dtype.itemsize
                    if total >= shard_ids:
                        yield close()
                        seq, held, total = seq + 1, [], 0
        if held:
            yield close()

    return write


def write_store(docs: DataFrame, folder: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                end_id: int = END_ID, shard_ids: int = SHARD_IDS, part_bytes: int = 64 << 20) -> DataFrame:
    """Write ``docs`` as token shards under ``folder``; returns the manifest,
    one row per shard with its base (ids of all documents before it)."""
    spark = docs.sparkSession
    disk, top = filesystem(folder)
    disk.create_dir(top, recursive=True)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), utf8(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = parts_for(spark, size, part_bytes)
    if rows.groupBy("doc_id").count().where("count > 1").isEmpty():
        parts, first_k = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id"), {}
    else:
        parts, first_k = _ranged_copies(rows, n)
    return staged(parts.mapInArrow(_writer(folder, tokenizer, end_id, shard_ids, first_k), _MANIFEST), "token-manifest")


def _ranged_copies(rows: DataFrame, n: int) -> tuple[DataFrame, dict[int, int]]:
    """Rows whose ids repeat, in order of (id, text): an id may spread over any
    number of partitions, equal rows too (they are counted, then numbered). With
    them the number k that the first row of each partition has among those of
    its id, from one row per partition."""
    checkpoint_root(rows.sparkSession)
    order = ["doc_id", "text", "copy"]
    parts = rows.groupBy("doc_id", "text").count() \
        .select("doc_id", "text", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("count"))).alias("copy")) \
        .repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text").checkpoint()
    first_k, carry = {}, None
    for r in sorted(parts.select("doc_id").mapInArrow(_partition_ends, "part int, first bigint, last bigint, n bigint, n_last bigint").collect()):
        if carry and carry[0] == r["first"]:
            first_k[r.part] = carry[1]
        whole = r.n == r.n_last
        carry = (r["last"], r.n_last + (first_k.get(r.part, 0) if whole else 0))
    return parts, first_k


def _partition_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first, last, n, n_last = None, None, 0, 0
    for batch in batches:
        for doc_id in batch.column(0).to_pylist():
            n_last = n_last + 1 if n and doc_id == last else 1
            first = doc_id if not n else first
            last, n = doc_id, n + 1
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((TaskContext.get().partitionId(), first, last, n, n_last), (
            pa.int32(), *[pa.int64()] * 4), strict=True)], names=["part", "first", "last", "n", "n_last"])


def shard_bases(manifest: DataFrame) -> list[tuple]:
    """(first key, file, base) of every shard in key order. One short row per
    shard of some ten MB: the list stays thousands of times smaller than the
    store."""
    out, base = [], 0
    for r in sorted(manifest.collect(), key=lambda r: (r.part, r.seq)):
        out.append(((r.first_id is not None, r.first_id or 0, r.first_k), r.file, base))
        base += r.ids
    return out


def _router(sent) -> Column:
    @F.arrow_udf("int")
    def shard(ids: pa.Array, ks: pa.Array) -> pa.Array:
        firsts = [key for key, _, _ in sent.value]
        return pa.array([bisect_right(firsts, (i is not None, i or 0, k)) - 1
                         for i, k in zip(ids.to_pylist(), ks.to_pylist(), strict=True)], pa.int32())

    return shard(F.col("doc_id"), F.col("k"))


_READ = "doc_id bigint, start bigint, ids array<int>"


def _reader(folder: str, sent, digest: bool):
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] if digest else ["doc_id", "start", "ids"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, top = filesystem(folder)
        held: tuple = (None, None)
        for batch in batches:
            shards = batch.column(2).to_numpy()
            for run in np.split(np.arange(len(shards)), np.flatnonzero(np.diff(shards)) + 1):
                if not len(run):
                    continue
                number = int(shards[run[0]])
                _, file, base = sent.value[number]
                if held[0] != number:
                    held = (number, Shard(disk.open_input_file(f"{top}/{file}")))
                doc_ids = batch.column(0).slice(int(run[0]), len(run)).to_pylist()
                ks = batch.column(1).slice(int(run[0]), len(run)).to_pylist()
                keys = np.array([key_hash(i, k) for i, k in zip(doc_ids, ks, strict=True)], np.uint64)
                slots = held[1].slots(keys)
                if (slots < 0).any():
                    raise KeyError(f"a key is missing from {file}")
                starts = pa.array(held[1].offsets[slots] + base)
                found = (held[1].ids(s) for s in slots)
                if digest:
                    rows = [(len(x), zlib.crc32(x.astype("<u4").tobytes())) for x in found]
                    rest = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())]
                else:
                    rest = [pa.array([x.astype(np.int32) for x in found], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), starts, *rest], names=names)

    return read


def read_store(keys: DataFrame, manifest: DataFrame, folder: str, digest: bool = False) -> DataFrame:
    """Look up ``keys`` (column doc_id; repeated ids ask for their rows in
    turn): their ids, or with ``digest`` their number and crc32."""
    spark = keys.sparkSession
    bases = shard_bases(manifest)
    sent = spark.sparkContext.broadcast(bases)
    asked = keys.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).count() \
        .select("doc_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("count") - 1)).alias("k"))
    dealt = asked.withColumn("shard", _router(sent)).repartition(parts_for(spark, len(bases), 4), "shard") \
        .sortWithinPartitions("shard")
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" if digest else _READ
    return dealt.mapInArrow(_reader(folder, sent, digest), schema)


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: write every document, read all back by key."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    folder = shared_dir(spark, "tokens")
    manifest = write_store(docs, folder, public_tokenizers.path("word_bpe_49k.json"))
    return read_store(docs.select("doc_id"), manifest, folder, digest=True)
