"""Hard negatives by rotated one-bit codes with deterministic intervals.

Vectors become integers (``floor(256 x)``) and are turned by a seeded rotation
(random signs, then a Walsh-Hadamard transform, which keeps integers). Stored
with each entry are the sign bits ``b`` of its turned vector ``o``, the code
vector's alignment ``a = <o, b>/sqrt(D)`` and the length ``r`` of what the code
leaves over. An anchor's turned vector ``q`` is rounded to ``PLANES`` bits; its
product with a code is a sum of popcounts of its bit planes with the code. As
``o = a u + rest`` with the unit vector ``u = b/sqrt(D)`` and ``rest`` at right
angles to it, Cauchy and Schwarz give

    |<q, o> - a <q', u>| <= sqrt(|q'|^2 - <q', u>^2) r + |q - q'| |o|,

an interval that surely holds the score. Entries whose interval ends below the
score that enough entries surely reach, or that misses the asked window, are left
out; all others are scored in integers. So the results are exact.

The work is two passes over a grid of entry blocks (``BLOCK`` rows, dealt by
hash) and anchors: a task loads a block with its codes and streams the anchors
past it. The first pass finds each anchor's best rows of its own label, the
second, for each of them, the best rows of other labels inside its score window.
A task emits at most the asked number for each window, and Spark ranks those.
Nothing is cut off, no bucket is capped, and equal vectors are rows like others.

Where many intervals survive (one bit of 64 components leaves half of a vector's
length over), a chunk of anchors is scored against the block by one product of
matrices; where few do, only those rows are. Both give the same numbers.

Defined results: rows with a null id, label, vector or component or a non-finite
component take no part; rows equal in id, label and vector count once; rows of
one id that differ are rows of their own, and never each other's positive or
negative; vectors meet only vectors of their own length; zero and empty vectors
score 0. Products are exact at any size; a returned score beyond 64 bits is an
error. Ties go to the smaller id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerflow.llm.common import parts_for, staged, table

PLANES = 6
BLOCK = 8192
CHUNK = 64
POSITIVES = 5
NEGATIVES = 3
WINDOW = (50, 95)
_SEED = 11
_EXACT = 1 << 53


def turned(x: np.ndarray) -> np.ndarray:
    """Rows times random signs, then the Walsh-Hadamard transform of the next
    power of two; lengths grow by its square root."""
    size = 1 << max(0, math.ceil(math.log2(max(1, x.shape[1]))))
    y = np.zeros((len(x), size))
    y[:, :x.shape[1]] = x * np.random.default_rng(_SEED).choice([-1.0, 1.0], x.shape[1])
    step = 1
    while step < size:
        y = y.reshape(len(x), -1, 2, step)
        y = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], axis=2)
        step *= 2
    return y.reshape(len(x), size)


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits -> rows of 64-bit words."""
    whole = np.zeros((*bits.shape[:-1], -(-bits.shape[-1] // 64) * 64), bool)
    whole[..., :bits.shape[-1]] = bits
    return np.packbits(whole, axis=-1).view(np.uint64)


def coded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, alignments, remainders and lengths of the rows."""
    y = turned(x)
    squared = (y * y).sum(axis=1)
    aligned = np.abs(y).sum(axis=1) / math.sqrt(y.shape[1])
    return packed(y >= 0), aligned, np.sqrt(np.maximum(squared - aligned * aligned, 0)), np.sqrt(squared)


class Anchors:
    """Bit planes of some anchors' turned and rounded vectors."""

    def __init__(self, x: np.ndarray):
        y = turned(x)
        self.size = y.shape[1]
        self.low = y.min(axis=1)
        self.step = np.maximum((y.max(axis=1) - self.low) / ((1 << PLANES) - 1), 1e-300)
        level = np.rint((y - self.low[:, None]) / self.step[:, None]).astype(np.int64)
        rounded = self.low[:, None] + self.step[:, None] * level
        self.total = level.sum(axis=1)
        self.squared = (rounded * rounded).sum(axis=1)
        self.off = np.sqrt(((y - rounded) ** 2).sum(axis=1))
        self.planes = [packed((level >> p) & 1 == 1) for p in range(PLANES)]

    def intervals(self, codes: np.ndarray, aligned: np.ndarray, left: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the scores of all anchors (rows) with all entries."""
        ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        met = np.zeros((len(self.low), len(codes)), np.int64)
        for p, plane in enumerate(self.planes):
            for word in range(codes.shape[1]):
                met += np.bitwise_count(plane[:, word, None] & codes[None, :, word]).astype(np.int64) << p
        along = self.low[:, None] * (2 * ones - self.size)[None] + self.step[:, None] * (2 * met - self.total[:, None])
        along /= math.sqrt(self.size)
        slack = np.sqrt(np.maximum(self.squared[:, None] - along * along, 0)) * left[None] + self.off[:, None] * length[None]
        slack += 1e-9 * (np.sqrt(self.squared)[:, None] + self.off[:, None]) * length[None]  # rounding of the bounds themselves
        middle = along * aligned[None]
        return np.floor((middle - slack) / self.size), np.ceil((middle + slack) / self.size)


def integers(column: pa.Array, dim: int) -> np.ndarray:
    """floor(256 x); float64 holds these whole numbers exactly."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)
    return np.floor(256.0 * x)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows of a with all rows of b."""
    top = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1])
    if top < _EXACT:
        return a @ b.T
    whole = [np.array([[int(v) for v in r] for r in x], object).reshape(x.shape) for x in (a, b)]
    return whole[0] @ whole[1].T


class Block:
    """Entries of one block, in ascending order of their ids."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray, codes: np.ndarray, aligned: np.ndarray, left: np.ndarray, length: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.x, self.ids, self.labels = x[order], ids[order], labels[order]
        self.stored = codes[order], aligned[order], left[order], length[order]

    def best(self, x: np.ndarray, ids: list[int], labels: list[int], windows: list[list[tuple[float, float]]], same: bool, k: int):
        """For each anchor and each of its score windows the k best entries of
        its own (``same``) or another label: (anchor, window, id, score)."""
        low, high = Anchors(x).intervals(*self.stored)
        allowed = (self.labels[None] == np.array(labels)[:, None]) == same
        allowed &= self.ids[None] != np.array(ids)[:, None]
        asked = []  # (anchor, window number, its bounds, entries that may be among the best)
        for i, own in enumerate(windows):
            for w, (least, most) in enumerate(own):
                may = np.flatnonzero(allowed[i] & (high[i] >= least) & (low[i] <= most))
                sure = low[i, may][(low[i, may] >= least) & (high[i, may] <= most)]
                if len(sure) > k:  # k entries surely reach this score inside the window
                    may = may[high[i, may] >= np.partition(sure, len(sure) - k)[len(sure) - k]]
                asked.append((i, w, least, most, may))
        dense = sum(len(a[4]) for a in asked) * 8 > len(x) * len(self.x)
        scores = products(x, self.x) if dense and len(self.x) else None
        for i, w, least, most, may in asked:
            score = scores[i, may] if scores is not None else products(x[i:i + 1], self.x[may])[0]
            inside = (score >= least) & (score <= most)
            may, score = may[inside], score[inside]
            if len(score) > k:
                near = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
                may, score = may[near], score[near]
            for at in np.argsort(-score, kind="stable")[:k]:  # entries are in order of their ids
                yield i, w, int(self.ids[may[at]]), int(score[at])


def _coder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries (dim, vec_id, label, vec) -> with code, alignment, remainder and length."""
    for batch in batches:
        dims = batch.column(0).to_numpy()
        for dim in np.unique(dims):
            own = batch.filter(pa.array(dims == dim))
            codes, *rest = coded(integers(own.column(3), int(dim)))
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array([c.tobytes() for c in codes], pa.binary()), *[pa.array(r) for r in rest]],
                                             names=["dim", "vec_id", "label", "vec", "code", "aligned", "rest", "length"])


_ENTRY = "dim int, vec_id bigint, label bigint, vec array<double>, code binary, aligned double, rest double, length double"


def _searcher(window: tuple[int, int] | None, k: int):
    """Rows sorted by (dim, block, kind): a block's entries, then its anchors.
    With a window (percent of each score) other labels are searched, else the own."""
    def bounds(scores: list[int]) -> list[tuple[float, float]]:
        if window is None:
            return [(-math.inf, math.inf)]
        return [(-(-s * window[0] // 100), s * window[1] // 100) for s in scores]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, block = None, [], None
        for batch in batches:
            dims, blocks, kinds = (batch.column(i).to_numpy() for i in range(3))
            change = np.flatnonzero((np.diff(dims) != 0) | (np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
            for run in np.split(np.arange(len(dims)), change):
                if not len(run):
                    continue
                own = batch.slice(int(run[0]), len(run))
                dim = int(dims[run[0]])
                if (dim, blocks[run[0]]) != key:
                    key, parts, block = (dim, blocks[run[0]]), [], None
                ids, labels = own.column(3).to_numpy(), own.column(4).to_numpy()
                x = integers(own.column(5), dim)
                if kinds[run[0]] == 0:
                    codes = np.frombuffer(b"".join(own.column(6).to_pylist()), np.uint64).reshape(len(run), -1)
                    parts.append((x, ids, labels, codes, *[own.column(i).to_numpy() for i in (7, 8, 9)]))
                    continue
                if not parts:
                    continue
                block = block or Block(*[np.concatenate(p) for p in zip(*parts, strict=True)])
                windows = [bounds(s) for s in own.column(10).to_pylist()]
                keys = own.column(11).to_pylist()
                for at in range(0, len(run), CHUNK):
                    part = slice(at, at + CHUNK)
                    found = list(block.best(x[part], ids[part].tolist(), labels[part].tolist(), windows[part], window is None, k))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([keys[at + f[0]] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int32()),
                         pa.array([f[2] for f in found], pa.int64()), pa.array([f[3] for f in found], pa.int64())],
                        names=["anchor", "window", "vec_id", "score"])

    return search


def _searched(blocks: DataFrame, count: int, anchors: DataFrame, window: tuple[int, int] | None, k: int) -> DataFrame:
    """``anchors`` (dim, vec_id, label, vec, scores, anchor) past all blocks ->
    the k best for each of their scores: anchor, window, vec_id, score, rank."""
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("code", "binary"), ("aligned", "double"), ("rest", "double"), ("length", "double"))]
    entries = blocks.select("dim", "block", F.lit(0).alias("kind"), "vec_id", "label", "vec", "code", "aligned", "rest", "length",
                            F.lit(None).cast("array<bigint>").alias("scores"), F.lit(None).cast("bigint").alias("anchor"))
    dealt = anchors.select("dim", F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("block"), F.lit(1).alias("kind"), "vec_id", "label",
                           "vec", *nothing, "scores", "anchor")
    found = entries.unionByName(dealt).repartition(parts_for(blocks.sparkSession, count, 1), "dim", "block") \
        .sortWithinPartitions("dim", "block", "kind").mapInArrow(_searcher(window, k), "anchor bigint, window int, vec_id bigint, score bigint")
    best = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, vec_id: str = "vec_id", vec: str = "embedding", label: str | Column = "label",
         positives: int = POSITIVES, negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW, block: int = BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score for the rows that ``is_anchor`` (an expression over
    ``vec_id``) picks; a negative's score is ``window`` percent of its positive's."""
    spark = vectors.sparkSession
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"),
                          (F.col(f"`{label}`") if isinstance(label, str) else label).cast("bigint").alias("label"),
                          F.col(f"`{vec}`").cast("array<double>").alias("vec")) \
        .where("vec_id is not null and label is not null and vec is not null").where(finite).distinct()
    entries = staged(rows.select(F.size("vec").alias("dim"), "vec_id", "label", "vec").mapInArrow(_coder, _ENTRY), "coded")
    total = entries.count()
    count = max(1, -(-total // block))
    own = F.xxhash64("vec_id", "label", "vec")
    blocks = entries.withColumn("block", F.pmod(own, F.lit(count)).cast("int"))
    anchors = entries.where(is_anchor).select("dim", "vec_id", "label", "vec", F.xxhash64("dim", "vec_id", "label", "vec", F.lit("anchor")).alias("anchor"))
    alone = anchors.withColumn("scores", F.lit(None).cast("array<bigint>"))
    first = staged(_searched(blocks, count, alone, None, positives), "positives")
    wanted = first.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("found")) \
        .select("anchor", F.col("found.score").alias("scores"))  # at most ``positives``
    second = _searched(blocks, count, anchors.join(wanted, "anchor"), window, negatives)
    of = first.select("anchor", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return second.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(of, ["anchor", "window"]) \
        .join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor") \
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: negatives of the rows whose id 50 divides."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label=label)


#: All products of anchors with all rows, in integers.
ORACLE = r"""
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= 3
"""
