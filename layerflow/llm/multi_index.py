"""Approximate nearest neighbours by an inverted multi-index.

Both halves of a vector are quantised on their own (k-means on a bounded
sample, ``SAMPLE`` vectors drawn by hash); an entry lives in the cell of its
pair of centroids. A query visits cells in order of the summed distances of
its halves to the pair, by a heap over the two sorted centroid lists, until
the visited cells hold ``reach`` of all entries, and ranks their entries by
exact distance. ``reach`` is calibrated on the sample: the smallest share of
``REACHES`` whose recall there is at least ``RECALL`` against brute force (in
the whole table true neighbours are nearer still, so recall is no lower).

Equal vectors are one entry that carries its k + 1 smallest ids, which is all
that any of its queries can return, and equal queries are searched once: a
vector repeated without end costs no more than another. Cells are dealt to
shards of at most ``SHARD`` entries; a larger cell is split over several. A task
loads a shard and streams the queries that visit it, so neither hot cells nor
many queries gather in memory. On the driver are the centroids and the counts
of the at most ``MAX_CENTROIDS``² cells.

Defined results: vectors that are null, of zero length or all zero, that hold
null or non-finite components, or whose length is not the table's commonest
(the smaller of two equally common) take no part; nor do null ids. Repeated
rows count once. Ties go to the smaller id. With fewer than k candidates all
of them are returned.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerflow.llm.common import parts_for, staged, table

SAMPLE = 20_000
PROBES = 150
RECALL = 0.96
REACHES = (0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
CELL = 8
MAX_CENTROIDS = 256
SHARD = 16_384


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Lloyd's rounds from distinct sample points."""
    if x.shape[1] == 0:
        return np.zeros((1, 0))
    points = np.unique(x, axis=0)
    centroids = points[np.random.default_rng(seed).permutation(len(points))[:k]]
    for _ in range(rounds):
        near = nearest(x, centroids)
        count = np.bincount(near, minlength=len(centroids))
        total = np.zeros_like(centroids)
        np.add.at(total, near, x)
        centroids = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centroids)
    return centroids


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centroids.T + (centroids * centroids).sum(1)[None], 0)


def nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return squared(x, centroids).argmin(axis=1) if x.shape[1] else np.zeros(len(x), np.int64)


class Codebook:
    def __init__(self, sample: np.ndarray, centroids: int):
        self.cut = sample.shape[1] // 2
        self.first, self.second = kmeans(sample[:, :self.cut], centroids), kmeans(sample[:, self.cut:], centroids)
        self.width = len(self.second)

    def cells(self, x: np.ndarray) -> np.ndarray:
        return nearest(x[:, :self.cut], self.first) * self.width + nearest(x[:, self.cut:], self.second)

    def visited(self, q: np.ndarray, population: np.ndarray, enough: float) -> list[int]:
        """Cells by summed distance until they hold ``enough`` entries."""
        a = squared(q[None, :self.cut], self.first)[0] if self.cut else np.zeros(1)
        b = squared(q[None, self.cut:], self.second)[0] if len(q) > self.cut else np.zeros(1)
        rows, cols = np.argsort(a, kind="stable").tolist(), np.argsort(b, kind="stable").tolist()
        a, b = np.sort(a).tolist(), np.sort(b).tolist()
        heap, out, held = [(a[0] + b[0], 0, 0)], [], 0
        while heap and held < enough:
            _, i, j = heapq.heappop(heap)
            cell = rows[i] * self.width + cols[j]
            count = population[cell]
            if count:
                out.append(cell)
                held += count
            if j + 1 < len(b):
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
        return out


def calibrated(book: Codebook, sample: np.ndarray, k: int) -> float:
    """The smallest reach whose recall on the sample is high enough."""
    cells = book.cells(sample)
    population = np.bincount(cells, minlength=len(book.first) * book.width)
    needed = []
    for at in range(0, len(sample), max(1, len(sample) // PROBES)):
        distance = ((sample - sample[at]) ** 2).sum(1)
        distance[at] = np.inf
        true = np.argsort(distance, kind="stable")[:min(k, len(sample) - 1)]
        order = book.visited(sample[at], population, len(sample))
        before = dict(zip(order, np.cumsum([0, *population[order][:-1]]), strict=True))
        needed += [before[cells[t]] / len(sample) for t in true]
    return next((r for r in REACHES if not needed or np.mean(np.array(needed) < r) >= RECALL), 1.0)


def usable(vec: Column, dim: int) -> Column:
    """A vector of the given length, not zero, all components finite."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vec.isNotNull() & (F.size(vec) == dim) & finite & F.exists(vec, lambda x: x != 0)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def _placer(sent, dim: int):
    """Entries (vec, ids) -> with their shard and cell."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, first_shard, blocks = sent.value[:3]
        for batch in batches:
            cells = book.cells(_matrix(batch.column(0), dim)) if len(batch) else np.zeros(0, np.int64)
            own = np.array([ids[0] for ids in batch.column(1).to_pylist()], np.int64)
            shard = first_shard[cells] + np.abs(own) % blocks[cells]
            yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int64)), pa.array(np.zeros(len(batch), np.int32)), batch.column(0),
                                              batch.column(1), pa.array([[int(c)] for c in cells], pa.list_(pa.int32()))],
                                             names=["shard", "kind", "vec", "ids", "cells"])

    return place


def _traverser(sent, dim: int):
    """Queries (vec, id) -> a row for each shard with the cells to visit."""
    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, first_shard, blocks, population, enough = sent.value
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            ids = batch.column(1).to_pylist()
            for i in range(len(batch)):
                per_shard: dict[int, list[int]] = {}
                for cell in book.visited(x[i], population, enough):
                    for shard in range(first_shard[cell], first_shard[cell] + blocks[cell]):
                        per_shard.setdefault(shard, []).append(cell)
                n = len(per_shard)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(per_shard), pa.int64()), pa.array(np.ones(n, np.int32)), pa.array([x[i]] * n, pa.list_(pa.float64())),
                     pa.array([[ids[i]]] * n, pa.list_(pa.int64())), pa.array(list(per_shard.values()), pa.list_(pa.int32()))],
                    names=["shard", "kind", "vec", "ids", "cells"])

    return traverse


def _ranker(dim: int, k: int):
    """Rows sorted by (shard, kind): a shard's entries, then its queries."""
    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts, entries = None, [], None

        def loaded():
            x = np.concatenate([p[0] for p in parts])
            ids = [i for p in parts for i in p[1]]
            cells = np.concatenate([p[2] for p in parts])
            order = np.argsort(cells, kind="stable")
            return x[order], [ids[i] for i in order], cells[order]

        for batch in batches:
            shards, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            x, ids, cells = _matrix(batch.column(2), dim), batch.column(3).to_pylist(), batch.column(4).to_pylist()
            mark = shards * 2 + kinds
            found: tuple[list, list, list] = ([], [], [])
            for run in np.split(np.arange(len(mark)), np.flatnonzero(np.diff(mark)) + 1):
                if not len(run):
                    continue
                a, b = int(run[0]), int(run[-1]) + 1
                if shards[a] != shard:
                    shard, parts, entries = shards[a], [], None
                if kinds[a] == 0:
                    parts.append((x[a:b], ids[a:b], np.array([c[0] for c in cells[a:b]])))
                    continue
                if not parts:
                    continue
                entries = entries or loaded()
                for i in range(a, b):
                    wanted = np.array(sorted(cells[i]))
                    lo, hi = np.searchsorted(entries[2], wanted), np.searchsorted(entries[2], wanted, side="right")
                    at = np.concatenate([np.arange(p, q) for p, q in zip(lo, hi, strict=True)])
                    if not len(at):
                        continue
                    score = np.sqrt(((entries[0][at] - x[i]) ** 2).sum(axis=1))
                    if len(at) > k + 1:
                        score_cut = np.partition(score, k)[k]
                        near = np.flatnonzero(score <= score_cut)
                    else:
                        near = np.arange(len(at))
                    best = heapq.nsmallest(k + 1, ((float(score[n]), v) for n in near for v in entries[1][at[n]]))
                    found[0].extend([ids[i][0]] * len(best))
                    found[1].extend(v for _, v in best)
                    found[2].extend(s for s, _ in best)
            yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.float64())],
                                             names=["asked", "vec_id", "score"])

    return rank


_DEALT = "shard bigint, kind int, vec array<double>, ids array<bigint>, cells array<int>"


def search(vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """The k nearest other rows of each row that ``is_query`` (an expression
    over ``vec_id``) picks: query_id, rank, vec_id, score (Euclidean)."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), F.col(f"`{vec}`").cast("array<double>").alias("vec")) \
        .where("vec_id is not null")
    sizes = rows.where("size(vec) > 0").groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = sizes["dim"] if sizes else 1
    rows = rows.where(usable(F.col("vec"), dim)).distinct()
    # of each vector the k + 1 smallest ids; Spark cuts each task's rows to them before the exchange
    least = rows.withColumn("n", F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))).where(F.col("n") <= k + 1)
    entries = staged(least.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "entries")
    total = entries.count()
    queries = rows.where(is_query)
    asked = queries.groupBy("vec").agg(F.min("vec_id").alias("asked"))
    if not total:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rate = min(1.0, SAMPLE / total)
    drawn = entries.where(F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(1 << 20)) < rate * (1 << 20)).orderBy(F.xxhash64(F.col("ids")[0])) \
        .limit(SAMPLE).select("vec").collect() or entries.orderBy(F.xxhash64(F.col("ids")[0])).limit(1).select("vec").collect()
    sample = np.array([r[0] for r in drawn], np.float64)
    book = Codebook(sample, int(np.clip(2 ** round(np.log2(max(1.0, (total / CELL) ** 0.5))), 2, MAX_CENTROIDS)))
    reach = calibrated(book, sample, k)
    book_sent = spark.sparkContext.broadcast(book)
    counted = entries.select(_cells(book_sent, dim)(F.col("vec")).alias("cell")).groupBy("cell").count().collect()
    population = np.zeros(len(book.first) * book.width, np.int64)
    for r in counted:
        population[r["cell"]] = r["count"]
    first_shard, blocks = dealt(population)
    sent = spark.sparkContext.broadcast((book, first_shard, blocks, population, reach * total))
    shards = int((first_shard + blocks).max())
    placed = entries.select("vec", "ids").mapInArrow(_placer(sent, dim), _DEALT)
    wanted = asked.select("vec", "asked").mapInArrow(_traverser(sent, dim), _DEALT)
    near = placed.union(wanted).repartition(parts_for(spark, shards, 1), "shard").sortWithinPartitions("shard", "kind") \
        .mapInArrow(_ranker(dim, k), "asked bigint, vec_id bigint, score double")
    order = (F.col("score"), F.col("vec_id"))
    best = near.withColumn("n", F.row_number().over(Window.partitionBy("asked").orderBy(*order))).where(F.col("n") <= k + 1).drop("n")
    own = queries.join(asked, "vec").select(F.col("vec_id").alias("query_id"), "asked")
    return own.join(best, "asked").where("vec_id <> query_id") \
        .withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def dealt(population: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First shard and number of blocks of each cell: small cells share a
    shard of at most SHARD entries, a large one is split over its own."""
    first, blocks = np.zeros(len(population), np.int64), np.ones(len(population), np.int64)
    shard = held = 0
    for cell, count in enumerate(population.tolist()):
        if held and held + count > SHARD:
            shard, held = shard + 1, 0
        first[cell] = shard
        blocks[cell] = max(1, -(-count // SHARD))
        held += count
        if blocks[cell] > 1:
            shard, held = shard + int(blocks[cell]), 0
    return first, blocks


def _cells(sent, dim: int):
    @F.arrow_udf("int")
    def cells(vecs: pa.Array) -> pa.Array:
        return pa.array(sent.value.cells(_matrix(vecs, dim)).astype(np.int32)) if len(vecs) else pa.array([], pa.int32())

    return cells


def op2_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the 10 nearest of every id divisible by 100."""
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
