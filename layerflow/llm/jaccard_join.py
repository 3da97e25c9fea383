"""N-gram Jaccard join: a size-aware heavy-light set join.

A document's set holds its distinct word 5-grams (64-bit hashes). Documents
with equal sets form a class; the join runs between classes. Two sets of n and
m shingles link when 100 * intersection >= 80 * union, which is to say that
they share at least ceil(4 (n + m) / 9) shingles.

Light sets (at most S shingles) are joined by enumeration: every subset of
each size that some partner asks for is a key, and sets under one key link
when their sizes allow it. One row per set and key is tied to the smallest set
of the key; a linked pair always ties both its sets there, so components are
whole without pairs.

Heavy sets are joined over inverted lists of their prefixes in one global
order of shingles. A prefix is so long that a linked pair shares at least
``share(n)`` shingles of it, so a document that merely quotes a common passage
falls out by counting. The order puts shingles found often (per batch of
documents) last; any order gives the same links, a good one gives short lists.
Sets of 4/5 S to S shingles also enter the lists, to meet heavy partners.

The boundary S has the smallest cost: rows of enumeration against rows of
lists, summed over the counts of sets by size.

Lists are shipped as packed arrays of hash buckets and kept where they hold
two classes or more. First every class is compared with the hub of its list
within a band of sizes, the class whose lists are longest: in a group of near
copies that is the least edited one. Then, once components of those links are
known, only pairs from different components are, of which one is outside the
component most common on the list, and neither of which has more shingles of
its own alone than a link allows (known for shingles that are not common, where
the other's prefix reaches common ones). A group of thousands of copies so
costs a few comparisons each. Every pair is settled by its whole sets.

Defined results: words are maximal runs outside ``\\x20 \\x09-\\x0D`` with A-Z
in lower case; text with fewer than five words has one shingle, null, empty or
blank text none and links with nothing (its component is its own id). Null ids
take part in links but name a component only if it has no other id. Repeated
rows are one class. Two different shingles are taken for one with a chance of
2^-64 per pair compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.llm.common import mix64, parts_for, release, staged, table, utf8, wrapped
from layerflow.llm.components import components

WORDS = 5
MAX_LIGHT = 24
SCAN_COST = 4
COMMON_IN_BATCH = 4
COMMON_AT_ALL = 64
COMMON_SHINGLES = 1 << 20
POSTINGS = 1 << 20
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.array([pow(int(_FACTOR), k, 1 << 64) for k in range(WORDS - 1, -1, -1)], np.uint64)


# ---- sets -----------------------------------------------------------------

def shingles_of(text: bytes) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    split = text.lower().split()
    words = np.fromiter(map(xxhash.xxh3_64_intdigest, split), np.uint64, len(split))
    with np.errstate(over="ignore"):
        if len(words) < WORDS:
            if not len(words):
                return words
            short = (words * _POWERS[:len(words)]).sum() + np.uint64(len(words))
            return mix64(np.array([short], np.uint64))
        last = len(words) - WORDS + 1
        total = words[:last] * _POWERS[0]
        for k in range(1, WORDS):
            total += words[k:k + last] * _POWERS[k]
    found = mix64(total)
    found.sort()
    return found[np.concatenate([[True], found[1:] != found[:-1]])]


def node_of(shingles: np.ndarray) -> int:
    """The class of a set: a signed 64-bit hash."""
    return int(np.array([xxhash.xxh3_64_intdigest(shingles.tobytes())], np.uint64).view(np.int64)[0])


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 80 * (len(a) + len(b) - both)


# ---- sizes ----------------------------------------------------------------

def need(n: int, m: int) -> int:
    """Shared shingles that sets of n and m need to link."""
    return -(-4 * (n + m) // 9)


def share(n):
    """Prefix shingles that a linked pair shares at least (int or array)."""
    return 1 + n // 20


def prefix(n):
    return np.minimum(n, n - (4 * n + 4) // 5 + share(n))


def subset_sizes(n: int, light: int) -> list[int]:
    """Subset sizes that a set of n shingles enumerates for light partners."""
    return sorted({need(n, m) for m in range(-(-4 * n // 5), min(light, 5 * n // 4) + 1)} & set(range(1, n + 1)))


def boundary(counts: dict[int, int]) -> int:
    """The largest light size, by the cost of rows; ``counts``: sets by size
    (at most MAX_LIGHT)."""
    def cost(light: int) -> int:
        rows = sum(c * sum(comb(n, k) for k in subset_sizes(n, light)) for n, c in counts.items() if n <= light)
        return rows + sum(c * SCAN_COST * int(prefix(n)) for n, c in counts.items() if n >= first_listed(light))

    return min(range(1, MAX_LIGHT + 1), key=lambda s: (cost(s), s))


def first_listed(light: int) -> int:
    """The smallest size that enters the lists."""
    return -(-4 * (light + 1) // 5)


# ---- passes over the documents --------------------------------------------

_SETS = "kind int, doc_id bigint, text_hash bigint, node bigint, n bigint, amount bigint, shingles binary"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kind 0: the class and size of each document, and the packed set where it
    may be light. Kind 1: shingles (as node) that several different sets of a
    batch hold, and how many."""
    names = ["kind", "doc_id", "text_hash", "node", "n", "amount", "shingles"]
    held: list[np.ndarray] = []
    size, seen = 0, set()

    def common() -> pa.RecordBatch:
        tokens, amounts = np.unique(np.concatenate(held), return_counts=True)
        tokens, amounts = tokens[amounts >= COMMON_IN_BATCH], amounts[amounts >= COMMON_IN_BATCH]
        none = pa.nulls(len(tokens), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(np.ones(len(tokens), np.int32)), none, none,
                                           pa.array(tokens.view(np.int64)), none, pa.array(amounts.astype(np.int64)),
                                           pa.nulls(len(tokens), pa.binary())], names=names)

    for batch in batches:
        nodes, sizes, light = [], [], []
        for text in batch.column(2):
            shingles = shingles_of(text.as_py())
            node = node_of(shingles) if len(shingles) else None
            nodes.append(node)
            sizes.append(len(shingles))
            light.append(shingles.tobytes() if 0 < len(shingles) <= MAX_LIGHT else None)
            if node is not None and node not in seen:
                seen.add(node)
                held.append(shingles)
                size += len(shingles)
                if size > 2 * POSTINGS:
                    yield common()
                    held, size, seen = [], 0, set()
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(nodes), np.int32)), batch.column(0), batch.column(1),
                                          pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
                                          pa.nulls(len(nodes), pa.int64()), pa.array(light, pa.binary())], names=names)
    if held:
        yield common()
    held.clear()
    release()


_PACKED = "bucket int, tokens binary, nodes binary, sizes binary, rares binary"


def _lister(sent, buckets: int, light: int):
    """Prefix postings, packed by bucket."""
    least = first_listed(light)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, levels = sent.value
        tokens, nodes, sizes, rares, held, seen = [], [], [], [], 0, set()

        def flush() -> Iterator[pa.RecordBatch]:
            t, d, n, z = (np.concatenate(x) for x in (tokens, nodes, sizes, rares))
            bucket = ((t >> np.uint64(20)) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            t, d, n, z, bucket = t[order], d[order], n[order], z[order], bucket[order]
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            starts, stops = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(bucket)]])
            for at in range(0, len(starts), 4096):
                s, e = starts[at:at + 4096], stops[at:at + 4096]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[s])] + [pa.array([x[a:b].tobytes() for a, b in zip(s, e, strict=True)], pa.binary())
                                             for x in (t, d, n, z)], names=["bucket", "tokens", "nodes", "sizes", "rares"])

        for batch in batches:
            for text in batch.column(0):
                shingles = shingles_of(text.as_py())
                n = len(shingles)
                if n < least:
                    continue
                node = node_of(shingles)
                if node in seen:
                    continue
                seen.add(node)
                level = np.zeros(n, np.int8)
                if len(common):
                    at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
                    level = np.where(common[at] == shingles, levels[at], 0)
                order = np.lexsort((shingles, level))[:int(prefix(n))]
                chosen, rare = shingles[order], level[order] == 0
                # how many shingles are not common, whether common ones follow, and whether this one is not common
                rares.append((int(rare.sum()) << 2 | (0 if rare.all() else 2) | rare).astype(np.uint32))
                tokens.append(chosen)
                nodes.append(np.full(len(chosen), node, np.int64))
                sizes.append(np.full(len(chosen), n, np.uint32))
                held += len(chosen)
                if held > POSTINGS:
                    yield from flush()
                    tokens, nodes, sizes, rares, held, seen = [], [], [], [], 0, set()
        if held:
            yield from flush()
        tokens, nodes, sizes, rares = [], [], [], []
        release()

    return pack


def _enumerator(light: int):
    """The subset keys of light sets (node, packed shingles)."""
    def enumerated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for node, packed in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                shingles = np.frombuffer(packed, np.uint64).tolist()
                n = len(shingles)
                rows += [(int(xxhash.xxh3_64_intdigest(np.array(part, np.uint64).tobytes(), seed=k)) - (1 << 63), k, n, node)
                         for k in subset_sizes(n, light) for part in combinations(shingles, k)]
            yield pa.RecordBatch.from_pylist([dict(zip(("key", "k", "n", "node"), r, strict=True)) for r in rows], pa.schema(
                [("key", pa.int64()), ("k", pa.int32()), ("n", pa.int32()), ("node", pa.int64())]))

    return enumerated


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings (token, node, n, rare) of the lists that hold several classes;
    the rows of a bucket follow each other."""
    def lists(rows: list[tuple]) -> pa.RecordBatch:
        t = np.frombuffer(b"".join(r[0] for r in rows), np.uint64)
        d = np.frombuffer(b"".join(r[1] for r in rows), np.int64)
        n, z = (np.frombuffer(b"".join(r[i] for r in rows), np.uint32) for i in (2, 3))
        order = np.lexsort((d, t))
        t, d, n, z = t[order], d[order], n[order], z[order]
        same = t[1:] == t[:-1]
        once = np.concatenate([[True], ~(same & (d[1:] == d[:-1]))])
        t, d, n, z = t[once], d[once], n[once], z[once]
        same = t[1:] == t[:-1]
        several = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        return pa.RecordBatch.from_arrays([pa.array(t[several].view(np.int64)), pa.array(d[several]),
                                           pa.array(n[several].astype(np.int64)), pa.array(z[several].astype(np.int64))],
                                          names=["token", "node", "n", "rare"])

    bucket, held = None, []
    for batch in batches:
        for b, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if b != bucket and held:
                yield lists(held)
                held = []
            bucket = b
            held.append(row)
    if held:
        yield lists(held)


def _node_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes = []
        for text in batch.column(0):
            shingles = shingles_of(text.as_py())
            nodes.append(node_of(shingles) if len(shingles) else None)
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(nodes, pa.int64()), batch.column(0)],
                                         names=["asked", "node", "text"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept: tuple = (None, None)
    for batch in batches:
        u, v, keep = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
        for i in range(len(u)):
            if kept[0] != v[i]:
                kept = (v[i], shingles_of(batch.column(3)[i].as_py()))
            keep.append(linked(shingles_of(batch.column(2)[i].as_py()), kept[1]))
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep, pa.bool_())),
                                          batch.column(1).filter(pa.array(keep, pa.bool_()))], names=["u", "v"])


# ---- the join -------------------------------------------------------------

def _share(n):
    return 1 + F.floor(n / 20)


def _light_links(found: DataFrame, light: int) -> DataFrame:
    sets = found.where(F.col("n").between(1, light)).select("node", "shingles").dropDuplicates(["node"])
    keys = staged(sets.mapInArrow(_enumerator(light), "key bigint, k int, n int, node bigint"), "subsets")
    heads = keys.groupBy("key", "k").agg(F.min(F.struct("n", "node")).alias("head"), F.count("*").alias("c")).where("c > 1")
    return keys.join(heads, ["key", "k"]).where(F.col("n") + F.col("head.n") <= F.floor(9 * F.col("k") / 4)) \
        .select(F.col("node").alias("u"), F.col("head.node").alias("v")).where("u <> v").distinct()


def _settle(pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """The pairs (u, v) that link, by their whole sets."""
    a, b = texts.select(F.col("node").alias("u"), F.col("text").alias("a")), texts.select(F.col("node").alias("v"), F.col("text").alias("b"))
    both = pairs.select("u", "v").join(a, "u").join(b, "v").select("u", "v", "a", "b").sortWithinPartitions("v")
    return staged(both.mapInArrow(_verified, "u bigint, v bigint"), name)


def _counted(pairs: DataFrame) -> DataFrame:
    """Pairs (one row per shared prefix shingle) whose sizes are within 4 : 5 and
    that share enough: of the set whose prefix ends first in the order, the
    prefix shingles that are not shared are not in the other set at all, and
    the rest of it is n - prefix(n) = ceil(4 n / 5) - share(n) shingles."""
    rest = F.greatest(*[F.ceil(4 * F.col(c) / 5) - _share(F.col(c)) for c in ("n", "m")])
    enough = F.greatest(F.least(_share(F.col("n")), _share(F.col("m"))), F.ceil(4 * (F.col("n") + F.col("m")) / 9) - rest)
    return pairs.where((5 * F.least("n", "m") >= 4 * F.greatest("n", "m"))).groupBy("u", "v") \
        .agg(F.count("*").alias("c"), F.first("n").alias("n"), F.first("m").alias("m")).where(F.col("c") >= enough).select("u", "v")


def _heavy_links(docs: DataFrame, sets: DataFrame, hot, buckets: int, light: int) -> DataFrame:
    packed = docs.select("text").mapInArrow(_lister(hot, buckets, light), _PACKED)
    shared = staged(packed.repartition(buckets, "bucket").sortWithinPartitions("bucket")
                    .mapInArrow(_shared, "token bigint, node bigint, n bigint, rare bigint"), "lists")
    bounds = staged(shared.groupBy("node").agg(F.first("n").alias("n"), F.max(F.shiftright("rare", 1)).alias("z"),
                                               F.sum(F.col("rare").bitwiseAND(F.lit(1))).alias("held"))
                    .select("node", (F.col("n") - F.shiftright("z", 1) + F.col("held")).alias("most"),
                            (F.col("z").bitwiseAND(F.lit(1)) > 0).alias("deep")), "bounds")
    for _ in range(2):  # a class linked with any other shares enough shingles with other classes
        able = shared.groupBy("node").agg(F.count("*").alias("c"), F.first("n").alias("size")).where(F.col("c") >= _share(F.col("size")))
        shared = shared.join(able.select("node"), "node", "left_semi")
        again = shared.groupBy("token").agg(F.count("*").alias("c")).where("c > 1")
        shared = shared.join(again.select("token"), "token", "left_semi")
        shared = staged(shared.select("token", "node", "n"), "lists")
    nodes = shared.select("node").distinct()
    asked = sets.join(nodes, "node").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("r")) \
        .select(F.col("node").alias("asked"), F.col("r.doc_id").alias("want"), F.col("r.text_hash").alias("want_hash"))
    found = docs.join(asked, F.col("doc_id").eqNullSafe(F.col("want")) & (F.col("text_hash") == F.col("want_hash"))) \
        .select("text", "asked")
    texts = staged(found.mapInArrow(_node_texts, "asked bigint, node bigint, text binary").where("asked = node")
                   .select("node", "text").dropDuplicates(["node"]), "candidates")

    lengths = shared.groupBy("token").agg(F.count("*").alias("length"))
    weights = shared.join(lengths, "token").groupBy("node").agg(F.sum("length").alias("weight"))
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.25)))
    banded = staged(shared.join(weights, "node").withColumn("band", band), "weighted-lists")
    heads = banded.groupBy("token", "band").agg(F.max(F.struct("weight", "node", "n")).alias("hub")) \
        .select("token", "band", F.col("hub.node").alias("v"), F.col("hub.n").alias("m"))
    first = _counted(banded.join(heads, ["token", "band"]).where("node <> v").withColumnRenamed("node", "u"))
    links = _settle(first, texts, "first-links")
    known = components(links)

    named = staged(shared.join(known, "node", "left").join(bounds, "node")
                   .select("token", "node", "n", "most", "deep", F.coalesce("component", "node").alias("component")), "lists")
    groups = named.groupBy("token", "component").agg(F.count("*").alias("c"))
    split = groups.groupBy("token").agg(F.count("*").alias("several"), F.max_by("component", F.struct("c", "component")).alias("main")) \
        .where("several > 1").select("token", "main")
    mixed = staged(named.join(split, "token"), "mixed-lists")
    minor = mixed.where("component <> main").select("token", F.col("node").alias("u"), "n", F.col("component").alias("cu"),
                                                    F.col("most").alias("most_u"), F.col("deep").alias("deep_u"))
    rest = mixed.select("token", F.col("node").alias("v"), F.col("n").alias("m"), F.col("component").alias("cv"), "main",
                        F.col("most").alias("most_v"), F.col("deep").alias("deep_v"))
    # a partner whose prefix reaches common shingles holds none of the other's unshared rare ones
    able = "(not deep_v or 9 * most_u >= 4 * (n + m)) and (not deep_u or 9 * most_v >= 4 * (n + m))"
    crossed = minor.join(rest, "token").where(f"cu <> cv and (cv = main or u < v) and {able}")
    # one pair meets as (u, v) on some lists and as (v, u) on others: count it as one
    ahead = F.col("u") < F.col("v")
    crossed = crossed.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"),
                             F.when(ahead, F.col("n")).otherwise(F.col("m")).alias("n"), F.when(ahead, F.col("m")).otherwise(F.col("n")).alias("m"))
    return links.union(_settle(_counted(crossed), texts, "cross-links"))


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash (xxhash64 of the text),
    node (class, null without shingles), n_shingles, group (component of
    classes, null without shingles)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("text_hash"),
                       utf8(docs[f"`{text}`"]).alias("text"))
    found = staged(rows.mapInArrow(_sets, _SETS), "sets")
    sets = found.where("kind = 0").select("doc_id", "text_hash", "node", "n")
    common = found.where("kind = 1").groupBy("node").agg(F.sum("amount").alias("c")).where(F.col("c") >= COMMON_AT_ALL) \
        .orderBy(F.desc("c"), "node").limit(COMMON_SHINGLES).collect()  # a top-k by parameter: it only orders shingles
    tokens = np.array([r[0] for r in common], np.int64).view(np.uint64)
    levels = np.array([int(r[1]).bit_length() for r in common], np.int8)
    order = np.argsort(tokens)
    hot = spark.sparkContext.broadcast((tokens[order], levels[order]))
    total = sets.agg(F.sum("n"), F.max("n")).first()
    counts = {r[0]: r[1] for r in sets.where(F.col("n").between(1, MAX_LIGHT)).groupBy("n").agg(F.countDistinct("node")).collect()}
    light = boundary(counts)
    buckets = parts_for(spark, (total[0] or 0) // 4, POSTINGS)
    links = _heavy_links(rows, sets, hot, buckets, light).union(_light_links(found.where("kind = 0"), light))
    known = components(links)
    return sets.join(known, "node", "left").select("doc_id", "text_hash", "node", F.col("n").alias("n_shingles"),
                                                   F.coalesce("component", "node").alias("group"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: set size and component of every document."""
    found = staged(near_copies(table(spark, sf_dir, "documents")), "near-copies")
    least = found.groupBy("group").agg(F.min("doc_id").alias("least")).where("group is not null")
    return found.join(least, "group", "left").select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group the document with the smallest id stays
    (rows equal in id and text are one document); documents without shingles
    all stay."""
    found = staged(near_copies(docs), "near-copies")
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    stays = found.where("group is not null").groupBy("group").agg(F.min(key).alias("k")).select("k.doc_id", "k.text_hash") \
        .union(found.where("group is null").select("doc_id", "text_hash").distinct())
    rows = wrapped(docs, id=F.col("doc_id").cast("bigint"), hash=F.xxhash64(F.col("text")))
    return rows.join(stays, rows["id"].eqNullSafe(stays["doc_id"]) & (rows["hash"] == stays["text_hash"]), "left_semi").select("row.*")


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
both_ AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT u, v FROM both_ JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT u AS doc_id, v AS other FROM link UNION SELECT r.doc_id, l.v FROM reach r JOIN link l ON l.u = r.other)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       CAST(least(w.doc_id, coalesce((SELECT min(other) FROM reach WHERE reach.doc_id = w.doc_id), w.doc_id)) AS BIGINT) AS component_id
FROM w LEFT JOIN n USING (doc_id)
"""
