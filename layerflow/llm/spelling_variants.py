"""Spelling variants: words one edit apart, grouped under their commonest form.

Dense prefix-suffix tiling. Two different words of at most ``k`` code points
(the longer has ``k``) are one inserted, deleted or replaced code point apart
exactly if their common prefix and common suffix together reach ``k - 1``. Words
are held as padded matrices of code points, once aligned left and once right;
tiles of rows are compared with each other at once, which gives the two lengths
of every pair of a tile.

What meets in one matrix is chosen so that no pair is missed and no group grows
without end. Of the ``k - 1`` code points that must agree, at least half lie in
the prefix or in the suffix: so the words of lengths ``k`` and ``k - 1`` meet by
their first half and, for the pairs left over, by their last half. A group of
more than ``GROUP`` words (or ``CELLS`` code points) is parted again by the same
argument, half of what may still differ at a time, on Spark; in the end only one
code point may differ, which holds a group to the size of the alphabet. Each
pair is met in one group only: a prefix group takes the pairs whose common
prefix is at least its own, the suffix group beside it the others.

A word's *form* is its near word of largest count (ties: the first in code-point
order) if that is at least ``RATIO`` times the word's own count; its *root* is
where following forms ends (counts grow by ``RATIO`` each step, so there are no
rings); roots are found by doubling the steps with joins.

Counts are gathered per task before the exchange, so a word that a third of all
rows hold is one row per task. Nothing of the vocabulary reaches the driver.

Defined results: null text has no words; a null id is the empty string where it
is hashed; repeated rows count each; an empty table gives no words; words of any
length take part; columns beside id and text are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.llm.common import staged, table

MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
EVERY = 199
GROUP = 256
CELLS = 1 << 20
_TILE = 1 << 21
_HELD = 500_000

_LETTERS = "a-zÀ-ÿ"
_WORD = "word string, n bigint"


def without(run: str, at: int) -> str:
    """The run less one code point."""
    return run[:at] + run[at + 1:]


def _counter(min_length: int, every: int):
    """UTF-8 texts -> partial counts; ``bytes.lower`` touches A-Z alone."""
    runs = re.compile(f"[{_LETTERS}]{{{min_length},}}")

    def batch_of(held: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = defaultdict(int)
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                if not text.is_valid:
                    continue
                seed = zlib.crc32(((doc_id.as_py() or "") + ":").encode())
                for run, n in Counter(runs.findall(text.as_py().lower().decode())).items():
                    h = zlib.crc32(run.encode(), seed)
                    word = run if h % every else without(run, h % len(run))
                    if len(word) >= min_length:
                        held[word] += n
                if len(held) > _HELD:
                    yield batch_of(held)
                    held = defaultdict(int)
        if held:
            yield batch_of(held)

    return count


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
               min_count: int = MIN_COUNT, every: int = EVERY) -> DataFrame:
    """The words of all texts with their counts ``n``."""
    return docs.select(F.col(f"`{doc_id}`").cast("string"), F.col(f"`{text}`").cast("string").cast("binary")) \
        .mapInArrow(_counter(min_length, every), _WORD).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


_KEY = ("k", "a", "b", "hi", "head", "tail")


def _parted(words: DataFrame) -> DataFrame:
    """Each row (word, n, k, a, b, hi) -> its prefix and its suffix group."""
    half = F.expr("cast((k - a - b) div 2 as int)")  # half of the k - 1 - a - b code points to agree, rounded up
    prefix = F.struct((F.col("a") + half).alias("a"), F.col("b").alias("b"), F.col("hi").alias("hi"))
    suffix = F.struct(F.col("a").alias("a"), (F.col("b") + half).alias("b"), (F.col("a") + half).alias("hi"))
    return words.select("word", "n", "k", F.explode(F.array(prefix, suffix)).alias("g")).select("word", "n", "k", "g.*") \
        .select("*", F.expr("substring(word, 1, a)").alias("head"), F.expr("if(b = 0, '', right(word, b))").alias("tail"))


def _matrix(words: list[str], k: int, right: bool) -> np.ndarray:
    """Code points of words of ``k`` or ``k - 1``, padded with 0."""
    return np.array([w.rjust(k, "\0") if right else w.ljust(k, "\0") for w in words], f"<U{k}").view("<u4").reshape(len(words), k)


def _common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Length of the common beginning of each row of x with each row of y."""
    apart = x[:, None, :] != y[None, :, :]
    return np.where(apart.any(axis=2), apart.argmax(axis=2), x.shape[1])


def near_pairs(words: list[str], k: int, a: int, b: int, hi: int) -> list[tuple[int, int]]:
    """Index pairs one edit apart whose longer word has ``k`` code points; all
    words share their first ``a`` and last ``b`` code points, and only pairs
    with a common prefix below ``hi`` count."""
    long = [i for i, w in enumerate(words) if len(w) == k]
    short = [i for i, w in enumerate(words) if len(w) == k - 1]
    order = long + short
    if not long or len(order) < 2:
        return []
    held = [words[i] for i in order]
    left = np.ascontiguousarray(_matrix(held, k, False)[:, a:])
    turned = np.ascontiguousarray(_matrix(held, k, True)[:, ::-1][:, b:])
    side = int(np.clip((_TILE // max(1, left.shape[1])) ** 0.5, 1, 256))
    out = []
    for i in range(0, len(long), side):
        for j in range(i, len(order), side):
            rows, cols = slice(i, min(i + side, len(long))), slice(j, j + side)
            prefix = _common(left[rows], left[cols]) + a
            suffix = _common(turned[rows], turned[cols]) + b
            x, y = np.nonzero((prefix + suffix >= k - 1) & (prefix < hi))
            out += [(order[i + p], order[j + q]) for p, q in zip(x.tolist(), y.tolist(), strict=True) if i + p < j + q]
    return out


def _tiler(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group -> the near pairs of each group, both ways."""
    names = ["word", "near", "near_n"]

    def found(key: tuple, words: list[str], counts: list[int]) -> pa.RecordBatch:
        pairs = near_pairs(words, *key[:4])
        both = pairs + [(j, i) for i, j in pairs]
        return pa.RecordBatch.from_arrays([pa.array([words[i] for i, _ in both], pa.string()), pa.array([words[j] for _, j in both], pa.string()),
                                           pa.array([counts[j] for _, j in both], pa.int64())], names=names)

    key, words, counts = None, [], []
    for batch in batches:
        for word, n, *own in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if tuple(own) != key:
                if len(words) > 1:
                    yield found(key, words, counts)
                key, words, counts = tuple(own), [], []
            words.append(word)
            counts.append(n)
    if len(words) > 1:
        yield found(key, words, counts)


def _grouped(words: DataFrame, group: int) -> DataFrame:
    """The rows of ``words`` in groups small enough for one matrix each."""
    whole = F.lit(2 ** 31 - 1)
    length = F.length("word")
    opened = _parted(words.select("word", "n", F.explode(F.array(length, length + 1)).alias("k"), F.lit(0).alias("a"), F.lit(0).alias("b"),
                                  whole.alias("hi")))
    small = []
    while True:
        opened = staged(opened, "variant-groups")
        sizes = opened.groupBy(*_KEY).agg(F.count("*").alias("c"), F.max(F.length("word") == F.col("k")).alias("longest")) \
            .where("c > 1 and longest")  # a word alone, or only shorter ones, hold no pair of this k
        large = ((F.col("c") > group) | (F.col("c") * F.col("k") > CELLS)) & (F.col("a") + F.col("b") < F.col("k") - 1)
        sizes = staged(sizes.select(*_KEY, large.alias("large")), "variant-sizes")
        small.append(opened.join(sizes.where("not large"), list(_KEY), "left_semi"))
        if sizes.where("large").isEmpty():
            break
        opened = _parted(opened.join(sizes.where("large"), list(_KEY), "left_semi").drop("head", "tail"))
    out = small[0]
    for more in small[1:]:
        out = out.unionByName(more)
    return out


def _rooted(forms: DataFrame) -> DataFrame:
    """(word, form) -> (word, root), by joins that double the steps taken."""
    roots = staged(forms.where("form is not null").select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = staged(roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                       "variant-roots")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        roots = moved.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO, group: int = GROUP) -> DataFrame:
    """Words with counts -> word, form, root, n, n_near, form_n."""
    words = staged(words.select("word", "n"), "vocabulary")
    pairs = _grouped(words, group).select("word", "n", *_KEY).repartition(*[F.col(c) for c in _KEY]).sortWithinPartitions(*_KEY, "word") \
        .mapInArrow(_tiler, "word string, near string, near_n bigint")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("near")))
    near = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    counts: Column = F.coalesce("n_near", F.lit(0)).alias("n_near")
    strong = -F.col("best.n") >= F.lit(ratio) * F.col("n")
    forms = staged(words.join(near, "word", "left").select("word", "n", counts, F.when(strong, F.col("best.near")).alias("form"),
                                                           F.when(strong, -F.col("best.n")).alias("form_n")), "variant-forms")
    return forms.join(_rooted(forms), "word", "left") \
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every counted word of ``documents`` with its form and root."""
    return variants(vocabulary(table(spark, sf_dir, "documents").select("doc_id", "text")))


#: CRC-32 byte by byte over its table, then equal strings after one deletion.
ORACLE = r"""
WITH RECURSIVE
steps AS (SELECT i, 0 AS s, i AS v FROM range(256) t(i)
          UNION ALL
          SELECT i, s + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM steps WHERE s < 8),
tab AS (SELECT list(v ORDER BY i) AS tbl FROM steps WHERE s = 8),
runs AS (
  SELECT doc_id, run, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[a-z\x{00C0}-\x{00FF}]+')) AS run FROM documents WHERE text IS NOT NULL)
  WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (
  SELECT run, c, xor(list_reduce(list_concat([4294967295::BIGINT], bytes), lambda crc, b: xor(crc >> 8, tbl[(xor(crc, b) & 255) + 1])), 4294967295) AS h
  FROM (SELECT run, c, list_transform(range(1, length(hx), 2), lambda p: (16 * (position(hx[p] IN '0123456789ABCDEF') - 1)
                                      + position(hx[p + 1] IN '0123456789ABCDEF') - 1)::BIGINT) AS bytes
        FROM (SELECT run, c, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS hx FROM runs)), tab),
words AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n
  FROM (SELECT c, CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
                       ELSE run END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY 1 HAVING sum(c) >= 5),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM words, LATERAL (SELECT unnest(range(1, length(word) + 1)) AS i)),
near AS (
  SELECT x.word, y.word AS near, y.n AS near_n FROM cut x JOIN cut y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM cut x JOIN words y ON x.rest = y.word
  UNION SELECT y.word, x.word, x.n FROM cut x JOIN words y ON x.rest = y.word),
best AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, encode(near)) AS near, max(near_n) AS near_n FROM near GROUP BY 1),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * w.n THEN near END AS form, CASE WHEN near_n >= 5 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS last, 0 AS d FROM forms
          UNION ALL SELECT chain.word, forms.form, d + 1 FROM chain JOIN forms ON forms.word = chain.last WHERE forms.form IS NOT NULL)
SELECT f.word, f.form, r.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM forms f JOIN (SELECT word, max_by(chain.last, d) AS root FROM chain GROUP BY 1) r USING (word)
"""
