"""Benchmark decontamination with one Aho-Corasick automaton.

The windows of all benchmark items (ten consecutive normalised words, or the
whole item where it has fewer) become the patterns of one automaton over
``" w1 w2 ... wn "``. Each text is normalised to the same form and scanned
once; an end offset in the normalised text is mapped to word numbers by the
spaces before it, and word numbers to character offsets of the original text.

Normalisation: A-Z become lower case; a word is a maximal run of characters
outside ``\\x00-\\x2F \\x3A-\\x60 \\x7B-\\x7F``, so all non-ASCII characters are
word characters and the work can be done on UTF-8 bytes.

The patterns reach the executors as a broadcast of at most ``slice_bytes`` of
item text. A larger benchmark is scanned in several slices of that size whose
results are united per document, so the broadcast never outgrows the bound.

Defined results: null or empty text has no words and is never contaminated;
a null or wordless item has no window; a null item id is the empty string;
items with the same id count once; repeated document rows each get their own
result; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.llm.common import fresh, table, utf8

WINDOW = 10
SLICE_BYTES = 64 << 20

#: Every byte that is no word byte becomes a space; A-Z become a-z.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(rb"[^ ]+")
_RESULT = "struct<n_words:bigint,n_hit:bigint,items:array<string>,spans:array<struct<start:bigint,stop:bigint>>>"
_ARROW = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
                    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))])


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def windows_of(items: list[tuple[str, str]], window: int) -> dict[str, tuple[int, list[int]]]:
    """Pattern -> (its number of words, positions in ``items`` that have it)."""
    out: dict[str, tuple[int, list[int]]] = {}
    for at, (_, text) in enumerate(items):
        words = words_of((text or "").encode())
        for i in range(max(1, len(words) - window + 1) if words else 0):
            part = words[i:i + window]
            owners = out.setdefault(" " + b" ".join(part).decode("latin-1") + " ", (len(part), []))[1]
            if not owners or owners[-1] != at:
                owners.append(at)
    return out


_built: dict[str, object] = {}


def _automaton(key: str, patterns: dict[str, tuple[int, list[int]]]):
    """The automaton of these patterns, built once per worker process."""
    import ahocorasick

    if key not in _built:
        made = ahocorasick.Automaton()
        for pattern, value in patterns.items():
            made.add_word(pattern, value)
        made.make_automaton()
        _built.clear()
        _built[key] = made
    return _built[key]


def scan(text: bytes, automaton, ids: list[str]) -> tuple[int, int, list[str], list[dict[str, int]]]:
    words = words_of(text)
    if not words:
        return 0, 0, [], []
    plain = " " + b" ".join(words).decode("latin-1") + " "
    found = list(automaton.iter(plain))
    if not found:
        return len(words), 0, [], []
    spaces = np.flatnonzero(np.frombuffer(plain.encode("latin-1"), np.uint8) == 32)
    last = np.searchsorted(spaces, [end for end, _ in found]) - 1
    length = np.array([value[0] for _, value in found])
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, last - length + 1, 1)
    np.add.at(edge, last + 1, -1)
    hit = np.cumsum(edge[:-1]) > 0
    runs = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    places = [m.span() for m in _WORD.finditer(text.translate(_FOLD))]
    spans, chars, done = [], 0, 0
    for a, b in zip(runs[::2], runs[1::2], strict=True):
        lo, hi = places[a][0], places[b - 1][1]
        chars += len(text[done:lo].decode())
        start, done = chars, hi
        chars += len(text[lo:hi].decode())
        spans.append({"start": start, "stop": chars})
    owners = sorted({ids[i] for _, value in found for i in value[1]})
    return len(words), int(hit.sum()), owners, spans


def _slices(benchmark: DataFrame, item_id: str, item_text: str, slice_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """The items in slices whose texts hold at most ``slice_bytes`` (a larger
    single item is a slice of its own)."""
    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")), F.col(item_text)) \
        .where(F.col(item_text).isNotNull())
    held, size = [], 0
    for i, t in rows.toLocalIterator():
        if held and size + len(t) > slice_bytes:
            yield held
            held, size = [], 0
        held.append((i, t))
        size += len(t)
    yield held


def _finder(sent):
    @F.arrow_udf(_RESULT)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        key, patterns, ids = sent.value
        made = _automaton(key, patterns) if patterns else None
        for batch in batches:
            rows = (scan(t, made, ids) if made else (len(words_of(t)), 0, [], []) for t in (x.as_py() for x in batch))
            yield pa.array([dict(zip(("n_words", "n_hit", "items", "spans"), r, strict=True)) for r in rows], _ARROW)

    return find


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, slice_bytes: int = SLICE_BYTES,
                  into: str = "contamination") -> DataFrame:
    """``docs`` with a struct column ``into``: n_words, n_hit, items (sorted
    ids with an occurring window), spans (character offsets of hit runs)."""
    spark = docs.sparkSession
    names = [into]
    out = docs
    for n, items in enumerate(_slices(benchmark, item_id, item_text, slice_bytes)):
        patterns = windows_of(items, window)
        ids = [i for i, _ in items]
        key = hashlib.sha256(repr((window, items)).encode()).hexdigest()
        sent = spark.sparkContext.broadcast((key, patterns, ids))

        if n:
            names.append(fresh(out, f"{into}_{n}"))
        out = out.withColumn(names[-1], _finder(sent)(utf8(out[f"`{text}`"])))
    if len(names) == 1:
        return out
    return _united(out, names, text).drop(*names[1:])


def _united(out: DataFrame, names: list[str], text: str) -> DataFrame:
    """One struct from those of several slices."""
    spans = F.array_sort(F.flatten(F.array(*[F.col(f"{n}.spans") for n in names])))

    @F.arrow_udf(_RESULT)
    def unite(texts: pa.Array, n_words: pa.Array, items: pa.Array, spans: pa.Array) -> pa.Array:
        rows = []
        for t, n, i, s in zip(texts.to_pylist(), n_words.to_pylist(), items.to_pylist(), spans.to_pylist(), strict=True):
            merged: list[dict[str, int]] = []
            hit = 0
            if s:
                lower = t.decode()
                ends = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)]
                for x in s:
                    if merged and x["start"] <= merged[-1]["stop"]:
                        merged[-1]["stop"] = max(merged[-1]["stop"], x["stop"])
                    else:
                        merged.append(dict(x))
                starts = np.array([a for a, _ in ends])
                hit = sum(int(np.searchsorted(starts, x["stop"]) - np.searchsorted(starts, x["start"])) for x in merged)
            rows.append({"n_words": n, "n_hit": hit, "items": i, "spans": merged})
        return pa.array(rows, _ARROW)

    items = F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(f"{n}.items") for n in names]))))
    return out.withColumn(names[0], unite(utf8(out[f"`{text}`"]), F.col(f"{names[0]}.n_words"), items, spans))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: hits of all benchmark windows in every whole document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    c = F.col("contamination")
    return found.select("doc_id", c["n_words"].alias("n_words"), c["n_hit"].alias("n_hit"),
                        F.size(c["items"]).cast("bigint").alias("n_items"),
                        F.sha2(F.array_join(c["items"], ","), 256).alias("items_sha256"),
                        (c["n_hit"] > 0).alias("contaminated"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: contaminated documents go."""
    found = contamination(docs, table(spark, sf_dir, "benchmark"), into=fresh(docs, "contamination"))
    mark = found.columns[-1]
    return found.where(F.col(f"`{mark}`")["n_hit"] == 0).select(*[f"`{c}`" for c in docs.columns])


ORACLE = r"""
WITH it AS (
  SELECT item_id, w, least(len(w), 10) AS n
  FROM (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL)
  WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
        FROM (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM it)),
doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM win),
pos AS (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM doc, sizes WHERE len(w) >= n),
hits AS (SELECT p.doc_id, p.i, p.n, win.item_id
         FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM pos) p
         JOIN win ON win.n = p.n AND win.s = p.s),
hw AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY 1),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY 1)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""
