"""License scans by diagonal voting.

Every text's rolling hashes of ``k`` neighbouring words are joined with the
hashes of the license templates by Spark. A match of document word ``i`` with
template word ``j`` votes for the diagonal ``i - j``: an unchanged copy of a
template puts all its votes on one diagonal, inserted or deleted words move the
rest to one nearby. Votes are counted per (document, template, diagonal),
neighbouring diagonals of a template are merged into spans, and each span is
verified on the words themselves: the longest common subsequence of the template
and the span, with the words around it that the template would still cover, must
hold ``LEAST`` of the template. A label's span then runs from its first to its
last common word.

Templates shorter than ``GRAM`` words are matched as one gram of all their
words; their diagonals are single places, which are not merged and must match
word for word. So the phrases of the base rule are found by the same join.

Exchanges stay small: a bitmap of the templates' hashes (sent to the tasks; its
size is set by the templates, at most ``MAX_GRAMS`` of them) drops most grams
that can join nothing before the join, as Spark's runtime filters do, and the
join itself broadcasts the template positions. Texts are exchanged once, for the
verification. A document's spans are collected into its own row.

Defined results: null text is empty; a text without words has no span and score
0; rows equal in id and text are one document in the votes and each get the
result; null ids are ids like others; overlapping places of a phrase all count;
an empty table gives no rows; other columns of the caller are kept in ``row``.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerflow.llm.common import mix64, table, utf8, wrapped
from layerflow.llm.decontaminate import words_of
from layerflow.llm.license_templates import NOTICES, PHRASES

GRAM = 4
LEAST = 0.8
MAX_GRAMS = 200_000
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_GRAMS = "doc_id string, text_hash bigint, k int, start int, gram bigint"


class Template:
    def __init__(self, label: str, text: str, phrase: bool = False):
        self.label, self.words, self.phrase = label, words_of(text.encode()), phrase
        if not self.words:
            raise ValueError(f"the template of {label} has no word")
        self.k = len(self.words) if phrase else min(GRAM, len(self.words))
        self.whole = self.k == len(self.words)
        self.band = max(1, len(self.words) // 4)


TEMPLATES = [Template(*x, phrase=True) for x in PHRASES] + [Template(*x) for x in NOTICES]


def rolling(words: list[bytes], ks: list[int]) -> dict[int, np.ndarray]:
    """For each k the hashes of all runs of k neighbouring words."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    out, value = {}, np.zeros(len(words), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(min(max(ks), len(words))):
            value = value[:len(words) - j] * _FACTOR + hashes[j:]
            if j + 1 in ks:
                out[j + 1] = mix64(value)
    return out


def bitmap(grams: np.ndarray) -> np.ndarray:
    """One bit in about 256 is set; found by a hash's leading bits."""
    size = 1 << max(16, int(np.ceil(np.log2(len(grams) * 256 + 1))))
    out = np.zeros(size, bool)
    out[grams >> np.uint64(64 - size.bit_length() + 1)] = True
    return out


def _gramming(sent):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        shift = {k: np.uint64(64 - len(bits).bit_length() + 1) for k, bits in held.items()}
        for batch in batches:
            rows, ks, starts, grams = [], [], [], []
            for at, text in enumerate(batch.column(2)):
                for k, found in rolling(words_of(text.as_py()), list(held)).items():
                    places = np.flatnonzero(held[k][found >> shift[k]])
                    if len(places):
                        rows.append(np.full(len(places), at))
                        ks.append(np.full(len(places), k, np.int32))
                        starts.append(places.astype(np.int32))
                        grams.append(found[places].view(np.int64))
            if rows:
                taken = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(taken), batch.column(1).take(taken), pa.array(np.concatenate(ks)),
                                                  pa.array(np.concatenate(starts)), pa.array(np.concatenate(grams))],
                                                 names=["doc_id", "text_hash", "k", "start", "gram"])

    return make


def lcs(template: list[bytes], window: list[bytes]) -> tuple[int, int]:
    """Length of the longest common subsequence, and where its first-ending
    one ends in the window."""
    number: dict[bytes, int] = {}
    x = np.array([number.setdefault(w, len(number)) for w in window], np.int64)
    best = np.zeros(len(window) + 1, np.int64)
    for w in template:
        same = x == number.get(w, -1)
        best[1:] = np.maximum.accumulate(np.maximum(best[1:], best[:-1] + same))
    return int(best[-1]), int(np.searchsorted(best, best[-1]))


def verified(words: list[bytes], template: Template, first: int, start: int, stop: int, last: int) -> tuple[int, int, float]:
    """Words ``start`` to ``stop`` met words ``first`` to ``last`` of the
    template -> the span's first word, its end, the share of the template."""
    if template.whole:
        return start, stop, float(words[start:stop] == template.words)
    a = max(0, start - first - template.band)
    window = words[a:stop + len(template.words) - last + template.band]
    common, end = lcs(template.words, window)
    _, back = lcs(template.words[::-1], window[:end][::-1])
    return a + end - back, a + end, common / len(template.words)


def best_of(found: list[dict], templates: list[Template]) -> list[dict]:
    """Of spans of one template that overlap the best stays (words that a
    template holds twice vote for a second diagonal); places of whole grams all stay."""
    out = [s for s in found if templates[s["template"]].whole]
    ends: dict[int, list[tuple[int, int]]] = {}
    for s in sorted((s for s in found if not templates[s["template"]].whole), key=lambda s: (-s["score"], s["start"], s["stop"])):
        taken = ends.setdefault(s["template"], [])
        at = bisect.bisect_left(taken, (s["start"], s["stop"]))
        if (at == 0 or taken[at - 1][1] <= s["start"]) and (at == len(taken) or taken[at][0] >= s["stop"]):
            taken.insert(at, (s["start"], s["stop"]))
            out.append(s)
    return sorted(out, key=lambda s: (s["start"], s["stop"], s["template"]))


_FOUND = "struct<n_words:bigint,spans:array<struct<start:bigint,stop:bigint,template:int,label:string,phrase:boolean,score:double>>>"
_ARROW = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.struct([
    ("start", pa.int64()), ("stop", pa.int64()), ("template", pa.int32()), ("label", pa.string()), ("phrase", pa.bool_()), ("score", pa.float64())])))])


def _verifier(sent):
    @F.arrow_udf(_FOUND)
    def verify(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        templates = sent.value
        for texts, wanted in batches:
            out = []
            for text, spans in zip(texts, wanted, strict=True):
                words, found = words_of(text.as_py()), []
                for s in spans.as_py() or ():
                    t = templates[s["template"]]
                    start, stop, score = verified(words, t, s["first"], s["start"], s["stop"], s["last"])
                    if score > 0:
                        found.append({"start": start, "stop": stop, "template": s["template"], "label": t.label, "phrase": t.phrase, "score": score})
                out.append({"n_words": len(words), "spans": best_of(found, templates)})
            yield pa.array(out, _ARROW)

    return verify


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: list[Template] = TEMPLATES) -> DataFrame:
    """A struct ``row`` with the columns of ``docs``, and a struct ``found``:
    n_words, spans (start, stop in words; template, label, phrase, score), also
    those whose score is below ``LEAST``."""
    spark = docs.sparkSession
    own: dict[int, list[tuple]] = {}
    for no, t in enumerate(templates):
        for at, gram in enumerate(rolling(t.words, [t.k])[t.k].view(np.int64).tolist()):
            own.setdefault(t.k, []).append((t.k, gram, no, at, t.whole, t.band))
    grams = [g for gs in own.values() for g in gs]
    if len(grams) > MAX_GRAMS:
        raise ValueError(f"{len(grams)} template grams are more than the {MAX_GRAMS} that may be broadcast")
    sent = spark.sparkContext.broadcast({k: bitmap(np.array([g[1] for g in gs], np.int64).view(np.uint64)) for k, gs in own.items()})
    places = spark.createDataFrame(grams, "k int, gram bigint, template int, at int, whole boolean, band int")

    key, body = docs[f"`{doc_id}`"].cast("string"), docs[f"`{text}`"].cast("string")
    keyed = docs.select(key, F.xxhash64(body), utf8(body)).toDF("doc_id", "text_hash", "text")
    votes = keyed.mapInArrow(_gramming(sent), _GRAMS).join(F.broadcast(places), ["k", "gram"]) \
        .withColumn("diagonal", F.col("start") - F.col("at")) \
        .groupBy("doc_id", "text_hash", "template", "diagonal", "whole", "band", "k") \
        .agg(F.min("start").alias("start"), F.max("start").alias("stop"), F.min("at").alias("first"), F.max("at").alias("last"))
    row = Window.partitionBy("doc_id", "text_hash", "template").orderBy("diagonal")
    apart = F.col("whole") | (F.col("diagonal") - F.lag("diagonal").over(row) > F.col("band"))
    spans = votes.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("group", F.sum("new").over(row)) \
        .groupBy("doc_id", "text_hash", "template", "group") \
        .agg(F.min("start").alias("start"), (F.max("stop") + F.first("k")).alias("stop"), F.min("first").alias("first"),
             (F.max("last") + F.first("k")).alias("last")) \
        .groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("template", "start", "stop", "first", "last")).alias("spans"))  # of one text
    rows = wrapped(docs, id=key, hash=F.xxhash64(body))
    met = rows.join(spans, rows["id"].eqNullSafe(spans["doc_id"]) & (rows["hash"] == spans["text_hash"]), "left")
    return met.select("row", _verifier(spark.sparkContext.broadcast(templates))(utf8(F.col("row")[text].cast("string")), F.col("spans")).alias("found"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: places of the base phrases and labels of every document."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("found.spans")
    base = F.filter(spans, lambda s: s["phrase"])
    good = F.filter(spans, lambda s: s["score"] >= LEAST)

    def labels(of):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda s: s["label"]))), ",")

    return found.select("row.doc_id", "found.n_words", F.size(base).cast("bigint").alias("n_base"),
                        F.array_min(F.transform(base, lambda s: s["start"])).alias("first_word"),
                        F.array_max(F.transform(base, lambda s: s["start"])).alias("last_word"),
                        labels(base).alias("base_labels"), labels(good).alias("labels"),
                        F.coalesce(F.array_max(F.transform(spans, lambda s: s["score"])), F.lit(0.0)).alias("score"),
                        F.size(good).cast("bigint").alias("n_spans"))
