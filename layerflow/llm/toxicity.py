"""Toxicity scores: gradient-boosted trees over dense features.

Features of a whole text: densities of a lexicon, its hits next to a
second-person word, shares of capitals, punctuation, digits and obfuscated
words, and sizes. The lexicon is learned: words, and word beginnings of four
to six letters, whose share of toxic training texts is far above their share
overall, each with its log odds; a word counts with its largest weight.
Obfuscated spellings (signs and digits inside a word, repeated letters) are
folded to letters before the look-up and counted apart.

Small trees are boosted on the logistic loss over binned features, then the
margins are calibrated by isotonic regression (pool adjacent violators, with
straight lines between the steps) on rows that the trees did not see.

Learning uses a bounded sample: about ``PER_CLASS`` labelled rows of each
class, drawn by a hash of the id at a rate that follows from the class's count
over all rows; rows are weighted back to the true share of the classes.
Labels, lang, source and the id are never inputs of a score.

Defined results: null counts as empty text; every row gets a score; without
labelled rows, or with a single class, the score is the share of toxic rows
(0 where there is none). A document with several label rows learns from each.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.llm.common import bounded, fresh, held_out, table

PER_CLASS = 4000
THRESHOLD = 0.3
LEXICON = 4000
TREES, DEPTH, BINS, RATE = 80, 3, 32, 0.2
PREFIXES = (4, 5, 6)

#: Second-person words of the four languages.
SECOND_PERSON = frozenset((
    "you", "your", "yours", "yourself", "u", "ur", "tu", "te", "ton", "ta", "tes", "toi", "vous", "votre", "vos",
    "du", "dich", "dir", "dein", "deine", "ihr", "euch", "euer", "sie", "usted", "ustedes", "ti", "vosotros", "vuestro",
))
#: Signs and digits that stand for letters.
LEET = str.maketrans("013457@$!|+", "oieastasilt")

_TOKEN = re.compile(r"[^\s.,;:?\"()\[\]{}]+")
_PLAIN = re.compile(r"[^\W\d_]+")
_RUN = re.compile(r"(.)\1{2,}")
N_FEATURES = 16


def fold(token: str) -> str:
    """Letters that an obfuscated word stands for."""
    return "".join(c for c in _RUN.sub(r"\1", token.translate(LEET)) if c.isalpha())


class WordWeights:
    """Lexicon weight of a word; the answers for the words of a corpus are kept."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.known: dict[str, tuple[float, int]] = {}

    def of(self, token: str) -> tuple[float, int]:
        """(largest weight, whether the spelling was obfuscated)."""
        kept = self.known.get(token)
        if kept is None:
            if len(self.known) > 400_000:
                self.known = {}
            odd = 0 if _PLAIN.fullmatch(token) and not _RUN.search(token) else 1
            plain = token.strip("!'*#&%$-_")
            if _PLAIN.fullmatch(plain) and not _RUN.search(plain):
                odd, word = 0, plain
            else:
                word = fold(token)
            get = self.lexicon.get
            kept = self.known[token] = (max([get("=" + word, 0.0), *(get(word[:n], 0.0) for n in PREFIXES if len(word) >= n)]), odd)
        return kept

    def features(self, text: str) -> list[float]:
        tokens = _TOKEN.findall(text.lower())
        n, chars = max(1, len(tokens)), max(1, len(text))
        of = self.of
        found = [of(t) for t in tokens]
        weights = np.array([w for w, _ in found] or [0.0])
        odd = np.array([o for _, o in found] or [0])
        at = np.flatnonzero(weights > 0)
        strong = weights[at]
        near = 0
        if len(at):
            person = np.array([i for i, t in enumerate(tokens) if t in SECOND_PERSON])
            if len(person):
                right = np.searchsorted(person, at)
                gap = np.minimum(np.abs(person[np.minimum(right, len(person) - 1)] - at),
                                 np.abs(person[np.maximum(right - 1, 0)] - at))
                near = int((gap <= 4).sum())
        order = np.sort(strong)[::-1]
        letters = sum(map(str.isupper, text))
        return [float(order[0]) if len(order) else 0.0, float(order[1]) if len(order) > 1 else 0.0,
                float(order[2]) if len(order) > 2 else 0.0, float(strong.sum()), float(strong.sum()) / n, len(at) / n,
                float(len(at)), float((strong > 3).sum()), near / n, float(near), letters / chars,
                (text.count("!") + text.count("?")) / chars, sum(map(text.count, "*#$%&@")) / chars,
                float(odd[at].sum()), float(odd.sum()) / n, float(np.log(n))]


def learn_lexicon(texts: list[str], labels: np.ndarray) -> dict[str, float]:
    """Words ("=word") and beginnings that tell toxic texts, with log odds."""
    seen = (Counter(), Counter())
    for text, label in zip(texts, labels, strict=True):
        words = {t if _PLAIN.fullmatch(t) else fold(t) for t in _TOKEN.findall(text.lower())}
        keys = {"=" + w for w in words} | {w[:n] for w in words for n in PREFIXES if len(w) >= n}
        seen[int(label)].update(keys)
    pos, neg = max(1, int(labels.sum())), max(1, int((1 - labels).sum()))
    odds = {k: float(np.log((c + 0.5) / (pos + 1)) - np.log((seen[0][k] + 0.5) / (neg + 1)))
            for k, c in seen[1].items() if c >= 5}
    best = sorted((k for k in odds if odds[k] > 1.5), key=lambda k: (-odds[k] * np.sqrt(seen[1][k]), k))[:LEXICON]
    return {k: odds[k] for k in best}


@dataclass
class Tree:
    feature: np.ndarray  # a full binary tree, level by level
    cut: np.ndarray
    value: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        for _ in range(DEPTH):
            at = 2 * at + 1 + (x[np.arange(len(x)), self.feature[at]] > self.cut[at])
        return self.value[at - (2 ** DEPTH - 1)]


def grow(x: np.ndarray, bins: np.ndarray, edges: list[np.ndarray], grad: np.ndarray, hess: np.ndarray) -> Tree:
    feature, cut = np.zeros(2 ** DEPTH - 1, np.int64), np.full(2 ** DEPTH - 1, np.inf)
    at = np.zeros(len(x), np.int64)
    for node in range(2 ** DEPTH - 1):
        rows = np.flatnonzero(at == node)
        best = (1e-6, 0, np.inf, BINS)
        if len(rows) >= 20:
            g_all, h_all = grad[rows].sum(), hess[rows].sum()
            for f in range(x.shape[1]):
                g = np.cumsum(np.bincount(bins[rows, f], grad[rows], BINS))[:-1]
                h = np.cumsum(np.bincount(bins[rows, f], hess[rows], BINS))[:-1]
                gain = g * g / (h + 1) + (g_all - g) ** 2 / (h_all - h + 1) - g_all ** 2 / (h_all + 1)
                gain[(h < 1) | (h_all - h < 1)] = 0
                k = int(gain.argmax())
                if gain[k] > best[0] and k < len(edges[f]):
                    best = (float(gain[k]), f, edges[f][k], k)
        _, feature[node], cut[node], k = best
        at[rows] = 2 * node + 1 + (bins[rows, feature[node]] > k)
    leaf = at - (2 ** DEPTH - 1)
    value = -RATE * np.bincount(leaf, grad, 2 ** DEPTH) / (np.bincount(leaf, hess, 2 ** DEPTH) + 1)
    return Tree(feature, cut, value)


def isotonic(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: rising points (margin, probability)."""
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []
    for m, y, w in zip(margin[order], label[order], weight[order], strict=True):
        blocks.append([m * w, y * w, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    b = np.array(blocks)
    return b[:, 0] / b[:, 2], b[:, 1] / b[:, 2]


@dataclass
class Model:
    lexicon: dict[str, float]
    base: float
    trees: list[Tree]
    points: tuple[np.ndarray, np.ndarray] | None

    def margins(self, x: np.ndarray) -> np.ndarray:
        return self.base + sum((t(x) for t in self.trees), np.zeros(len(x)))

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.points is None:
            return np.full(len(x), self.base)
        return np.clip(np.interp(self.margins(x), *self.points), 0.0, 1.0)


def fit(texts: list[str], labels: np.ndarray, weights: np.ndarray) -> Model:
    """Lexicon on one part of the rows, trees on a second, calibration on a
    third: no part judges words that it has itself picked."""
    share = float((labels * weights).sum() / weights.sum()) if len(labels) else 0.0
    part = np.arange(len(labels)) % 5
    if len(labels) < 50 or min(labels.sum(), (1 - labels).sum()) < 10:
        return Model({}, share, [], None)
    first = np.flatnonzero(part < 2)
    lexicon = learn_lexicon([texts[i] for i in first], labels[first])
    made = WordWeights(lexicon)
    rest = np.flatnonzero(part >= 2)
    x = np.array([made.features(texts[i]) for i in rest])
    y, w, role = labels[rest].astype(float), weights[rest], part[rest]
    tree_rows, cal_rows = role < 4, role == 4
    edges = [np.unique(np.quantile(x[tree_rows, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    bins = np.stack([np.searchsorted(e, x[tree_rows, f], side="left") for f, e in enumerate(edges)], axis=1)
    base = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    trees, margin = [], np.full(int(tree_rows.sum()), base)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        tree = grow(x[tree_rows], bins, edges, (p - y[tree_rows]) * w[tree_rows], p * (1 - p) * w[tree_rows])
        trees.append(tree)
        margin += tree(x[tree_rows])
    model = Model(lexicon, base, trees, None)
    model.points = isotonic(model.margins(x[cal_rows]), y[cal_rows], w[cal_rows])
    return model


def sampled(docs: DataFrame, labels: DataFrame, allowed: Column, doc_id: str, text: str, label: str,
            per_class: int = PER_CLASS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Texts, labels and weights of a bounded sample of the labelled rows; rows
    equal in id, text and label are one."""
    marked = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & allowed) \
        .select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label")).distinct()
    counts = {r[0]: r[1] for r in marked.groupBy("label").count().collect()}
    if not counts:
        return [], np.zeros(0), np.zeros(0)
    rate = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, per_class / n)))])
    drawn = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20) < rate[F.col("label")]) \
        .select("label", F.xxhash64("doc_id").alias("hash"), F.col("doc_id").alias("body"))
    ids = bounded(drawn, "label", per_class).select("label", F.col("body").alias("doc_id"))
    # two classes of at most per_class ids: a proven bound for the broadcast, whatever the rows of an id
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("body")) \
        .join(F.broadcast(ids), "doc_id").select("label", F.xxhash64("doc_id", "body").alias("hash"), "body")
    out = [(bytes(r["body"]).decode(), r["label"])
           for r in sorted(bounded(rows, "label", per_class).collect(), key=lambda r: (r["hash"], r["label"], r["body"]))]
    kept = Counter(y for _, y in out)
    return [t for t, _ in out], np.array([y for _, y in out]), np.array([counts[y] / kept[y] for _, y in out], float) / \
        (sum(counts.values()) / max(1, len(out)))


def _scorer(sent):
    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = sent.value
        made = WordWeights(model.lexicon)
        for batch in batches:
            x = np.array([made.features(t.as_py()) for t in batch]).reshape(-1, N_FEATURES)
            yield pa.array(model.scores(x), pa.float64())

    return score


def toxicity(docs: DataFrame, labels: DataFrame, train_on: Column, into: str = "toxicity", doc_id: str = "doc_id",
             text: str = "text", label: str = "toxic", per_class: int = PER_CLASS) -> DataFrame:
    """``docs`` with a column ``into`` of calibrated scores; learns from the
    rows of ``labels`` that ``train_on`` allows."""
    model = fit(*sampled(docs, labels, train_on, doc_id, text, label, per_class))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.withColumn(into, _scorer(sent)(F.coalesce(docs[f"`{text}`"].cast("string"), F.lit(""))))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: a score for every whole text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = held_out(F.col("doc_id"))
    scored = toxicity(docs, table(spark, sf_dir, "labels"), ~out, fresh(docs, "score"))
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
