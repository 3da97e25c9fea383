"""Language identification with a byte convolutional network in numpy.

Filters of several widths run over the bytes of a window, each filter keeps
its largest response (max pooling), and a softmax layer turns the pooled
responses into probabilities of the learned languages. A text is cut into
windows of ``LENGTH`` bytes that overlap by the widest filter less one, so
every byte n-gram of the whole text is seen once; the probabilities of its
windows are averaged by their number of bytes.

The network is trained on a bounded sample of labelled rows: about
``PER_LANG`` documents of each language, drawn by a hash of the id at a rate
that follows from the language's count over all rows. ``lang``, ``source``
and the id are never inputs of a prediction.

Defined results: null text or text without a letter is ``und`` with score 0;
so is every text if no row is labelled; with one language its score is 1.
Repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.llm.common import bounded, fresh, held_out, release, table

LENGTH = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
PER_LANG = 1500
WINDOWS_PER_DOC = 3
EPOCHS = 5
MIN_SCORE = 0.3
UNKNOWN = "und"


def has_letter(text: str) -> bool:
    """Whether a character is a letter (superscripts, fractions, circled or
    Roman numerals are none)."""
    return any(map(str.isalpha, text))


@dataclass
class ByteNet:
    langs: list[str]
    filters: list[np.ndarray]  # for each width: [width, 256, FILTERS]
    weights: np.ndarray
    bias: np.ndarray

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Largest response of each filter in each window, and where it is."""
        best, where = [], []
        for table_ in self.filters:
            width = len(table_)
            span = windows.shape[1] - width + 1
            response = table_[0][windows[:, :span]]
            for k in range(1, width):
                response += table_[k][windows[:, k:k + span]]
            best.append(response.max(axis=1))
            where.append(response)
        return np.concatenate(best, axis=1), where

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        return softmax(self.pooled(windows)[0] @ self.weights + self.bias)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def windows_of(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Fixed-length windows over the whole text (the last padded with zero
    bytes) and the number of bytes each one adds."""
    step = LENGTH - max(WIDTHS) + 1
    count = max(1, -(-(len(text) - max(WIDTHS) + 1) // step))
    padded = np.zeros(step * (count - 1) + LENGTH, np.uint8)
    padded[:len(text)] = np.frombuffer(text, np.uint8)
    view = np.lib.stride_tricks.sliding_window_view(padded, LENGTH)[::step]
    added = np.full(count, step)
    added[-1] = max(1, len(text) - step * (count - 1))
    return view, added


def train(samples: list[tuple[str, bytes]], seed: int = 7) -> ByteNet:
    """Fit on (language, text) pairs by stochastic gradient descent."""
    rng = np.random.default_rng(seed)
    langs = sorted({lang for lang, _ in samples})
    cut, labels = [], []
    for lang, text in samples:
        view, _ = windows_of(text)
        for i in rng.choice(len(view), min(WINDOWS_PER_DOC, len(view)), replace=False):
            w = view[i].copy()
            if rng.random() < 0.3:  # short texts must be told apart too
                w[rng.integers(6, 64):] = 0
            cut.append(w)
            labels.append(langs.index(lang))
    x, y = np.array(cut), np.array(labels)
    net = ByteNet(langs, [rng.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS],
                  rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(langs))).astype(np.float32),
                  np.zeros(len(langs), np.float32))
    for f in net.filters:
        f[:, 0] = 0  # padding responds to nothing
    sums = [np.full(f.shape, 1e-6, np.float32) for f in net.filters]
    w_sum, b_sum = np.full(net.weights.shape, 1e-6, np.float32), np.full(net.bias.shape, 1e-6, np.float32)
    share = np.bincount(y, minlength=len(langs))
    balance = (len(y) / (len(langs) * np.maximum(share, 1))).astype(np.float32)
    lanes = np.arange(FILTERS)
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 64):
            batch = order[at:at + 64]
            windows, target = x[batch], y[batch]
            best, responses = net.pooled(windows)
            error = softmax(best @ net.weights + net.bias)
            error[np.arange(len(batch)), target] -= 1
            error *= (balance[target] / len(batch))[:, None]
            back = error @ net.weights.T
            g = best.T @ error
            w_sum += g * g
            net.weights -= 0.1 * g / np.sqrt(w_sum)
            gb = error.sum(axis=0)
            b_sum += gb * gb
            net.bias -= 0.1 * gb / np.sqrt(b_sum)
            for n, f in enumerate(net.filters):
                place = responses[n].argmax(axis=1)
                part = back[:, n * FILTERS:(n + 1) * FILTERS]
                grad = np.zeros_like(f)
                for k in range(len(f)):
                    np.add.at(grad[k], (windows[np.arange(len(batch))[:, None], place + k], lanes[None, :]), part)
                grad[:, 0] = 0
                sums[n] += grad * grad
                f -= 0.1 * grad / np.sqrt(sums[n])
    return net


def sampled(docs: DataFrame, allowed: Column, doc_id: str, text: str, lang: str, per_lang: int = PER_LANG) -> list[tuple[str, bytes]]:
    """About ``per_lang`` (never more) labelled texts of each language, drawn by
    id and text; rows equal in both are one, and the bound holds before any text
    reaches the driver."""
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & allowed)
    counts = {r[0]: r[1] for r in labelled.groupBy(F.col(lang).alias("lang")).count().collect()}
    if not counts:
        return []
    rate = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, per_lang / n)))])
    hashed = F.xxhash64(F.col(doc_id), F.col(text))
    draw = F.pmod(hashed, F.lit(1 << 20)) / float(1 << 20)
    drawn = labelled.where(draw < rate[F.col(lang)]).select(F.col(lang).alias("lang"), hashed.alias("hash"), F.col(text).cast("binary").alias("body"))
    rows = bounded(drawn, "lang", per_lang).collect()
    return [(r["lang"], bytes(r["body"]).lower()) for r in sorted(rows, key=lambda r: (r["lang"], r["hash"], r["body"]))
            if has_letter(bytes(r["body"]).decode())]


def _predictor(sent):
    @F.arrow_udf("struct<lang:string,score:double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        net = sent.value
        for batch in batches:
            yield pa.array([{"lang": a, "score": b} for a, b in predictions(net, (x.as_py() for x in batch))],
                           pa.struct([("lang", pa.string()), ("score", pa.float64())]))
        release()

    return predict


def predictions(net: ByteNet | None, texts) -> list[tuple[str, float]]:
    out: list[tuple[str, float]] = []
    for text in texts:
        if net is None or text is None or not has_letter(text):
            out.append((UNKNOWN, 0.0))
            continue
        view, added = windows_of(text.encode().lower())
        total = np.zeros(len(net.langs))
        for at in range(0, len(view), 64):
            total += (net.probabilities(view[at:at + 64]) * added[at:at + 64, None]).sum(axis=0)
        total /= added.sum()
        best = int(total.argmax())
        out.append((net.langs[best], min(1.0, float(total[best]))))
    return out


def identify(docs: DataFrame, train_on: Column, into: str = "language", doc_id: str = "doc_id", text: str = "text",
             lang: str = "lang", per_lang: int = PER_LANG) -> DataFrame:
    """``docs`` with a struct column ``into`` (lang, score); the network
    learns from the rows of ``docs`` that ``train_on`` allows."""
    samples = sampled(docs, train_on, doc_id, text, lang, per_lang)
    sent = docs.sparkSession.sparkContext.broadcast(train(samples) if samples else None)
    return docs.withColumn(into, _predictor(sent)(docs[f"`{text}`"].cast("string")))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the language of every whole text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = held_out(F.col("doc_id"))
    return identify(docs, ~out).select("doc_id", out.alias("held_out"), F.col("language.lang").alias("lang_pred"),
                                       F.col("language.score").alias("score"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without a recognised language go."""
    into = fresh(docs, "language")
    found = identify(docs, ~held_out(F.col("doc_id")), into)
    keep = (F.col(f"`{into}`")["lang"] != UNKNOWN) & (F.col(f"`{into}`")["score"] >= MIN_SCORE)
    return found.where(keep).select(*[f"`{c}`" for c in docs.columns])
