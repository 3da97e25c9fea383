"""SentencePiece (merge type) encoding with seeded merge dropout, and decoding.

The text becomes one symbol per character and the agenda (a heap by piece
score, then position) joins neighbours whose union is a piece. Each candidate
popped from the agenda is skipped with probability ``dropout``, told by a keyed
hash of (seed, document key, place of the word, number of the candidate), so
the same seed always gives the same segmentation and another seed another one.
Without dropout the result is that of the sentencepiece library.

No piece crosses the start of a run of spaces, a line feed or (looked up in
the model) the end of a word before a point or comma, so texts are encoded word
by word. Every occurrence of a word draws its own dropout; a word may take any
of the segmentations that dropout can give. A segmentation depends on the word
and the candidates skipped alone, so the commonest of each word, that without
skips, is kept per worker, of at most ``KNOWN`` words, the oldest (in a corpus:
the commonest) longest. All others are merged ``TOGETHER`` at a time, a step of
all of them by a few array operations.
``variants`` above 0 lets a word take at most so many segmentations.

Decoding is exact for every text: a character without a piece is written as
its UTF-8 bytes in byte pieces, and so is a literal U+2581, which would
otherwise come back as a space.

Defined results: null text has null ids; empty text has no ids and decodes to
the empty text; rows with equal key and text have equal ids.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.llm.common import fresh, mix64, release, table

SEED = 17
DROPOUT = 0.1
VARIANTS = 0
KNOWN = 300_000
TOGETHER, FEW = 16_384, 64   # words merged at a time; fewer than FEW are merged one by one
_WIDEST = 32                 # longer words are merged one by one
SPACE = "▁"
_WORDS = re.compile(r"\n| *[^ \n]+| +")
#: The same, with a cut before a point or comma that follows a Latin letter or a digit.
_SHORTER = re.compile(r"\n| *[^ \n.,]*[A-Za-z0-9\u00C0-\u024F](?=[.,])|[.,][^ \n]*| *[^ \n]+| +")
_ACROSS = re.compile(r"[A-Za-z0-9\u00C0-\u024F][.,]")
_MASK = (1 << 64) - 1
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bits of the probability of a skip, and the candidates that one draw decides.
_PRECISION = 16
_DRAWN = 64
_ROUNDS = (np.arange(1, _PRECISION + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))[:, None]
_NEXT = np.uint64(0xA0761D6478BD642F)


class _Symbols(dict):
    """Ids of pieces, -1 for a character without one."""

    def __missing__(self, piece: str) -> int:
        return -1


_PAD, _GONE, _NONE = 0xFFFF, -1, np.int32(0x7FFFFFFF)


class _Together:
    """Merges many words of up to ``_WIDEST`` characters at once, each as
    :meth:`Segmenter._merged` does. The agenda's
    next entry of a word is the leftmost of the smallest ranks of its pairs, and
    its rank tells the piece made; a word that meets a rank of several pieces has
    to be merged by itself, as one with a character that is no piece."""

    def __init__(self, ids: dict[str, int], pairs: dict[int, int], rank: np.ndarray):
        joined = list(set(pairs.values()))
        self.piece = np.zeros(len(rank), np.int64)
        self.piece[rank[joined]] = joined
        self.piece[np.bincount(rank[joined], minlength=len(rank)) > 1] = _GONE   # a rank of several
        self.symbol = np.full(0x110000, _GONE, np.int32)   # by code point
        for piece, i in ids.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i
        self.symbol[ord(" ")], self.symbol[0] = self.symbol[ord(SPACE)], _PAD
        # the rank of the piece that a pair becomes, by open addressing
        bits = (4 * len(pairs)).bit_length()
        self.mask, self.shift = (1 << bits) - 1, np.uint64(64 - bits)
        self.keys, self.made = np.full(1 << bits, -1, np.int64), np.full(1 << bits, _NONE, np.int32)
        keys, made = np.fromiter(pairs, np.int64, len(pairs)), rank[np.fromiter(pairs.values(), np.int64, len(pairs))]
        at = self._slot(keys)
        while len(keys):
            slots, first = np.unique(at, return_index=True)
            first = first[self.keys[slots] < 0]
            self.keys[at[first]], self.made[at[first]] = keys[first], made[first]
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, made, at = keys[rest], made[rest], at[rest] + 1 & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * _STEP >> self.shift).view(np.int64)

    def _join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of what the pairs become, ``_NONE`` where it is no piece."""
        key = a << 16 | b
        at = self._slot(key)
        found = self.keys[at]
        out = np.where(found == key, self.made[at], _NONE)
        left = np.flatnonzero((found >= 0) & (found != key))
        key, at = key[left], at[left]
        while len(left):
            at = at + 1 & self.mask
            found = self.keys[at]
            hit = found == key
            out[left[hit]] = self.made[at[hit]]
            on = (found >= 0) & ~hit
            left, key, at = left[on], key[on], at[on]
        return out

    def merged(self, words: list[str], draws: np.ndarray, width: int, below: int, dtype: np.dtype) -> tuple[list[bytes], np.ndarray]:
        """Ids of each word and the candidates met; more than ``_DRAWN`` for a
        word that has to be merged by itself."""
        text = "".join([w.ljust(width, "\0") for w in words]).encode("utf-32-le")
        symbols = self.symbol[np.frombuffer(text, "<u4")].astype(np.int64)
        n = len(words)
        grid = symbols.reshape(n, width)
        alone = (grid == _GONE).any(1)
        here = np.full((n, width), _NONE, np.int32)
        here[:, :-1] = self._join(grid[:, :-1].ravel(), grid[:, 1:].ravel()).reshape(n, width - 1)
        flat = here.ravel()
        after = np.tile(np.arange(1, width + 1), n)
        before = after - 2
        met = np.zeros(n, np.uint64)
        rows = np.flatnonzero(~alone)
        while len(rows):
            agenda = here[rows]
            i = agenda.argmin(1)
            best = agenda[np.arange(len(rows)), i]
            on = best != _NONE
            rows, i, best = rows[on], i[on], best[on]
            made = self.piece[best]
            late = made < 0
            if below:
                late |= met[rows] >= _DRAWN
            if late.any():
                alone[rows[late]] = True
                rows, i, made = rows[~late], i[~late], made[~late]
            base = rows * width
            at = base + i
            if below:
                skip = (draws[rows] >> met[rows] & np.uint64(1)).astype(bool)
                met[rows] += np.uint64(1)
                flat[at[skip]] = _NONE
                take = ~skip
                i, made, base, at = i[take], made[take], base[take], at[take]
            second = base + after[at]
            symbols[at], symbols[second] = made, _GONE
            flat[at] = flat[second] = _NONE
            after[at] = k = after[second]
            right, p = k < width, before[at]
            left = p >= 0
            here_right, next_right, here_left = at[right], base[right] + k[right], base[left] + p[left]
            before[next_right] = i[right]
            then = self._join(np.concatenate([made[right], symbols[here_left]]), np.concatenate([symbols[next_right], made[left]]))
            flat[here_right], flat[here_left] = then[:len(here_right)], then[len(here_right):]
        held = (grid != _GONE) & (grid != _PAD)
        ids = grid[held].astype(dtype).tobytes()
        ends = (np.cumsum(held.sum(1)) * dtype.itemsize).tolist()
        met[alone] = _DRAWN + 1
        return [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)], met.astype(np.int64)


class Segmenter:
    """Encoder and decoder of one model, seed and dropout."""

    def __init__(self, model: str, seed: int = SEED, dropout: float = DROPOUT, variants: int = VARIANTS):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.seed, self.variants = seed, variants
        self.below = min(round(dropout * (1 << _PRECISION)), 1 << _PRECISION)
        if dropout > 0 and not self.below:
            raise ValueError(f"dropout below {0.5 / (1 << _PRECISION)} is not told from none")
        self.ids, self.bytes_id = {}, {}
        self.shown: list[bytes] = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes_id[int(piece[1:-1], 16)] = i
                self.shown.append(bytes([int(piece[1:-1], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i):
                self.shown.append(b"")
            else:
                self.ids[piece] = i
                self.shown.append(piece.replace(SPACE, " ").encode())
        order = {score: r for r, score in enumerate(sorted({sp.get_score(i) for i in self.ids.values()}, reverse=True))}
        self.rank = [0] * sp.get_piece_size()  # shifted, to be joined with a position
        for i in self.ids.values():
            self.rank[i] = order[sp.get_score(i)] << 32
        self.symbols = _Symbols(self.ids).__getitem__
        self.pairs = {self.ids[piece[:cut]] << 16 | self.ids[piece[cut:]]: i for piece, i in self.ids.items()
                      for cut in range(1, len(piece)) if piece[:cut] in self.ids and piece[cut:] in self.ids}
        ranks = np.array([r >> 32 for r in self.rank], np.int32)
        self.together = _Together(self.ids, self.pairs, ranks) if self.pairs and len(self.rank) <= _PAD and SPACE in self.ids else None
        self.words = (_WORDS if any(_ACROSS.search(piece) for piece in self.ids) else _SHORTER).findall
        self.dtype = np.dtype("<u2" if sp.get_piece_size() <= 1 << 16 else "<u4")
        self.forget()

    def draws(self, keys: np.ndarray) -> np.ndarray:
        """A number for each key, each of its bits set with probability ``dropout``."""
        if not 0 < self.below < 1 << _PRECISION:
            return np.full(len(keys), _MASK if self.below else 0, np.uint64)
        with np.errstate(over="ignore"):
            random = mix64(keys + _ROUNDS)
        out = np.zeros(len(keys), np.uint64)
        for k in range(_PRECISION):
            (np.bitwise_or if self.below >> k & 1 else np.bitwise_and)(out, random[k], out=out)
        return out

    def _further(self, key: int, symbols: int) -> Iterator[int]:
        """The draws after the first, for a word of so many symbols."""
        blocks = np.arange(1, 3 * symbols // _DRAWN + 2, dtype=np.uint64)
        with np.errstate(over="ignore"):
            return iter(self.draws(mix64(np.uint64(key) + blocks * _NEXT)).tolist())

    def segment(self, word: str, draw: int, key: int = 0) -> bytes:
        return self._merged(word, draw, key)[0]

    def _merged(self, word: str, draw: int, key: int) -> tuple[bytes, int]:
        """Ids of one word, its spaces written as U+2581, and the number of
        candidates met; the bits of ``draw``, then of further draws of ``key``,
        tell which of them are skipped. Agenda entries are
        rank * 2**32 + position; ``here`` holds the piece that the pair at a
        position would become, so entries of pairs that changed are passed over."""
        rank, join, below = self.rank, self.pairs.get, self.below
        met, further = 0, None
        symbols = list(map(self.symbols, word))
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        here = [join(a << 16 | b, -1) for a, b in zip(symbols, symbols[1:], strict=False)]
        agenda = [rank[made] | i for i, made in enumerate(here) if made >= 0]
        here.append(-1)
        heapify(agenda)
        while agenda:
            entry = heappop(agenda)
            i = entry & 0xFFFFFFFF
            made = here[i]
            if made < 0 or rank[made] | i != entry:
                continue
            if below:
                if met and not met % _DRAWN:
                    further = further or self._further(key, n)
                    draw = next(further)
                skip = draw >> met % _DRAWN & 1
                met += 1
                if skip:
                    here[i] = -1
                    continue
            j = after[i]
            symbols[i], symbols[j], here[j] = made, -2, -1
            after[i] = k = after[j]
            here[i] = -1
            if k < n:
                before[k] = i
                here[i] = then = join(made << 16 | symbols[k], -1)
                if then >= 0:
                    heappush(agenda, rank[then] | i)
            p = before[i]
            if p >= 0:
                here[p] = then = join(symbols[p] << 16 | made, -1)
                if then >= 0:
                    heappush(agenda, rank[then] | p)
        if -1 in symbols:
            out = []
            for c, s in zip(word, symbols, strict=True):
                out += [self.bytes_id[b] for b in c.encode()] if s == -1 else [s] if s >= 0 else []
        else:
            out = [s for s in symbols if s >= 0]
        return np.array(out, self.dtype).tobytes(), met

    def encode(self, text: str, key: str) -> bytes:
        return next(self.encode_all([(text, key)]))[1]

    def encode_all(self, rows: Iterable[tuple[str | None, str]]) -> Iterator[tuple[str | None, bytes | None]]:
        """Each text with its ids, from (text, key) pairs. Texts wait until
        enough words are to be merged, or enough words are found."""
        waiting: list[tuple[str | None, list[bytes] | None]] = []
        missed: list[tuple] = []
        words = new = 0
        for text, key in rows:
            before = len(missed)
            found = None if text is None else self._found(text, key, missed)
            waiting.append((text, found))
            words += len(found or ()) + 1
            new += sum(len(m[1]) for m in missed[before:])
            if new >= TOGETHER or words >= 16 * TOGETHER:
                self._learn(missed)
                yield from ((t, None if f is None else b"".join(f)) for t, f in waiting)
                waiting, words, new = [], 0, 0
        self._learn(missed)
        yield from ((t, None if f is None else b"".join(f)) for t, f in waiting)

    def _found(self, text: str, key: str, missed: list) -> list[bytes]:
        """Ids of each word; those of the words added to ``missed`` (their list
        and places, words, draws and keys) are put there by :meth:`_learn`."""
        if not text:
            return []
        raw = SPACE in text or "\0" in text
        words = self.words(" " + text)
        if self.below:
            base = np.uint64(xxhash.xxh3_64_intdigest(f"{self.seed}|{key}"))
            with np.errstate(over="ignore"):
                keys = mix64(base + _STEP * np.arange(len(words), dtype=np.uint64))
            if self.variants:
                taken = (keys % np.uint64(self.variants)).tolist()
                keys = np.array([xxhash.xxh3_64_intdigest(f"{self.seed}|{v}|{w}") for w, v in zip(words, taken, strict=True)], np.uint64)
            draws = self.draws(keys)
        else:
            keys = draws = np.zeros(len(words), np.uint64)
        if raw:
            return [self._exact(w, d, k) for w, d, k in zip(words, draws.tolist(), keys.tolist(), strict=True)]
        if len(self.known) > KNOWN:
            self._forget()
        known, chosen = self.known.get, self.chosen
        numbers = [known(w, 0) for w in words]
        at = np.array(numbers)
        out = [chosen[n] for n in numbers]
        places = np.flatnonzero(draws & self.bits[at] != self.skipped[at])
        if len(places):
            missed.append((out, places.tolist(), [words[i] for i in places.tolist()], draws[places], keys[places]))
        return out

    def _learn(self, missed: list[tuple]) -> None:
        """Segment the words missed and put their ids in their places. Of each
        word one segmentation is kept, where one draw decides it: the first,
        then the one without a skip, the commonest."""
        if not missed:
            return
        words = [w for m in missed for w in m[2]]
        draws, keys = (np.concatenate([m[i] for m in missed]) for i in (3, 4))
        widths = np.minimum(np.fromiter(map(len, words), np.int64, len(words)) + 3 & ~3, _WIDEST + 4)
        ids, met = [b""] * len(words), np.full(len(words), _DRAWN + 1)
        for width in np.unique(widths).tolist():
            some = np.flatnonzero(widths == width)
            if self.together is None or width > _WIDEST or len(some) < FEW:
                continue
            for start in range(0, len(some), TOGETHER):
                part = some[start:start + TOGETHER]
                done, met[part] = self.together.merged([words[i] for i in part.tolist()], draws[part], width, self.below, self.dtype)
                for i, x in zip(part.tolist(), done, strict=True):
                    ids[i] = x
        for i in np.flatnonzero(met > _DRAWN).tolist():
            ids[i], met[i] = self._merged(words[i].replace(" ", SPACE), int(draws[i]), int(keys[i]))
        done = iter(ids)
        for out, places, *_ in missed:
            for i in places:
                out[i] = next(done)
        missed.clear()
        bits = np.where(met < _DRAWN, (np.uint64(1) << met.astype(np.uint64) % np.uint64(_DRAWN)) - np.uint64(1), np.uint64(_MASK))
        skipped = draws & bits
        number = np.fromiter((self.known.get(w, 0) for w in words), np.int64, len(words))
        for i in np.flatnonzero((met <= _DRAWN) & ((number == 0) | (skipped == 0))).tolist():
            n = self.known.setdefault(words[i], len(self.chosen))
            if n == len(self.chosen):
                self.chosen.append(ids[i])
                if n == len(self.bits):
                    self.bits, self.skipped = np.resize(self.bits, 2 * n), np.resize(self.skipped, 2 * n)
            elif skipped[i] or not self.skipped[n]:
                continue
            self.chosen[n], self.bits[n], self.skipped[n] = ids[i], bits[i], skipped[i]

    @property
    def kept(self) -> int:
        return len(self.known)

    def _forget(self) -> None:
        """Keep the older half of the words."""
        half = len(self.known) // 2
        self.known = dict(x for x, _ in zip(self.known.items(), range(half)))
        del self.chosen[half + 1:]

    def forget(self) -> None:
        """Drop every segmentation kept. Of each word: its number, then by
        number its ids, the candidates met (as bits) and those skipped; an
        unknown word has the number 0, which no draw fits."""
        self.known: dict[str, int] = {}
        self.chosen = [b""]
        self.bits, self.skipped = np.zeros(1024, np.uint64), np.ones(1024, np.uint64)

    def _exact(self, word: str, draw: int, key: int) -> bytes:
        """A word that may hold U+2581 or U+0000 itself: those characters go to
        byte pieces, what lies between them is segmented, each with a draw."""
        out = []
        for no, part in enumerate(re.split(f"([{SPACE}\0])", word)):
            if part in (SPACE, "\0"):
                out.append(np.array([self.bytes_id[b] for b in part.encode()], self.dtype).tobytes())
            elif part:
                if no:
                    key = (key + no * int(_STEP)) & _MASK
                    draw = int(self.draws(np.array([key], np.uint64))[0])
                out.append(self.segment(part.replace(" ", SPACE), draw, key))
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        shown = self.shown
        return b"".join([shown[i] for i in ids.tolist()]).decode()[1:] if len(ids) else ""


_made: dict[tuple, Segmenter] = {}


def segmenter(*args) -> Segmenter:
    if args not in _made:
        _made.clear()
        _made[args] = Segmenter(*args)
    return _made[args]


def _encoder(args: tuple):
    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        release()
        made = segmenter(*args)
        for texts, keys in batches:
            pairs = ((t.as_py(), str(k)) for t, k in zip(texts, keys.to_pylist(), strict=True))
            rows = [None if ids is None else np.frombuffer(ids, made.dtype) for _, ids in made.encode_all(pairs)]
            ends = np.cumsum([0, *(0 if r is None else len(r) for r in rows)])
            flat = np.concatenate([r for r in rows if r is not None] or [np.zeros(0)]).astype(np.int32)
            made_ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat),
                                                mask=pa.array([r is None for r in rows], pa.bool_()))
            yield made_ids
        made.forget()  # the worker may go on to other stages
        release()

    return ids


def encode(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text", into: str = "ids", seed: int = SEED,
           dropout: float = DROPOUT, variants: int = VARIANTS) -> DataFrame:
    """``docs`` with the ids of each text in the column ``into``."""
    made = _encoder((model, seed, dropout, variants))
    return docs.withColumn(into, made(docs[f"`{text}`"].cast("string"), docs[f"`{doc_id}`"].cast("string")))


def decode(coded: DataFrame, model: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``coded`` with the text of each id list in the column ``into``."""

    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        made = segmenter(model, SEED, 0.0, 1)
        for batch in batches:
            yield pa.array([None if x is None else made.decode(np.array(x, np.int64)) for x in batch.to_pylist()], pa.string())

    return coded.withColumn(into, texts(coded[f"`{ids}`"]))


_DIGEST = "struct<n_ids:bigint,ids_crc32:bigint,n_chars:bigint,lossless:boolean>"


def round_trips(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text", into: str = "coded", seed: int = SEED,
                dropout: float = DROPOUT, variants: int = VARIANTS) -> DataFrame:
    """``docs`` with a digest of the ids of each text and whether they decode
    to it, without shipping the ids."""

    @F.arrow_udf(_DIGEST)
    def digest(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        made = segmenter(model, seed, dropout, variants)
        for texts, keys in batches:
            rows = []
            pairs = ((t.as_py() or "", str(k)) for t, k in zip(texts, keys.to_pylist(), strict=True))
            for t, ids in made.encode_all(pairs):
                ids = np.frombuffer(ids, made.dtype)
                rows.append({"n_ids": len(ids), "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes()), "n_chars": len(t),
                             "lossless": made.decode(ids) == t})
            yield pa.array(rows, pa.struct([("n_ids", pa.int64()), ("ids_crc32", pa.int64()), ("n_chars", pa.int64()),
                                            ("lossless", pa.bool_())]))

    return docs.withColumn(into, digest(docs[f"`{text}`"].cast("string"), docs[f"`{doc_id}`"].cast("string")))


def _model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op9_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded with merge dropout and decoded again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trips(docs, _model()).select("doc_id", "coded.*")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the ids of every text in a further column."""
    return encode(docs, _model(), into=fresh(docs, "token_ids"))
