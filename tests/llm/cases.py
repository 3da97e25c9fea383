"""Shared inputs of the tests of this folder."""
import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = [a + b for a in ("ba", "ce", "di", "fo", "gu", "ha", "je", "ki", "lo", "mu") for b in ("lan", "mer", "nik", "pol", "sut")]
LONG = " ".join(WORDS[i * 7 % 50] + str(i % 997) for i in range(30_000))


def prose(seed: int, words: int, per_line: int = 9) -> str:
    r = random.Random(seed)
    w = [r.choice(WORDS) + r.choice(("", "", "s", "er")) for _ in range(words)]
    return "\n".join(" ".join(w[i:i + per_line]) + "." for i in range(0, words, per_line))


def frame(spark, rows):
    """(doc_id, text[, lang]) rows as a documents table."""
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows], SCHEMA)


def edited(text: str, seed: int, changes: int) -> str:
    r = random.Random(seed)
    words = text.split(" ")
    for _ in range(changes):
        words[r.randrange(len(words))] = "edit" + str(r.randrange(10 ** 6))
    return " ".join(words)


def corpus():
    """Copies, near copies, shared lines and passages, and odd rows."""
    rows = [(i, prose(i, 40 + 13 * i)) for i in range(12)]
    base = prose(100, 200)
    rows += [(20 + i, edited(base, i, 3)) for i in range(8)]  # near copies
    rows += [(40 + i, base) for i in range(4)]                # copies, one larger than the near copies
    passage = prose(200, 60)
    rows += [(50 + i, prose(300 + i, 30) + "\n" + passage + "\n" + prose(400 + i, 30)) for i in range(5)]
    rows += [(60, None), (61, ""), (62, "   \n "), (63, "one two"), (64, "one two"), (65, "One TWO"), (66, "na " * 300),
             (67, "na " * 310), (None, base), (None, "without id"), (69, prose(1, 53)), (69, prose(1, 53)), (70, LONG),
             (71, LONG + " tail"), (72, "été ▁ 日本語 \U0001F600 \u0000 x\ty\r\n\r\nz")]
    return rows
