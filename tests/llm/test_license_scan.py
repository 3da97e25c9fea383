import random
import re

import pytest

from layerflow.llm import license_scan as m
from layerflow.llm.license_templates import NOTICES, PHRASES
from tests.llm.cases import LONG, corpus, frame, prose

_WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return _WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def places(text):
    w = words(text)
    return sorted((i, label) for label, phrase in PHRASES for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split())


def common(x, y):
    """Plain dynamic programme for the longest common subsequence."""
    row = [0] * (len(y) + 1)
    for a in x:
        last = row
        row = [0]
        for j, b in enumerate(y):
            row.append(last[j] + 1 if a == b else max(row[j], last[j + 1]))
    return row[-1]


def brute_labels(text):
    """Labels by the best window of each notice, without any index."""
    w, out = words(text), {label for _, label in places(text)}
    for label, notice in NOTICES:
        t = words(notice)
        width = len(t) + len(t) // 2
        starts = range(0, max(1, len(w) - width + 1), max(1, len(t) // 8)) if len(w) > width else [0]
        if set(t) & set(w) and max(common(t, w[i:i + width]) for i in starts) >= 0.8 * len(t):
            out.add(label)
    return ",".join(sorted(out))


def scanned(spark, rows):
    df = frame(spark, rows).selectExpr("doc_id", "text", "lang as label", "1 as spans", "2 as template")
    return [(r["row"]["doc_id"], r["row"]["text"], r["found"]) for r in m.scan(df).collect()]


def mixed():
    """Notices whole, edited by few words, cut, repeated, and beside each other."""
    r = random.Random(3)
    rows = corpus()
    for n, (_, notice) in enumerate(NOTICES):
        w = notice.split()
        rows.append((200 + n, prose(n, 40) + "\n" + notice + "\n" + prose(n + 50, 40)))
        rows.append((300 + n, prose(n, 30) + " " + " ".join(w[:len(w) // 3])))
        if len(w) > 20:
            changed = list(w)
            for i in sorted(r.sample(range(5, len(w) - 5), len(w) // 25 + 1), reverse=True):
                changed[i:i + 1] = r.choice(([], ["other"], [w[i], "the", "new"]))
            rows.append((400 + n, prose(n, 30) + " " + " ".join(changed) + " " + prose(n + 9, 30)))
    both = NOTICES[0][1] + " " + NOTICES[4][1]
    rows += [(500, both), (501, both + " " + both), (502, "The MIT License. mit  LICENSE, MIT-license mit"), (503, "mit license " * 50),
             (504, LONG + " " + NOTICES[1][1]), (None, NOTICES[0][1]), (505, "General Public\tLicense general public"), (506, "mit"),
             (507, "Licensed under CC BY-NC 4.0."), (507, "Licensed under CC BY-NC 4.0.")]
    return rows


def test_base_places_and_labels_match_brute_force(spark):
    rows = mixed()
    found = scanned(spark, rows)
    assert sorted((str(i), t or "") for i, t, _ in found) == sorted((str(i), t or "") for i, t, *_ in rows)
    for _, text, f in found:
        assert f["n_words"] == len(words(text))
        assert sorted((s["start"], s["label"]) for s in f["spans"] if s["phrase"]) == places(text)
        if len(text or "") < 20_000:
            assert ",".join(sorted({s["label"] for s in f["spans"] if s["score"] >= m.LEAST})) == brute_labels(text), text


def test_spans_are_tight_and_separate(spark):
    notice, other = NOTICES[0][1], NOTICES[4][1]
    n, o = len(words(notice)), len(words(other))
    text = f"one two three {notice} four {other} {notice}"
    (_, _, f), = scanned(spark, [(1, text)])
    good = sorted((s["label"], s["start"], s["stop"], s["score"]) for s in f["spans"] if s["score"] >= m.LEAST)
    assert good == [("bsd", 4 + n, 4 + n + o, 1.0), ("mit", 3, 3 + n, 1.0), ("mit", 4 + n + o, 4 + 2 * n + o, 1.0)]
    for label in ("mit", "bsd"):
        own = sorted((s["start"], s["stop"]) for s in f["spans"] if s["label"] == label)
        assert all(a[1] <= b[0] for a, b in zip(own, own[1:], strict=False))


def test_lcs_against_plain_programme():
    r = random.Random(2)
    for _ in range(200):
        x, y = ([r.choice([b"a", b"b", b"c", b"d"]) for _ in range(r.randrange(1, 30))] for _ in "xy")
        n, end = m.lcs(x, y)
        assert n == common(x, y) == common(x, y[:end])
        assert not end or common(x, y[:end - 1]) < n


def test_rolling_hashes_depend_on_their_words_only():
    a = m.rolling([b"x", b"a", b"b", b"c", b"d"], [2, 4])
    b = m.rolling([b"a", b"b", b"c", b"d"], [2, 4])
    assert a[4][1] == b[4][0] and list(a[2][1:]) == list(b[2]) and a[4][0] != b[4][0]
    assert m.rolling([b"a"], [2]) == {} and m.rolling([], [2]) == {}
    bits = m.bitmap(b[2])
    assert all(bits[g >> m.np.uint64(64 - len(bits).bit_length() + 1)] for g in b[2])


def test_empty_and_too_many_templates(spark):
    assert scanned(spark, []) == []
    with pytest.raises(ValueError):
        m.Template("none", "...")
    big = [m.Template("big", " ".join(map(str, range(m.MAX_GRAMS + 10))))]
    with pytest.raises(ValueError):
        m.scan(frame(spark, []), templates=big)


def test_query(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = m.op12_license_scan(spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        want = places(docs[r["doc_id"]])
        starts = [i for i, _ in want]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == \
            (len(words(docs[r["doc_id"]])), len(want), min(starts, default=None), max(starts, default=None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in want}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert (r["score"] >= m.LEAST) == (r["labels"] != "")
        assert "CC BY-NC 4.0" not in (docs[r["doc_id"]] or "") or "cc-by-nc" in r["labels"]
