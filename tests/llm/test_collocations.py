"""Phrase collocations against a plain version: awkward documents, exact
scores, ties, colliding fingerprints, texts cut into steps, empty tables."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from wordloom.llm import collocations as C


def ascii_lower(s):
    return s.translate({c: c + 32 for c in range(65, 91)})


def plain_counts(rows, max_words=5):
    f, n, first = Counter(), Counter(), {}
    for i, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", ascii_lower(text or "")):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for m in range(1, max_words + 1):
                for j in range(len(w) - m + 1):
                    key = lang, " ".join(w[j:j + m])
                    f[key] += 1
                    if i is not None:
                        first[key] = min(i, first.get(key, i))
    return f, n, first


def plain(rows, min_count=100, top=2000, max_words=5, cover=100):
    f, n, first = plain_counts(rows, max_words)
    cands = {k: a for k, a in f.items() if a >= min_count and " " in k[1]}
    inside = defaultdict(int)
    for (lang, p), a in cands.items():
        w = p.split(" ")
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                key = lang, " ".join(w[i:i + size])
                inside[key] = max(inside[key], a)
    out = defaultdict(list)
    for (lang, p), a in cands.items():
        if 100 * inside.get((lang, p), -1) >= cover * a:
            continue
        w = p.split(" ")
        score, k = min((1000 * a * n[lang] // (f[lang, " ".join(w[:k])] * f[lang, " ".join(w[k:])]), k) for k in range(1, len(w)))
        out[lang].append((-score, -a, p.encode(), p, f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])], first.get((lang, p))))
    return {(lang, r, p, -a, x, y, n[lang], -s, i) for lang, found in out.items()
            for r, (s, a, _, p, x, y, i) in enumerate(sorted(found)[:top], 1)}


def found(df, **options):
    rows = [tuple(r) for r in C.collocations(df, **options).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("options", [dict(min_count=4), dict(min_count=3, top=7, step_bytes=3000, filter_bits=8),
                                     dict(min_count=6, max_words=3, cover=80)])
def test_awkward(awkward, options):
    rows = [(r.doc_id, r.text, r.lang) for r in awkward.collect()]
    want = plain(rows, **{k: v for k, v in options.items() if k in ("min_count", "top", "max_words", "cover")})
    assert found(awkward, **options) == want and len(want) >= 7


def test_ties_and_marks(spark):
    """Overlaps count, phrases don't cross marks, blanks of any number part
    words, other white space and letters beyond A-Z are parts of words."""
    texts = ["a a a a a a", "New  York\tcity. new york CITY, new york; city", "É é x é y É é x",
             "new york city new york city", "x y\x0bx y\x0cx y\rx y\nx y", "!!! ...", "it's it's it's", "q r " * 40]
    rows = [(i, t, lang) for i, t in enumerate(texts * 2) for lang in ("en", None, "und", "", "x\ny")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    for least in (2, 5):
        want = plain(rows, min_count=least)
        assert found(df, min_count=least) == want and {"en", "und"} <= {w[0] for w in want}


def test_scores_beyond_64_bits(spark):
    """The product 1000 * a * n of large counts is exact."""
    rows = spark.createDataFrame([("a b c", 9 * 10**14, 8 * 10**15)], "p string, a long, n long")
    e = "cast({} as decimal(19, 0))".format
    got = rows.selectExpr(f"({e('a')} * 1000 * {e('n')}) div ({e('a')} * {e('a - 7')}) AS s").first().s
    assert got == 1000 * 9 * 10**14 * 8 * 10**15 // (9 * 10**14 * (9 * 10**14 - 7))


def test_no_rows(spark, nothing):
    assert found(nothing) == set()
    nulls = spark.createDataFrame([(None, None, None), (1, "", "en"), (2, " . ", "fr")], "doc_id long, text string, lang string")
    assert found(nulls, min_count=1) == set()
    assert found(spark.createDataFrame([(1, "one", "en")] * 3, "doc_id long, text string, lang string"), min_count=1) == set()


def scans(rows, min_count, max_words=5, step_bytes=1 << 20):
    """The scans and their aggregates in this process, for patched fingerprints."""
    batches = [pa.RecordBatch.from_pylist([{"_id": i, "_text": t, "_lang": lang or "und"} for i, t, lang in rows[k:k + 7]],
                                          schema=pa.schema([("_id", pa.int64()), ("_text", pa.string()), ("_lang", pa.string())]))
               for k in range(0, len(rows), 7)]
    texts, known = Counter(), None
    for before, now in C.scans(max_words):
        sums = Counter()
        for batch in C._scan(before, now, known, step_bytes)(batches):
            for r in batch.to_pylist():
                sums[r["print"], r["text"]] += r["n"]
        held = C.PrintFilter(12, np.zeros(64, np.uint64))
        for (print_, text), n in sums.items():
            if text is None and n >= min_count:
                at = print_ >> (C._BITS - 12)
                held.words[at >> 6] |= np.uint64(1) << np.uint64(at & 63)
            elif text is not None and n >= min_count and not text.endswith("\n"):
                texts[tuple(text.rsplit("\n", 1))] += n
        known = type("Value", (), {"value": held})
    return texts


@pytest.mark.parametrize("kept_bits", [48, 4, 0])
def test_colliding_fingerprints(monkeypatch, kept_bits):
    """With few or no bits of the fingerprints left, different phrases share
    one; their texts keep their own exact counts."""
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["a", "b", "cc", "longerword", "longerwork"]) for _ in range(30)) + rng.choice([".", "!"]),
             rng.choice(["en", "fr", None])) for i in range(40)]
    real = C.Words.prints
    keep = np.uint64((1 << 48) - (1 << (48 - kept_bits)))
    monkeypatch.setattr(C.Words, "prints", lambda *a: real(*a) & keep)
    f, _, _ = plain_counts(rows)
    assert scans(rows, 5) == {k: n for k, n in f.items() if n >= 5}


def test_fingerprints_follow_the_text():
    """A phrase has one fingerprint wherever it lies; all phrases differ."""
    poly = C.Polynomials()
    rng = random.Random(4)
    texts = [" ".join("w%d" % rng.randrange(60) for _ in range(300)).encode() for _ in range(5)]
    w, alone = C.Words(texts, poly), [C.Words([t], C.Polynomials()) for t in texts]
    for m in (1, 2, 5):
        at = np.flatnonzero(w.whole(m))
        lang = np.zeros(len(w), np.uint64)
        prints = w.prints(m, at, lang)
        assert prints.tolist() == [x for a in alone for x in a.prints(m, np.flatnonzero(a.whole(m)), np.zeros(len(a), np.uint64)).tolist()]
        names = w.names(m, at, ["l"] * 5).to_pylist()
        assert len(set(prints.tolist())) == len(set(names)) == len(set(zip(prints.tolist(), names)))
        assert w.same(m, at, np.roll(at, 1)).tolist() == [a == b for a, b in zip(names, names[-1:] + names[:-1])]


def test_rows_are_added_up():
    row = lambda p, t, n, i: C._rows(np.array(p), None if t is None else pa.array(t, pa.string()), n, np.array(i))
    batches = [row([1, 2], None, [5, 1], [7, C._NO_ID]), row([2, 1], None, [1, 2], [4, 9]), row([1, 1], ["a", "b"], [1, 1], [3, 3]),
               row([1], ["a"], [4], [2])]
    for limit in (1, 3, 100):
        sums, first = Counter(), {}
        for b in C._added_up(iter(batches), limit):
            for r in b.to_pylist():
                sums[r["print"], r["text"]] += r["n"]
                if r["first_id"] is not None:
                    first[r["print"], r["text"]] = min(r["first_id"], first.get((r["print"], r["text"]), 99))
        assert sums == {(1, None): 7, (2, None): 2, (1, "a"): 5, (1, "b"): 1}
        assert first == {(1, None): 7, (2, None): 4, (1, "a"): 2, (1, "b"): 3}
    assert list(C._added_up(iter([]))) == []


def test_long_texts_are_cut_at_marks():
    text = ("one two. three four five! " * 900 + "x " * 4000 + "; end").lower()
    batch = pa.RecordBatch.from_pydict({"_text": [text, None, "", "a. b"], "_lang": ["en"] * 4, "_id": [1, 2, 3, 4]})
    cut = list(C.steps(batch, 1000))
    assert b"".join(t for step in cut for t, _, i in step if i == 1).decode() == text and len(cut) > 20
    f = Counter()
    for step in cut:
        f += plain_counts([(i, t.decode(), lang) for t, lang, i in step])[0]
    assert f == plain_counts([(1, text, "en"), (4, "a. b", "en")])[0]
