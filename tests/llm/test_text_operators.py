"""Line frequency, mixing, line dedup and language ID against plain Python
versions, over documents with every awkward case, and on empty tables."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from wordloom.llm.language_id import BitSlicedFilter, N, fit_languages, gram_hashes, predict_language, row_indexes
from wordloom.llm.line_dedup import line_dedup
from wordloom.llm.line_frequency import line_frequency_rules, text_stats
from wordloom.llm.mixing import cycled_weights, mix, repeated, water_level

WHITE = " \t\n\x0b\f\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(s):
    return s.translate({c: c + 32 for c in range(65, 91)})


def plain_stats(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = sum(lines[i] in lines[:i] for i in range(len(lines))) if len(lines) < 500 else None
    grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    inside = {j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside)


@pytest.mark.parametrize("text", [None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "x\nx\n x\nX\n\n\nx",
                                  "a a a a a", "#*$%&|<> é\u2028é\u00a0b c\x0bd", "w " * 400,
                                  " ".join(random.Random(1).choices("abc", k=300))])
def test_text_stats(text):
    assert text_stats(text)[:5] == plain_stats(text)


def test_line_frequency(awkward):
    rows = [(r.doc_id, r.text, r.source) for r in awkward.collect()]
    got = line_frequency_rules(awkward, max_docs=3, max_share=0.05).collect()
    key = lambda line: ascii_lower(line.strip(WHITE))
    docs, held = defaultdict(set), defaultdict(set)
    for i, text, host in rows:
        if i is not None:
            docs[host].add(i)
            for line in (text or "").split("\n"):
                if key(line):
                    held[host, key(line)].add(i)
    want = Counter()
    for i, text, host in rows:
        n, chars, symbols, _, repeat = plain_stats(text)
        removed = sum(len(WORD.findall(line)) for line in (text or "").split("\n")
                      if len(held[host, key(line)]) > 3 and len(held[host, key(line)]) > 0.05 * len(docs[host]))
        failed = n < 50 or 100 * repeat > 50 * n
        want[i, host, n, chars, symbols, repeat, removed, failed, not failed and n - removed >= 0.5 * n] += 1
    assert Counter((r.doc_id, r.source, r.n_words, r.word_chars, r.n_symbols, r.n_repeat_words, r.removed_words,
                    r.base_failed, r.kept) for r in got) == want
    assert any(r.removed_words for r in got) and any(r.kept for r in got) and any(r.depleted for r in got)


def test_line_frequency_removes_the_lines(awkward):
    rows = [(r.doc_id, r.text, r.source) for r in awkward.collect()]
    key = lambda line: ascii_lower(line.strip(WHITE))
    docs, held = defaultdict(set), defaultdict(set)
    for i, text, host in rows:
        if i is not None:
            docs[host].add(i)
            for line in (text or "").split("\n"):
                held[host, key(line)].add(i)
    over = {(h, k) for (h, k), ids in held.items() if k and len(ids) > 3 and len(ids) > 0.05 * len(docs[h])}
    want = Counter((i, host, None if text is None else "\n".join(x for x in text.split("\n") if (host, key(x)) not in over))
                   for i, text, host in rows)
    got = line_frequency_rules(awkward, max_docs=3, max_share=0.05).collect()
    assert Counter((r.doc_id, r.source, r.clean_text) for r in got) == want
    assert want != Counter((i, host, text) for i, text, host in rows)
    left = {r.clean_text: r.n_words - r.removed_words for r in got}
    assert all(len(WORD.findall(t or "")) == n for t, n in left.items())


def plain_dedup(rows, least=10, threshold=2):
    return Counter(plain_dedup_rows(rows, least, threshold))


def plain_dedup_rows(rows, least=10, threshold=2):
    key = lambda line: ascii_lower(line.strip(WHITE))
    held = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= least:
                held[key(line)].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or len(key(x)) < least or len(held[key(x)]) < threshold or min(held[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("threshold", [2, 4])
def test_line_dedup(awkward, threshold):
    got = line_dedup(awkward, threshold=threshold)
    assert "__lost" in got.columns and set(awkward.columns) <= set(got.columns)
    assert (Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect())
            == plain_dedup([(r.doc_id, r.text) for r in awkward.collect()], threshold=threshold))


def plain_water(caps, weights, total):
    full = set()
    while True:
        free = [i for i in range(len(caps)) if i not in full]
        if not free:
            return list(caps)
        level = (total - sum(caps[i] for i in full)) / sum(weights[i] for i in free)
        over = {i for i in free if level * weights[i] >= caps[i]}
        if not over:
            return [caps[i] if i in full else level * weights[i] for i in range(len(caps))]
        full |= over


def test_water_level(spark):
    rng = random.Random(2)
    for _ in range(4):
        n = rng.randrange(1, 9)
        caps = [float(rng.choice([0, 1, 5, 40, 1000])) for _ in range(n)]
        weights = [float(rng.choice([1, 2, 3])) for _ in range(n)]
        total = 0.75 * sum(caps)
        level = water_level(spark.createDataFrame(list(zip(caps, weights)), "cap double, weight double"), total)
        got = [min(c, level * w) for c, w in zip(caps, weights)]
        assert np.allclose(got, plain_water(caps, weights, total)) and math.isclose(sum(got), total, abs_tol=1e-9)


def test_mix(awkward):
    weights = cycled_weights(awkward)
    assert {r.s: r.weight for r in weights.collect()} == {"s0": 3.0, "s1": 1.0, "s2": 2.0, None: 3.0}
    mixed = mix(awkward, weights)
    assert set(mixed.columns) == set(awkward.columns) | {"size", "source_size", "target", "copies"}
    got = mixed.collect()
    assert len(got) == awkward.count()
    sizes, taken, targets = Counter(), Counter(), {}
    for r in got:
        n = len(WORD.findall(r.text or ""))
        assert r.size == n and 0 <= r.copies <= 2
        sizes[r.source] += n
        taken[r.source] += n * r.copies
        targets[r.source] = r.target
    order = sorted(sizes, key=lambda s: (s is None, s))
    want = plain_water([2.0 * sizes[s] for s in order], [float([3, 1, 2][i % 3]) for i in range(len(order))],
                       1.5 * sum(sizes.values()))
    assert np.allclose([targets[s] for s in order], want)
    for s in order:
        largest = max(r.size for r in got if r.source == s)
        assert abs(taken[s] - targets[s]) <= largest / 2 + 1 and all(r.source_size == sizes[s] for r in got if r.source == s)
    assert Counter(mix(awkward.repartition(7), weights).collect()) == Counter(got)
    assert repeated(mixed).count() == sum(r.copies for r in got)


def test_mix_missing_weight(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "a b c", "y"), (3, None, "z")], "doc_id long, text string, source string")
    out = {r.doc_id: r for r in mix(docs, spark.createDataFrame([("x", 1.0), ("z", 1.0)], "s string, w double")).collect()}
    assert out[2].copies == 0 and out[2].target == 0 and out[1].copies == 2 and out[3].target == 0


def test_gram_hashes_follow_the_text():
    texts = [None, "", "A", "Hello, World", "a\x00b", "  lots   of  gaps 123 ", "ÉÀ", "\u0130x"]
    h, starts, has = gram_hashes(texts)
    assert has.tolist() == [False, False, True, True, True, True, True, True]
    for i, t in enumerate(texts):
        alone, at, _ = gram_hashes([t])
        assert alone.tolist() == h[starts[i]:starts[i + 1]].tolist()
        if t:
            plain = "  " + re.sub(r"[^a-zéài̇]+", " ", t.lower()).strip() + "  "
            if t in ("A", "Hello, World"):
                assert len(alone) == len(plain) - N + 1


def test_filter_against_sets():
    rng = np.random.default_rng(0)
    sets = [rng.integers(0, 2**63, 500, dtype=np.uint64) for _ in range(70)]
    rows = np.zeros((1 << 13, 2), np.uint64)
    for j, s in enumerate(sets):
        for at in row_indexes(s, 4, len(rows)):
            np.bitwise_or.at(rows[:, j // 64], at, np.uint64(1) << np.uint64(j % 64))
    f = BitSlicedFilter([f"l{j}" for j in range(70)], rows, 4)
    for j in (0, 63, 64, 69):
        m = f.masks(sets[j])
        assert ((m[:, j // 64] >> np.uint64(j % 64)) & np.uint64(1)).all()  # no false negatives
    other = rng.integers(0, 2**63, 20_000, dtype=np.uint64)
    rate = ((f.masks(other)[:, 0] >> np.uint64(3)) & np.uint64(1)).mean()
    assert abs(rate - f.false_positive[3]) < 0.2 * f.false_positive[3] + 0.002


def test_language_id(spark, awkward, nothing):
    model = fit_languages(awkward.filter("doc_id < 40"), min_share=1e-4)
    assert model.languages == ["en", "fr"]
    got = predict_language(awkward, model)
    assert set(got.columns) == set(awkward.columns) | {"score"}
    for r in got.collect():
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
        if r.doc_id is not None and 40 <= r.doc_id < 120:
            assert r.lang_pred == r.lang
    none = fit_languages(nothing)
    assert {r.lang_pred for r in predict_language(awkward, none).collect()} == {"und"}


def test_language_counts_match_sets(spark):
    """The filter's shares equal those of plain n-gram sets up to its false positives."""
    texts = [("the water under the stone", "en"), ("dans l'eau sous la pierre", "fr")]
    model = fit_languages(spark.createDataFrame(texts, "text string, lang string"), min_share=1e-6)
    sets = {lang: set(gram_hashes([t])[0].tolist()) for t, lang in texts}
    probe = ["the stone sous la water", "eau", "zzzz qqqq"]
    shares, _ = model.shares(probe)
    for i, t in enumerate(probe):
        h = gram_hashes([t])[0].tolist()
        for j, lang in enumerate(model.languages):
            assert abs(shares[i, j] - sum(x in sets[lang] for x in h) / len(h)) < 0.1


def test_empty_tables(spark, nothing):
    assert line_frequency_rules(nothing).count() == 0
    assert line_dedup(nothing).count() == 0
    assert mix(nothing, cycled_weights(nothing)).count() == 0
    assert predict_language(nothing, fit_languages(nothing)).count() == 0


def test_dedup_hash_matches_contract(spark):
    docs = spark.createDataFrame([(2, "A shared line\nown"), (1, "a SHARED line \n")], "doc_id long, text string")
    out = {r.doc_id: r.text for r in line_dedup(docs).collect()}
    assert out == {1: "a SHARED line \n", 2: "own"}
    assert hashlib.sha256(out[2].encode()).hexdigest()


def test_line_dedup_leaves_remnants_out(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    words = lambda t: len(WORD.findall(t or ""))
    for share in (0.5, 1.0):
        want = Counter()
        for (i, text), (_, n, gone, left) in zip(rows, plain_dedup_rows(rows)):
            if not gone or words(left) >= share * words(text):
                want[i, n, gone, left] += 1
        got = Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in line_dedup(awkward, min_share=share).collect())
        assert got == want and sum(want.values()) < len(rows)
