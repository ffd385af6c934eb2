"""The n-gram join against all pairs."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wordloom.llm.ngram_join import Rule, WordHashes, classes_of, components, jaccard_components, keys_of, level, shingles


def plain_sets(rows, k=3):
    out = []
    for i, text in rows:
        w = (text or "").encode().lower().split()
        out.append((i, frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k
                    else frozenset([tuple(w)] if w else [])))
    return out


def plain_components(rows, a=9, b=10):
    sets = plain_sets(rows)
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, (i, s) in enumerate(sets):
        for j, t in sets[:x]:
            if i is not None and j is not None and s and t:
                both = len(s & t)
                if b * both >= a * (len(s) + len(t) - both):
                    u, v = sorted((find(i), find(j)))
                    root[v] = u
    return Counter((i, len(s), None if i is None else find(i)) for i, s in sets)


def groups(rng, sizes, words, edits):
    """Groups of near copies: a text and copies with a few words changed."""
    rows = []
    for size in sizes:
        n = rng.choice(words)
        base = [f"w{rng.randrange(100000)}" for _ in range(n)]
        for _ in range(size):
            t = list(base)
            for _ in range(rng.choice(edits)):
                t[rng.randrange(n)] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(t)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("frequent", [2, 50])
def test_near_copies(spark, frequent):
    rng = random.Random(frequent)
    rows = groups(rng, [1, 1, 1, 2, 3, 8, 25], [11, 12, 40, 150, 300], [0, 0, 1, 1, 2, 4, 8])
    shared = " ".join(f"common{i}" for i in range(12))
    rows += [(1000 + i, shared + " " + " ".join(f"o{rng.randrange(10**6)}" for _ in range(rng.choice([0, 1, 2, 30])))) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_components(docs, frequent=frequent)
    want = plain_components(rows)
    assert Counter(tuple(r) for r in got.collect()) == want
    assert len({c for _, _, c in want}) < len(rows) - 20


def test_awkward(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert Counter(tuple(r) for r in jaccard_components(awkward).collect()) == plain_components(rows)


def test_empty(nothing):
    assert jaccard_components(nothing).count() == 0


def test_all_equal(spark):
    docs = spark.createDataFrame([(i, "the same text in every row of it") for i in range(40, 0, -1)], "doc_id long, text string")
    assert {r.component_id for r in jaccard_components(docs).collect()} == {1}


def test_shingles():
    w = WordHashes()
    assert len(shingles(None, 3, w)) == len(shingles(" \n", 3, w)) == 0
    assert len(shingles("a b", 3, w)) == 1 and shingles("A  B", 3, w).tolist() == shingles("a b", 3, w).tolist()
    assert len(shingles("a b c a b c", 3, w)) == 3
    assert shingles("a b", 3, w).tolist() != shingles("b a", 3, w).tolist()


@settings(max_examples=150, deadline=None)
@given(st.integers(9, 400), st.integers(0, 30), st.integers(0, 30), st.floats(0, 1), st.sampled_from([0.9, 0.8, 0.5]), st.randoms())
def test_similar_sets_share_a_key(n, gone, added, share, threshold, rng):
    """Any two sets that reach the threshold share a key whose places allow it."""
    rule = Rule(threshold)
    x = [rng.getrandbits(64) for _ in range(n)]
    y = x[min(gone, n - 1):] + [rng.getrandbits(64) for _ in range(added)]
    both = len(set(x) & set(y))
    if rule.b * both < rule.a * (len(x) + len(y) - both) or len(x) == len(y) == both:
        return
    frequent = {t for t in {*x, *y} if rng.random() < share}

    def keyed(s):
        tokens = np.array(sorted(s), np.uint64)
        return keys_of(tokens, np.array([int(t) in frequent for t in tokens]), rule)

    kx, ky = dict(), dict()
    for target, s in ((kx, x), (ky, y)):
        for k, p in keyed(s):
            target[k] = min(p, target.get(k, p))
    fits = [k for k in kx.keys() & ky.keys()
            if (rule.a + rule.b) * min(len(x) - kx[k], len(y) - ky[k]) >= rule.a * (len(x) + len(y))]
    assert fits


def test_number_of_combined_keys_is_proportional():
    rng = random.Random(0)
    rule = Rule(0.9)
    for n in (50, 500, 5000, 20000):
        tokens = np.array(sorted(rng.getrandbits(64) for _ in range(n)), np.uint64)
        assert len(keys_of(tokens, np.ones(n, bool), rule)) <= 2 * n
    assert classes_of(level(8)) == 1


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(70)]
    edges += [(500, 500 + i) for i in range(1, 40)] + [(7, 7), (3, 2)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            u, v = sorted((find(a), find(b)))
            root[v] = u
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {x: find(x) for x in root} and len(got) == len(root)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_ids_with_several_texts(spark):
    """Rows sharing an id, with texts of one size, among many near copies."""
    rng = random.Random(11)
    rows = groups(rng, [12, 9, 5], [40], [0, 1, 2])
    rows = [(i // 3, t) for i, t in rows] + rows[:4] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(r) for r in jaccard_components(docs, frequent=3).collect()) == plain_components(rows)


def plain_links(rows, k, a, b):
    """As plain_components, for any shingle width and threshold a / b."""
    sets = plain_sets(rows, k)
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, (i, s) in enumerate(sets):
        for j, t in sets[:x]:
            both = len(s & t)
            if both and b * both >= a * (len(s) + len(t) - both):
                u, v = sorted((find(i), find(j)))
                root[v] = u
    return Counter((i, len(s), find(i)) for i, s in sets)


@pytest.mark.parametrize("threshold,a,b,least", [(0.8, 4, 5, 4), (0.5, 1, 2, 4), (0.5, 1, 2, 1), (0.2, 1, 5, 1)])
def test_short_sets_of_frequent_tokens(spark, threshold, a, b, least):
    rng = random.Random(least)
    rows, seen = [], 0
    for g in range(24):  # words of a group are in all its sets; each also fills up other sets
        base = [f"g{g}w{i}" for i in range(rng.randrange(least, 13))]
        for drop in (0, 0, 1, 2):
            own = base[:max(1, len(base) - drop)] + [f"x{len(rows)}"] * rng.randrange(2)
            rows.append((len(rows), " ".join(own)))
        for w in base:
            for _ in range(4):
                rows.append((len(rows), " ".join([w] + [f"o{seen + j}" for j in range(12)])))
                seen += 12
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_links(rows, 1, a, b)
    assert len({c for _, _, c in want}) < len(rows) - 24
    for frequent in (3, 10**6):
        assert Counter(tuple(r) for r in jaccard_components(docs, k=1, threshold=threshold, frequent=frequent).collect()) == want


def test_nine_words_and_their_first_eight(spark):
    """4 of 5 shingles shared, every one of them in 40 other texts."""
    words = [f"w{i}" for i in range(9)]
    rows = [(0, " ".join(words)), (1, " ".join(words[:8]))]
    for i in range(5):
        rows += [(100 * i + j + 10, " ".join(words[i:i + 5] + [f"o{i}x{j}y{x}" for x in range(4)])) for j in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(r) for r in jaccard_components(docs, k=5, threshold=0.8).collect()) == plain_links(rows, 5, 4, 5)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 12), st.integers(0, 8), st.integers(0, 8), st.floats(0, 1), st.sampled_from([0.8, 0.5, 0.2]), st.randoms())
def test_short_similar_sets_share_a_key(n, gone, added, share, threshold, rng):
    test_similar_sets_share_a_key.hypothesis.inner_test(n, gone, added, share, threshold, rng)
