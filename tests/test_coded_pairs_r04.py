"""Partners that are common words travel as numbers of two bytes (finding F3)."""

from collections import Counter
from itertools import combinations

import pytest

from wordloom.operators import features as FE
from wordloom.operators import pairs

TEXTS = ["red blue red. green blue\nred", "Blue red\nred zinc, red; odd!", "zinc odd? odd zinc red", None, "", "alone. x"]


@pytest.mark.parametrize("common, strip, batch", [(65_536, 10**6, 10**6), (2, 1, 1), (2, 10**6, 4), (0, 7, 10**6)])
def test_sentences_with_few_common_words(spark, monkeypatch, common, strip, batch):
    monkeypatch.setattr(pairs, "COMMON", common)
    monkeypatch.setattr(pairs, "STRIP_PAIRS", strip)
    monkeypatch.setattr(pairs, "BATCH_TERMS", batch)
    monkeypatch.setattr(FE, "DEALT_PAIRS", 10)
    want = Counter()
    for text in TEXTS:
        for s in "".join(c if c.isalpha() or c in " .!?\n" else " " for c in (text or "").lower()).replace("!", ".").replace("?", ".").replace("\n", ".").split("."):
            seen = Counter(w for w in s.split() if len(w) > 1)
            for a, b in combinations(seen, 2):
                want[a, b] += seen[a] * seen[b]
                want[b, a] += seen[a] * seen[b]
    got = FE.sentence_cooccurrence(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").coalesce(2)).collect()
    assert {(r.t1, r.t2): r.n for r in got} == want and len(got) == len(want)


def test_common_partners_are_short_numbers(spark):
    df = spark.createDataFrame([(["a", "b\x00", "rare", "a"], None, 0), (["b\x00", "more", "rare"], None, 0)], "t array<string>, n array<long>, cut int")
    rows = [r for b in pairs.stripes(iter(df.toArrow().to_batches()), common=["a", "b\x00"]) for r in b.to_pylist()]
    half = pairs.SHORT
    at = {(r["t1"], r["t2"]): (r["c"], r["n"]) for r in rows}
    assert sorted(zip(*at["rare", None])) == [(-half, 2), (1 - half, 2)]
    assert at["b\x010", None] == ([-half], [2]) and at["more", None] == ([1 - half], [1]) and at["more", "rare"] == (None, [1])
    assert len(at) == 4
    assert pairs.CODED_STRIPES == "t1 string, t2 string, c array<short>, n array<long>"
