"""Co-occurrence adds pairs up in the task that makes them (findings F1, F19)."""

from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from wordloom.operators import features as FE
from wordloom.operators import pairs


def exchanges(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.strip(" +-:*") for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def test_sentence_pairs_are_shuffled_once(spark, monkeypatch):
    monkeypatch.setattr(FE, "DEALT_PAIRS", 10)
    docs = spark.createDataFrame([(1, "red blue red. green blue"), (2, "blue red\nred"), (3, None), (4, "")], "doc_id long, text string")
    co = FE.sentence_cooccurrence(docs)
    assert len(exchanges(co)) == 1 and "(t1#" in exchanges(co)[0]  # one row per term of a batch, not one per pair and sentence
    assert {(r.t1, r.t2): r.n for r in co.collect()} == {
        ("red", "blue"): 3, ("blue", "red"): 3, ("green", "blue"): 1, ("blue", "green"): 1}


@pytest.mark.parametrize("strip, batch", [(1, 1), (7, 20), (10**6, 10**6)])
def test_odd_terms_in_small_batches(spark, monkeypatch, strip, batch):
    monkeypatch.setattr(pairs, "STRIP_PAIRS", strip)
    monkeypatch.setattr(pairs, "BATCH_TERMS", batch)
    terms = ["a", "a\x00", "\x01", "\x010", "\x00\x01", "", "é", "\U0001F600", "￿"]
    rows = [(c, t, (c + i) % 3 + 1) for c in range(6) for i, t in enumerate(terms) if (c + i) % 4]
    td = spark.createDataFrame(rows, "doc_id long, term string, n long")
    expected = Counter()
    for c in range(6):
        for (_, a, n), (_, b, m) in combinations([r for r in rows if r[0] == c], 2):
            expected[a, b] += n * m
            expected[b, a] += n * m
    for block_terms in (3, 512):
        made = pairs.stripes(td.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("term", "n"))).alias("x"))
                             .select(F.col("x.term").alias("t"), F.col("x.n").alias("n"), F.lit(0).alias("cut")).toArrow().to_batches())
        assert all(len(b) for b in made)
        assert {(r.t1, r.t2): r.n for r in FE.context_cooccurrence(td, block_terms=block_terms).collect()} == dict(expected)


@pytest.mark.parametrize("strip, batch", [(1, 1), (10**6, 10**6)])
@pytest.mark.parametrize("window", [1, 3])
def test_window_pairs_travel_summed(spark, monkeypatch, window, strip, batch):
    monkeypatch.setattr(pairs, "STRIP_PAIRS", strip)
    monkeypatch.setattr(pairs, "BATCH_TERMS", batch)
    monkeypatch.setattr(FE, "DEALT_PAIRS", 10)
    rows = [(1, ["b", "a", "b", "b", "c", "a\x00"]), (1, ["a", "b"]), (2, ["x", None, "y", "x"]), (3, []), (4, None), (5, ["\x01"])]
    docs = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    near = [(d, *sorted((a, b))) for d, t in rows for i, a in enumerate(t or []) for b in t[i + 1:i + 1 + window]
            if a is not None and b is not None and a != b]
    for binary in (False, True):
        half = Counter((a, b) for _, a, b in (set(near) if binary else near))
        co = FE.cooccurrence(docs, window, tokens="tokens", binary=binary)
        assert binary or len(exchanges(co)) == 1 and "(t1#" in exchanges(co)[0]
        assert {(r.t1, r.t2): r.n for r in co.collect()} == {**half, **{(b, a): n for (a, b), n in half.items()}}
