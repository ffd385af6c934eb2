"""N-grams of two lengths are counted from one row per shorter one (finding F13)."""

from collections import Counter

import pytest

from wordloom.operators import pairs
from wordloom.operators import text as T

ROWS = [(["a", "b", "c", "a", "b", "d"],), (["a", "b"],), (["a"],), ([],), (None,), (["x\x00", "\x01", "\x010", "x\x00", "\x01"],), (["a", "b", "c"],)]


@pytest.mark.parametrize("n, batch", [(2, 10**6), (3, 1), (3, 10**6), (4, 10**6)])
def test_counts_of_both_lengths(spark, monkeypatch, n, batch):
    monkeypatch.setattr(pairs, "BATCH_TERMS", batch)
    monkeypatch.setattr(T, "DEALT_GRAMS", 10)
    want = Counter((k, " ".join(t[i:i + k])) for (t,) in ROWS for k in (n - 1, n) for i in range(len(t or []) - k + 1))
    got = T.ngram_counts(spark.createDataFrame(ROWS, "tokens array<string>").coalesce(2), n)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(t1#" in plan  # no row of its own for a shorter gram
    rows = got.collect()
    assert {(r.n, r.term): r.cnt for r in rows} == want and len(rows) == len(want)
    assert got.dtypes == [("n", "int"), ("term", "string"), ("cnt", "bigint")]
    assert T.ngram_counts(spark.createDataFrame(ROWS[2:5], "tokens array<string>"), 3).count() == 0
