"""n-gram overlaps are counted per id, not as rows of n-grams."""

from wordloom.operators import evaluate as EV


def test_no_token_rows(spark):
    df = spark.createDataFrame([(1, "a b", "b"), (1, "b c", "b a"), (2, None, "x"), (None, "x y", "x y")],
                               "id int, prediction string, reference string")
    got = EV.rouge_ns(df, (1, 2))
    assert "_tok" not in got._jdf.queryExecution().executedPlan().toString()
    res = {(r.id, r.n): (r.precision, r.recall) for r in got.collect()}
    assert res == {(1, 1): (0.75, 1.0), (1, 2): (0.0, 0.0), (2, 1): (0.0, 0.0), (2, 2): (0.0, 0.0),
                   (None, 1): (1.0, 1.0), (None, 2): (1.0, 1.0)}
