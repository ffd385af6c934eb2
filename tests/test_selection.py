"""Selection by histograms, percentiles by brackets, and divisions by zero."""

import datetime as dt
import decimal
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordloom.operators import classify as CL
from wordloom.operators import evaluate as EV
from wordloom.operators import ordering as OR
from wordloom.operators import selection as SE
from wordloom.operators import telemetry as TE

RNG = random.Random(11)
D = decimal.Decimal
KINDS = {
    "bigint": [RNG.randrange(-5, 400) for _ in range(300)] + [2**63 - 1, -2**63, 2**62, 2**62 + 1, None, None],
    "double": [RNG.gauss(0, 10) for _ in range(300)] + [1e308, -1e308, float("inf"), float("-inf"), float("nan"), 0.0, None],
    "string": ["".join(RNG.choices("ab", k=RNG.randrange(25))) for _ in range(300)] + ["", None, "é", "a" * 90, "a" * 91, "a\x00"],
    "decimal(30,4)": [D(RNG.randrange(-10**6, 10**6)) / 100 for _ in range(300)] + [D(10**24), D(10**24) + D("0.0001"), D(-10**24), None],
    "date": [dt.date(2000, 1, 1) + dt.timedelta(RNG.randrange(200)) for _ in range(300)] + [None],
    "timestamp": [dt.datetime(2000, 1, 1) + dt.timedelta(seconds=RNG.randrange(10**6)) for _ in range(300)] + [None],
    "timestamp_ntz": [dt.datetime(2000, 1, 1) + dt.timedelta(microseconds=RNG.randrange(10**12)) for _ in range(300)] + [None],
    "boolean": [True] * 20 + [False] * 30 + [None] * 5,
}


@pytest.mark.parametrize("kind", list(KINDS))
def test_first_rows_is_the_head_of_the_sort(spark, kind):
    rows = [(v, i) for i, v in enumerate(KINDS[kind])]
    df = spark.createDataFrame(rows, f"o {kind}, i long").repartition(4)
    ranked = [r.i for r in df.orderBy("o", F.xxhash64("o", "i")).collect()]
    for n in (0, 1, 7, len(rows) // 2, len(rows) - 1, len(rows), len(rows) + 5):
        assert sorted(r.i for r in SE.first_rows(df, n, "o").collect()) == sorted(ranked[:n]), n


def test_equal_rows(spark):
    """All keys equal, and rows equal in every column: exactly n are taken."""
    same = spark.createDataFrame([(5, i % 4) for i in range(400)], "o long, x long").repartition(7)
    for n in (1, 99, 100, 101, 399):
        got = CL.read_split(same, n, "o")
        assert got.columns == ["o", "x"] and got.count() == n
        marked = SE.mark_first(same, n, "o", "f")
        assert marked.filter("f").count() == n and marked.count() == 400
    split = CL.train_eval_split(same, "o", max_eval=13)
    assert {r.split: r["count"] for r in split.groupBy("split").count().collect()} == {"eval": 13, "train": 387}


def test_split_plans_neither_sort_nor_number(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5000).withColumn("text", F.repeat(F.lit("x"), 50)).write.parquet(path)
    df = spark.read.parquet(path)
    for out in (CL.read_split(df, 100, "id"), CL.train_eval_split(df, "id")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in plan and "Window" not in plan and "Exchange" not in plan and plan.count("FileScan") == 1
    assert "PushedFilters: []" not in CL.read_split(df, 100, "id")._jdf.queryExecution().executedPlan().toString()
    assert [r.id for r in CL.read_split(df, 100, "id").orderBy("id").collect()] == list(range(100))


def test_unordered_type_is_an_error(spark):
    with pytest.raises(TypeError):
        SE.first_rows(spark.createDataFrame([([1],), ([2],)], "o array<int>"), 1, "o")


def linear(values, p):
    return float(np.percentile(np.array(values), 100 * p)) if values else None


@pytest.mark.parametrize("accuracy,small", [(20, 0), (10_000, 0), (10_000, 1000), (10_000, 100_000)])
def test_percentiles_by_brackets(spark, accuracy, small):
    """Coarse sketches (their brackets must be widened where they miss), ties,
    nulls, null groups, tiny groups."""
    rng = random.Random(3)
    rows = [("big", rng.gauss(0, 1), float(rng.randrange(3))) for _ in range(4000)]
    rows += [(None, float(i % 50), None) for i in range(500)] + [("one", 4.0, 4.0), ("two", 1.0, None), ("two", 2.0, None), ("none", None, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(6)
    probs = [0.0, 0.5, 0.9, 1.0]
    got = OR.group_quantiles(df, ["g"], {"x": F.col("x"), "y": F.col("y")}, probs, {"n": F.count("*")}, accuracy, small).collect()
    assert len(got) == 5
    for r in got:
        for c in "xy":
            values = [row["xy".index(c) + 1] for row in rows if row[0] == r.g and row["xy".index(c) + 1] is not None]
            for p in probs:
                assert (r[f"{c}_{p}"] is None) == (not values)
                if values:
                    assert abs(r[f"{c}_{p}"] - linear(values, p)) < 1e-9
        assert r.n == sum(row[0] == r.g for row in rows)
    whole = OR.group_quantiles(df, [], {"x": F.col("x")}, [0.9], accuracy=accuracy, small=small).collect()
    assert len(whole) == 1 and abs(whole[0]["x_0.9"] - linear([r[1] for r in rows if r[1] is not None], 0.9)) < 1e-9
    assert [r["x_0.5"] for r in OR.group_quantiles(df.limit(0), [], {"x": F.col("x")}, [0.5], small=small - 1).collect()] == [None]


def test_few_rows_are_sorted(spark):
    """The window of a percentile sees a few thousandths of the rows."""
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).cast("double").alias("x"))
    seen = []
    real = OR.cut_lineage
    try:
        OR.cut_lineage = lambda d: seen.append(d) or real(d)
        OR.group_quantiles(df, [], {"x": F.col("x")}, [0.5, 0.9], small=1000)
    finally:
        OR.cut_lineage = real
    assert len(seen) == 2 and "Window" not in seen[0]._jdf.queryExecution().toString()


def test_request_prompt_of_the_earliest_time(spark):
    rows = [("a", 1, 30), ("a", 1, 10), ("a", 2, 1), ("a", 3, 2), ("b", 5, 7), ("c", 1, 4), ("c", 1, 2)]
    ev = spark.createDataFrame(rows, "r string, s long, p long").select("r", "p", F.timestamp_seconds("s").alias("ts"))
    got = {r.r: r for r in TE.request_latency(ev, ["r"], input_tokens=F.col("p")).collect()}
    assert set(got) == {"a", "c"} and got["a"].input_tokens == 10 and got["c"].input_tokens == 2
    assert got["a"].time_to_first_token_seconds == 1.0


def test_relative_change_from_zero(spark):
    df = spark.createDataFrame([("m", 0, 0.0), ("m", 1, 0.5), ("n", 0, 0.5), ("n", 1, 1.0), ("z", 0, None), ("z", 1, 1.0)],
                               "g string, k int, v double")
    got = {(r.g, r.k): r.pct_change for r in EV.relative_change(df, ["g"], "k", "v").collect()}
    assert got == {("m", 0): None, ("m", 1): None, ("n", 0): 0.0, ("n", 1): 100.0, ("z", 0): None, ("z", 1): None}


@pytest.mark.parametrize("alpha", [0.0, 1.0])
def test_naive_bayes_without_tokens(spark, alpha):
    """A class without tokens, and no counts at all."""
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, label string")
    td = spark.createDataFrame([(1, "a", "x", 2), (1, "a", "y", 1)], "doc_id long, label string, term string, n long")
    model = CL.nb_fit(td, docs, alpha)
    default = {r.label: r.log_default for r in model["classes"].collect()}
    want = {0.0: {"a": float("-inf"), "b": float("-inf")}, 1.0: {"a": np.log(1 / 5), "b": np.log(1 / 2)}}[alpha]
    assert default == pytest.approx(want)
    got = CL.nb_predict(td.drop("label"), docs, model).collect()
    assert {r.doc_id: r.prediction for r in got} == {1: "a", 2: "a"}
    empty = CL.nb_fit(td.limit(0), docs, alpha)
    assert {r.log_default for r in empty["classes"].collect()} == {float("-inf")} and empty["likelihood"].count() == 0
    assert CL.nb_predict_proba(td.limit(0).drop("label"), docs, empty).count() == 4
