"""N-grams are counted per class where they are made, and dealt once (finding F1)."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from wordloom.operators import classify as CL
from wordloom.operators import pairs
from wordloom.operators import text as T
from wordloom.plans import q_classify as Q

ROWS = [("x", ["a", "b", "c", "a", "b"], ["A", "b"]), (None, ["a", "b"], ["A"]), ("y", ["a"], ["B", "B"]), ("x", [], None),
        ("y", None, []), ("y", ["b", "c", "a"], ["é"]), ("x", ["a", "b", "c"], ["b"])]
ARMS = [pairs.Arm("low", 3, "low 2", "low 3"), pairs.Arm("low", 1, "low 1"), pairs.Arm("cased", 2, "cased 1", "cased 2")]


@pytest.mark.parametrize("batch", [1, 4, 10**6])
@pytest.mark.parametrize("deal", [None, 3])
def test_counts_per_group_and_length(spark, monkeypatch, batch, deal):
    monkeypatch.setattr(pairs, "BATCH_TERMS", batch)
    want = Counter((g, f"{c} {k}", " ".join(t[i:i + k])) for g, *both in ROWS for c, t, ks in zip(("low", "cased"), both, ((1, 2, 3), (1, 2)))
                   for k in ks for i in range(len(t or []) - k + 1))
    df = spark.createDataFrame(ROWS, "label string, low array<string>, cased array<string>").coalesce(2)
    got = Counter()
    for r in T.ngram_counts_by(df, "label", ARMS, deal).collect():
        got[r.label, r.view, r.t1 + (" " + r.t2 if r.t2 else "")] += r.cnt
    assert got == want


def test_pieces_hold_a_bounded_number_of_terms(spark, monkeypatch):
    monkeypatch.setattr(pairs, "BATCH_TERMS", 100)
    batches = spark.range(500).select(F.array_repeat(F.lit("w"), 7).alias("t")).coalesce(1).toArrow().to_batches()
    held = list(pairs._pieces(iter(batches), ["t"]))
    assert all(sum(len(b) for b in h) <= 15 for h in held) and sum(len(b) for h in held for b in h) == 500


def test_dealt_terms_are_not_shuffled_again(spark):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("label"))
    rows = docs.withColumn("s", F.lit("all")).withColumn("n", F.lit(1).cast("long")).withColumn(
        "t1", F.concat(F.lit("w"), (F.col("doc_id") % 7).cast("string"))).withColumn("t2", F.lit(""))
    dealt = rows.repartition(3, "t1")
    by, term = ["s"], ["t1", "t2"]
    all_docs = docs.withColumn("s", F.lit("all"))
    model = CL.nb_fit(dealt.drop("doc_id"), all_docs, 1.0, term=term, by=by)
    assert {r.n_terms for r in model["classes"].collect()} == {7} and model["vocab"].count() == 7
    proba = CL.nb_predict_proba(dealt.drop("label"), all_docs, model, term=term, by=by)
    lines = proba._jdf.queryExecution().executedPlan().toString().splitlines()
    assert not [x for x in lines if "Exchange" in x and "t1#" in x and "REPARTITION_BY_NUM" not in x]
    one = rows.select("label", "doc_id", F.col("t1").alias("term"), "n")
    plain = CL.nb_predict_proba(one.drop("label"), docs, CL.nb_fit(one, docs, 1.0))
    assert ({(r.doc_id, r.label): round(r.log_score, 9) for r in proba.collect()}
            == {(r.doc_id, r.label): round(r.log_score, 9) for r in plain.collect()})


def test_experiment_writes_only_the_test_counts(spark, monkeypatch):
    seen = []

    def keep(df, own=Q.cut_lineage):
        seen.append(df.columns)
        return own(df)

    monkeypatch.setattr(Q, "cut_lineage", keep)
    Q.q_nb_experiment(spark, "/root/testdata/sf0.001")
    assert seen == [["doc_id", "view", "t1", "t2", "cnt"]]
