"""Plans and results of the steps that were made to scale: where rows are
shuffled, which pairs are made, and the same results by the plain way."""

from pyspark.sql import functions as F

from wordloom.operators import features as FE


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def docs(spark):
    rows = [(1, "red red blue green"), (2, "red blue"), (3, None), (4, "green green lone"), (5, "")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_texts_are_shuffled_not_their_tokens(spark):
    td = FE.doc_term_counts(docs(spark))
    lines = plan(td).splitlines()
    exchanges = [i for i, x in enumerate(lines) if "Exchange" in x]
    assert len(exchanges) == 1 and exchanges[0] > max(i for i, x in enumerate(lines) if "Generate" in x)
    again = FE.doc_term_counts(docs(spark).union(docs(spark)))  # rows of one id are one document
    assert {(r.doc_id, r.term): 2 * r.n for r in td.collect()} == {(r.doc_id, r.term): r.n for r in again.collect()}


def test_tfidf_with_few_frequent_terms(spark, monkeypatch):
    d = docs(spark)
    whole = {(r.doc_id, r.term): r.tfidf for r in FE.tfidf(FE.doc_term_counts(d), d).collect()}
    monkeypatch.setattr(FE, "FREQUENT_TERMS", 1)  # most terms are rare ones
    split = {(r.doc_id, r.term): r.tfidf for r in FE.tfidf(FE.doc_term_counts(d), d).collect()}
    assert split == whole and len(whole) == 7


def test_rank_reads_weights_once(spark):
    d = docs(spark)
    w = FE.tfidf(FE.doc_term_counts(d), d).withColumnRenamed("tfidf", "w")
    r = FE.rank_by_similarity(w, "red")
    assert "Join" not in plan(r) and "Window" not in plan(r)
    assert {x.term: x.similarity == 0 for x in r.collect()} == {"blue": False, "green": False, "lone": True}


def test_focus_makes_no_other_pairs(spark):
    d = docs(spark)
    td = FE.doc_term_counts(d)
    focus = spark.createDataFrame([("red",)], "term string")
    got = FE.context_cooccurrence(td, focus=focus)
    assert "Generate" not in plan(got)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, FE.context_cooccurrence(td).filter(F.col("t1") == "red").collect()))
