"""Co-occurrence, similarity, TF-IDF, ordering helpers and naive Bayes on
hand-worked fixtures and properties."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from fixtures import TOY_SENTENCES
from pyspark.sql import functions as F

from wordloom.functions.patterns import ENGLISH_STOPWORDS
from wordloom.operators import classify as CL
from wordloom.operators import features as FE
from wordloom.operators import ordering as OR
from wordloom.operators import text as T


def _toy(spark):
    return spark.createDataFrame(list(enumerate(TOY_SENTENCES)), "doc_id long, text string")


def _toy_vocab_tokens(spark):
    """construct_vocabulary (rule tokens, letters only, stop words removed),
    then counting with the default tokenizer restricted to that vocabulary."""
    d = _toy(spark)
    vocab = FE.vocabulary(T.tokenize(d, tokenizer="rule", alpha_only=True),
                          stopwords=ENGLISH_STOPWORDS)
    toks = T.tokenize(d, tokenizer="default").join(vocab.select("term"), "term", "left_semi")
    return d, vocab, toks


def test_toy_cooccurrence_top_pair(spark):
    d, vocab, toks = _toy_vocab_tokens(spark)
    arr = toks.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("pos", "term"))).alias("a"))
    arr = arr.select("doc_id", F.transform("a", lambda x: x["term"]).alias("tokens"))
    co = FE.cooccurrence(arr, window=50, tokens="tokens")
    top = FE.max_cell(co.filter(F.col("t1") < F.col("t2")), "t1", "t2", "n").first()
    assert (top.t1, top.t2, top.n) == ("cold", "warm", 6)
    # symmetric, zero diagonal
    m = {(r.t1, r.t2): r.n for r in co.collect()}
    assert all(m[(b, a)] == n for (a, b), n in m.items())
    assert all(a != b for a, b in m)


def test_toy_document_cosine(spark):
    d, vocab, toks = _toy_vocab_tokens(spark)
    td = FE.term_document(toks).withColumnRenamed("n", "w")
    pairs = spark.createDataFrame([("cold", "warm"), ("cold", "zzz")], "w1 string, w2 string")
    got = {(r.w1, r.w2): r.similarity for r in FE.pair_similarity(td, pairs).collect()}
    assert abs(got[("cold", "warm")] - 6 / math.sqrt(56)) < 1e-12
    assert got[("cold", "zzz")] is None
    ranked = FE.rank_by_similarity(td, "cold").collect()
    assert {r.term for r in ranked} == {r.term for r in vocab.collect()} - {"cold"}
    top = FE.find_similar_words(td, "cold", 1).first()
    assert top.term == "warm" and abs(top.similarity - 6 / math.sqrt(56)) < 1e-12


def test_tfidf_unit_rows_and_formula(spark):
    d = _toy(spark)
    td = FE.doc_term_counts(d)
    tf = FE.tfidf(td, d).toPandas()
    norms = tf.groupby("doc_id")["tfidf"].apply(lambda s: float(np.sqrt((s ** 2).sum())))
    assert np.allclose(norms.values, 1.0)
    # formula check against numpy on the same counts
    tdp = td.toPandas()
    dfreq = tdp.groupby("term")["doc_id"].nunique()
    w = tdp.assign(w=tdp.n * (np.log((1 + 10) / (1 + tdp.term.map(dfreq))) + 1))
    w["w"] = w.w / w.groupby("doc_id").w.transform(lambda s: np.sqrt((s ** 2).sum()))
    j = tf.merge(w, on=["doc_id", "term"])
    assert np.allclose(j.tfidf, j.w)


def test_dense_index_and_average_rank(spark):
    vals = [random.Random(7).randint(0, 30) for _ in range(200)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v long")
    idx = OR.dense_index(df.select("v").distinct(), ["v"]).toPandas().sort_values("v")
    assert list(idx.idx) == list(range(len(idx)))
    r = OR.average_rank(df, "v", "r").toPandas().sort_values("id")
    assert np.allclose(r.r.values, pd.Series(vals).rank(method="average").values)


def _nb_fixture(spark):
    train = [(1, "a", "x", 2), (1, "a", "y", 1), (2, "b", "y", 3), (2, "b", "z", 1), (3, "a", "x", 1)]
    td = spark.createDataFrame(train, "doc_id long, label string, term string, n long")
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id long, label string")
    test = spark.createDataFrame([(10, "x", 1), (11, "z", 2), (12, "q", 1), (13, "x", 1), (13, "z", 1)],
                                 "doc_id long, term string, n long")
    tdocs = spark.createDataFrame([(10,), (11,), (12,), (13,), (14,)], "doc_id long")
    return td, docs, test, tdocs


def _numpy_nb(alpha):
    vocab = ["x", "y", "z"]
    counts = {"a": np.array([3, 1, 0.0]), "b": np.array([0, 3, 1.0])}
    prior = {"a": 2 / 3, "b": 1 / 3}
    X = {10: [1, 0, 0], 11: [0, 0, 2], 12: [0, 0, 0], 13: [1, 0, 1], 14: [0, 0, 0]}
    out = {}
    for d, x in X.items():
        x = np.array(x, dtype=float)
        for c in "ab":
            lik = (counts[c] + alpha) / (counts[c].sum() + alpha * len(vocab))
            with np.errstate(divide="ignore"):
                ll = np.log(lik)
            s = math.log(prior[c]) + sum(xi * li for xi, li in zip(x, ll) if xi > 0)
            out[(d, c)] = s
    return out


def test_naive_bayes_matches_numpy(spark):
    td, docs, test, tdocs = _nb_fixture(spark)
    for alpha in (1.0, 0.5):
        m = CL.nb_fit(td, docs, alpha)
        p = CL.nb_predict_proba(test, tdocs, m).toPandas()
        ref = _numpy_nb(alpha)
        for r in p.itertuples():
            assert abs(r.log_score - ref[(r.doc_id, r.label)]) < 1e-9
        sums = p.groupby("doc_id").prob.sum()
        assert np.allclose(sums.values, 1.0)
    # document 12 has only an unknown term, 14 has none: both keep the prior
    pred = {r.doc_id: r.prediction for r in CL.nb_predict(test, tdocs, CL.nb_fit(td, docs, 1.0)).collect()}
    assert pred[12] == "a" and pred[14] == "a"


def test_naive_bayes_zero_smoothing(spark):
    td, docs, test, tdocs = _nb_fixture(spark)
    m = CL.nb_fit(td, docs, 0.0)
    p = {(r.doc_id, r.label): (r.log_score, r.prob) for r in CL.nb_predict_proba(test, tdocs, m).collect()}
    # x never seen in b: -inf for b, a wins with probability 1
    assert p[(10, "b")][0] == float("-inf") and p[(10, "a")][1] == 1.0
    # doc 13 holds x (never in b) and z (never in a): both -inf, probabilities null
    assert p[(13, "a")][0] == float("-inf") and p[(13, "a")][1] is None
    pred = {r.doc_id: r.prediction for r in CL.nb_predict(test, tdocs, m).collect()}
    assert pred[13] == "a"  # ties go to the smallest class


def test_metrics_and_split(spark):
    df = spark.createDataFrame([(1, "a", "a"), (2, "a", "b"), (3, "b", "b"), (4, "c", "b")],
                               "id long, prediction string, label string")
    assert CL.accuracy(df).first().accuracy == 0.5
    f1 = {r.cls: (r.precision, r.recall, r.f1) for r in CL.classification_f1(df).collect()}
    assert f1["a"] == (0.5, 1.0, 2 * 0.5 / 1.5)
    assert f1["c"] == (0.0, 0.0, 0.0)
    docs = spark.range(57).withColumnRenamed("id", "doc_id")
    s = CL.train_eval_split(docs, "doc_id").toPandas()
    ev = set(s[s.split == "eval"].doc_id)
    assert ev == set(range(5)) and len(s) == 57
    assert not ev & set(s[s.split == "train"].doc_id)


def test_split_keeps_rows_with_equal_order(spark):
    df = spark.createDataFrame([(i // 4, i) for i in range(40)], "o long, x long")
    got = CL.train_eval_split(df, "o").collect()
    assert len(got) == 40 and sum(r.split == "eval" for r in got) == 4
    assert CL.read_split(df, 7, "o").count() == 7


def test_sentence_cooccurrence(spark):
    import pytest
    from wordloom.operators import features as FE
    df = spark.createDataFrame([(1, "aa bb aa. bb cc!\naa"), (2, None), (3, "")], "doc_id long, text string")
    got = {(r.t1, r.t2): r.n for r in FE.sentence_cooccurrence(df).collect()}
    assert got == {("aa", "bb"): 2, ("bb", "aa"): 2, ("bb", "cc"): 1, ("cc", "bb"): 1}
    with pytest.raises(ValueError):
        FE.cooccurrence(df, 10**9)


@pytest.mark.parametrize("block_terms", [1, 3, 512])
def test_context_cooccurrence(spark, block_terms):
    """Blocks of any size give the plain sums; nulls are left out; the focus
    keeps the pairs of its terms."""
    from collections import Counter
    import random
    from wordloom.operators import features as FE
    rng = random.Random(block_terms)
    rows = [(d, f"t{t}", rng.randrange(1, 5)) for d in range(12) for t in rng.sample(range(30), rng.randrange(0, 25))]
    td = spark.createDataFrame(rows + [(None, "t1", 9), (1, None, 9), (50, "lone", 3)], "doc_id long, term string, n long").repartition(4)
    want = Counter()
    for d, t, n in rows:
        for e, u, m in rows:
            if d == e and t != u:
                want[t, u] += n * m
    got = [(r.t1, r.t2, r.n) for r in FE.context_cooccurrence(td, block_terms=block_terms).collect()]
    assert Counter({(a, b): n for a, b, n in got}) == want and len(got) == len(want)
    focus = spark.createDataFrame([("t3",), ("t7",), ("t7",), ("none",)], "term string")
    got = [(r.t1, r.t2, r.n) for r in FE.context_cooccurrence(td, focus=focus, block_terms=block_terms).collect()]
    assert sorted(got) == sorted((a, b, n) for (a, b), n in want.items() if a in ("t3", "t7"))
    assert FE.context_cooccurrence(td.limit(0)).count() == 0


def test_long_contexts(spark):
    """A document of 50,000 different terms is many rows of two blocks."""
    from wordloom.operators import features as FE
    long = spark.range(50_000).select(F.lit(1).alias("doc_id"), F.format_string("w%05d", "id").alias("term"), (F.col("id") % 3 + 1).alias("n"))
    focus = spark.createDataFrame([("w00000",), ("w00001",)], "term string")
    got = FE.context_cooccurrence(long, focus=focus).groupBy("t1").agg(F.count("*").alias("k"), F.sum("n").alias("s")).collect()
    total = sum(i % 3 + 1 for i in range(50_000))
    assert {(r.t1, r.k, r.s) for r in got} == {("w00000", 49_999, total - 1), ("w00001", 49_999, 2 * (total - 2))}
    text = spark.range(1).select(F.lit(1).alias("doc_id"), F.concat_ws(" ", F.transform(
        F.sequence(F.lit(0), F.lit(49_999)), lambda i: F.format_string("w%d", i % 700))).alias("text"))
    assert FE.sentence_cooccurrence(text).count() == 700 * 699


def test_normalised_vocabulary_order(spark):
    """Normalised first, then stop words: a word whose lemma is a stop word goes."""
    from wordloom.operators import features as FE
    df = spark.createDataFrame([(1, "Words were here, word. THE cats")], "doc_id long, text string")
    lem = spark.createDataFrame([("words", "word"), ("cats", "the"), ("words", "zword")], "word string, lemma string")
    got = [r.term for r in FE.vocabulary_from_text(df, "lemma", lem).orderBy("idx").collect()]
    assert got == ["word"]
    kept = {r.term for r in FE.vocabulary_from_text(df, "none", None, lowercase=False, stopwords=None).collect()}
    assert kept == {"Words", "were", "here", "word", "THE", "cats"}
