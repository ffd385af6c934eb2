"""Tokenisers and regex mining against Python's ``re`` (the reference's
engine) on hand-made strings, plus the stated elongation examples."""

import re

import pytest
from fixtures import TOKENIZER_SAMPLES
from pyspark.sql import functions as F

from wordloom.functions import patterns as P
from wordloom.operators import text as T

EXTRA = ["SOooo gooood aaE xx", "Héllo wörld naïve café", "Coool, reaaally ooo!", "",
         "a. b, (c) 'd' \"e\" 12 ٣٤ x.y.z"]


def _docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def _by_doc(df, col):
    out = {}
    for r in df.orderBy("doc_id", "pos" if "pos" in df.columns else col).collect():
        out.setdefault(r["doc_id"], []).append(r[col])
    return out


def test_rule_tokenizer_matches_python(spark):
    texts = TOKENIZER_SAMPLES + EXTRA
    got = _by_doc(T.tokenize_rule(_docs(spark, texts)), "term")
    for i, t in enumerate(texts):
        assert got.get(i, []) == re.findall(P.RULE_TOKEN, t.lower()), t


@pytest.mark.parametrize("tok,pattern", [("word", P.WORD_TOKEN), ("default", P.DEFAULT_TOKEN)])
def test_word_tokenizers_match_python(spark, tok, pattern):
    texts = TOKENIZER_SAMPLES + EXTRA
    got = _by_doc(T.tokenize(_docs(spark, texts), tokenizer=tok), "term")
    for i, t in enumerate(texts):
        assert got.get(i, []) == re.findall(pattern, t.lower()), t


def test_elongation_patterns_match_python(spark):
    texts = EXTRA + TOKENIZER_SAMPLES
    d = _docs(spark, texts)
    r1 = {}
    for r in T.vowel_cluster_words(d).collect():
        r1.setdefault(r.doc_id, []).append(r.word)
    r2 = {}
    for r in T.elongated_words(d, min_run=3).collect():
        r2.setdefault(r.doc_id, []).append(r.word)
    for i, t in enumerate(texts):
        assert sorted(r1.get(i, [])) == sorted(m.group() for m in re.finditer(P.VOWEL_CLUSTER, t))
        assert sorted(r2.get(i, [])) == sorted(m.group() for m in re.finditer(P.ELONGATED, t))
    assert sorted(r1[0]) == sorted(["SOooo", "gooood", "aaE"])


def test_collapse_and_canonical(spark):
    d = _docs(spark, ["SOooo gOOood", "reaaally cooool", "plain"])
    c = {r.doc_id: (r.normalized, r.n_runs) for r in T.collapse_runs(d).collect()}
    assert c[0] == ("SO gOd", 2)
    assert c[2] == ("plain", 0)
    for i, t in enumerate(["SOooo gOOood", "reaaally cooool"]):
        expect, n = re.compile(P.VOWEL_RUN).subn(r"\1", t)
        assert c[i] == (expect, n)
    w = spark.createDataFrame([("gooood",), ("bOOOkeeee",)], "word string")
    got = {r.word: (r.vowel, r.canonical) for r in T.with_canonical(w).collect()}
    # every run takes the first run's vowel (the reference's behaviour)
    assert got["gooood"] == ("o", "god")
    assert got["bOOOkeeee"] == ("o", "boko")


def test_top_words_and_ties(spark):
    rows = [("a", "x", 3), ("a", "y", 3), ("a", "z", 1), ("a", "w", 3), ("b", "q", 2)]
    c = spark.createDataFrame(rows, "g string, term string, n long")
    got = [(r.g, r.term, r.rank) for r in T.top_words_per_group(c, ["g"], 2).orderBy("g", "rank").collect()]
    assert got == [("a", "w", 1), ("a", "x", 2), ("b", "q", 1)]


def test_normalize_and_stopwords(spark):
    toks = spark.createDataFrame([(1, 0, "the"), (1, 1, "words"), (1, 2, "ran"), (1, 3, "ran")],
                                 "doc_id long, pos int, term string")
    lem = spark.createDataFrame([("words", "word"), ("ran", "run")], "word string, lemma string")
    n = [r.term for r in T.normalize_terms(toks, lem, "lemma").orderBy("pos").collect()]
    assert n == ["the", "word", "run", "run"]
    with pytest.raises(ValueError):
        T.normalize_terms(toks, lem, "lematization")
    kept = [r.term for r in T.remove_stopwords(toks).orderBy("pos").collect()]
    assert kept == ["words", "ran", "ran"]  # duplicates of kept words stay


def test_label_from_filename(spark):
    df = spark.createDataFrame([("/x/P-train1.txt",), ("/x/N-train1.txt",), ("/P-dir/other.txt",)],
                               "path string")
    got = {r.path: r.label for r in T.label_from_filename(df, [(r"^P-", "Pos")], default="Neg").collect()}
    assert got == {"/x/P-train1.txt": "Pos", "/x/N-train1.txt": "Neg", "/P-dir/other.txt": "Neg"}
    authors = spark.createDataFrame([("f1.txt",), ("m2.txt",), ("x3.txt",)], "path string")
    kept = T.label_from_filename(authors, [(r"^[fF]", "f"), (r"^[mM]", "m")])
    assert sorted(r.label for r in kept.collect()) == ["f", "m"]


def test_symmetric_difference(spark):
    a = spark.createDataFrame([("x", 2), ("y", 1)], "word string, n long")
    b = spark.createDataFrame([("y", 5), ("z", 1)], "word string, n long")
    got = {r.word: (r.n_first, r.in_first) for r in T.symmetric_difference(a, b).collect()}
    assert got == {"x": (2, True), "z": (0, False)}
