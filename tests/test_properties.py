"""Randomised properties: the Spark patterns agree with Python's ``re`` (the
reference's engine) on generated strings, and stop-word removal partitions
the tokens."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from wordloom.functions import patterns as P
from wordloom.operators import text as T

ALPHABET = list("aeiouAEIOUbcdkst") + list(" .,;:!?()'\"-\t\n") + ["é", "ü", "ñ", "٣", "7", "_", "😂"]
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=60), min_size=20, max_size=40)


def _group(rows, col):
    out = {}
    for r in rows:
        out.setdefault(r["doc_id"], []).append(r)
    return {k: [x[col] for x in sorted(v, key=lambda x: x["pos"] if "pos" in x else 0)]
            for k, v in out.items()}


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(TEXTS)
def test_tokenizers_and_patterns_agree_with_python(spark, texts):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rule = _group(T.tokenize_rule(d).collect(), "term")
    word = _group(T.tokenize(d, tokenizer="word").collect(), "term")
    dflt = _group(T.tokenize(d, tokenizer="default").collect(), "term")
    r1 = _group(T.vowel_cluster_words(d).collect(), "word")
    r2 = _group(T.elongated_words(d, min_run=2).collect(), "word")
    runs = {r.doc_id: (r.normalized, r.n_runs) for r in T.collapse_runs(d, min_run=2).collect()}
    two = re.compile(r"(?i)\b\w*([aeiou])(\1{1,})\w*\b")
    for i, t in enumerate(texts):
        low = t.lower()
        assert rule.get(i, []) == re.findall(P.RULE_TOKEN, low)
        assert word.get(i, []) == re.findall(P.WORD_TOKEN, low)
        assert dflt.get(i, []) == re.findall(P.DEFAULT_TOKEN, low)
        assert sorted(r1.get(i, [])) == sorted(m.group() for m in re.finditer(P.VOWEL_CLUSTER, t))
        assert sorted(r2.get(i, [])) == sorted(m.group() for m in two.finditer(t))
        assert runs[i] == re.compile(r"(?i)([aeiou])\1{1,}").subn(r"\1", t)


def test_stopwords_partition_tokens(spark):
    d = spark.createDataFrame([(0, "The cat and the hat, it is what it is."), (1, "nothing but words")],
                              "doc_id long, text string")
    toks = T.tokenize(d, tokenizer="word")
    kept = T.remove_stopwords(toks)
    dropped = toks.join(kept.select("doc_id", "pos"), ["doc_id", "pos"], "left_anti")
    assert kept.count() + dropped.count() == toks.count()
    assert all(r.term in P.ENGLISH_STOPWORDS for r in dropped.collect())
