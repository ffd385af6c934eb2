"""Registered queries: tokenisers, regex mining, normalisation, counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import patterns as P
from ..operators import text as T
from ..session import table
from . import fixtures as FX
from .registry import query, r5, r6

LEN2 = P.re2_elongated(2)
R1_RE2 = P.re2_vowel_cluster()
RUN2_RE2 = P.re2_vowel_run(2)


def _docs(spark, sf):
    return table(spark, sf, "documents")


@query("tokenize_word", f"""
SELECT doc_id, CAST(generate_subscripts(t, 1) - 1 AS INTEGER) AS pos, unnest(t) AS term
FROM (SELECT doc_id, {r5()} AS t FROM documents)""")
def q_tokenize_word(spark, sf):
    return T.tokenize_word(_docs(spark, sf), "text", "doc_id", "word")


@query("tokenize_rule", """
SELECT doc_id, CAST(generate_subscripts(t, 1) - 1 AS INTEGER) AS pos,
       regexp_replace(unnest(t), '\\s$', '') AS term
FROM (SELECT doc_id, regexp_extract_all(lower(text),
        '[a-zA-Z]+(?:\\.[a-zA-Z]+)*|\\p{Nd}+|[.!?,:;()"'']\\s') AS t FROM documents)""")
def q_tokenize_rule(spark, sf):
    return T.tokenize_rule(_docs(spark, sf), "text", "doc_id")


@query("tokenizer_report", f"""
WITH t AS (
  SELECT 'word' AS tokenizer, unnest({r5()}) AS term FROM documents
  UNION ALL
  SELECT 'default', unnest({r6()}) FROM documents
  UNION ALL
  SELECT 'rule', regexp_replace(unnest(regexp_extract_all(lower(text),
        '[a-zA-Z]+(?:\\.[a-zA-Z]+)*|\\p{{Nd}}+|[.!?,:;()"'']\\s')), '\\s$', '') FROM documents)
SELECT tokenizer, count(*) AS n_tokens, count(DISTINCT term) AS n_terms FROM t GROUP BY tokenizer""")
def q_tokenizer_report(spark, sf):
    return T.tokenizer_report(_docs(spark, sf), "text",
                              {"word": "word", "default": "default", "rule": "rule"})


@query("ngrams", f"""
WITH t AS (SELECT doc_id, {r6()} AS tok FROM documents),
g AS (
  SELECT doc_id, 2 AS n, array_to_string(tok[i:i+1], ' ') AS term
  FROM t, range(1, CAST(len(tok) AS BIGINT)) r(i)
  UNION ALL
  SELECT doc_id, 3, array_to_string(tok[i:i+2], ' ')
  FROM t, range(1, CAST(len(tok) AS BIGINT) - 1) r(i))
SELECT n, term, count(*) AS cnt FROM g GROUP BY n, term""")
def q_ngrams(spark, sf):
    # a trigram holds a bigram: both are counted from the same rows
    return T.ngram_counts(T.token_arrays(_docs(spark, sf), "text", "tokens", "default"), 3, about=F.length("text") / 6)


@query("term_counts", f"""
SELECT term, count(*) AS n FROM (SELECT unnest({r6()}) AS term FROM documents) GROUP BY term""")
def q_term_counts(spark, sf):
    return T.term_counts(T.tokenize(_docs(spark, sf), "text", "doc_id", "default"))


@query("top_words_per_group", f"""
WITH c AS (SELECT lang, term, count(*) AS n
           FROM (SELECT lang, unnest({r6()}) AS term FROM documents) GROUP BY lang, term)
SELECT lang, term, n, CAST(rk AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, term) AS rk FROM c)
WHERE rk <= 3""")
def q_top_words_per_group(spark, sf):
    toks = T.tokenize(_docs(spark, sf), "text", "doc_id", "default", keep=["lang"])
    return T.top_words_per_group(T.grouped_term_counts(toks, ["lang"]), ["lang"], 3)


@query("elongated_words", f"""
SELECT doc_id, unnest(regexp_extract_all(text, '{LEN2}')) AS word FROM documents""")
def q_elongated_words(spark, sf):
    return T.elongated_words(_docs(spark, sf), "text", "doc_id", min_run=2)


@query("vowel_cluster_words", f"""
SELECT doc_id, unnest(regexp_extract_all(text, '{R1_RE2}')) AS word FROM documents""")
def q_vowel_cluster_words(spark, sf):
    return T.vowel_cluster_words(_docs(spark, sf), "text", "doc_id")


_CANON_SQL = " ".join(
    f"WHEN '{v}' THEN regexp_replace(w, '{RUN2_RE2}', '{v}', 'g')" for v in P.VOWELS)


@query("canonical_word", f"""
WITH m AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '{LEN2}'))) AS w FROM documents),
v AS (SELECT w, substr(regexp_extract(w, '{RUN2_RE2}', 1), 1, 1) AS vowel FROM m)
SELECT w AS word, vowel, CASE vowel {_CANON_SQL} END AS canonical FROM v""")
def q_canonical_word(spark, sf):
    words = (T.elongated_words(_docs(spark, sf), "text", "doc_id", min_run=2)
             .select(F.lower("word").alias("word")).distinct())
    return T.with_canonical(words, "word", min_run=2)


_COLLAPSE_SQL = "text"
for _v in P.VOWELS:
    _COLLAPSE_SQL = f"regexp_replace({_COLLAPSE_SQL}, '(?i)({_v}){_v}+', '\\1', 'g')"


@query("collapse_runs", f"""
SELECT doc_id, {_COLLAPSE_SQL} AS normalized,
       CAST(len(regexp_extract_all(text, '{RUN2_RE2}')) AS BIGINT) AS n_runs
FROM documents""")
def q_collapse_runs(spark, sf):
    return T.collapse_runs(_docs(spark, sf), "text", min_run=2).select(
        "doc_id", "normalized", "n_runs")


_GROUP_SQL = ("CASE WHEN regexp_matches(source, '^src1[0-9]$') THEN 'teen' "
              "WHEN regexp_matches(source, '^src[02468]$') THEN 'even' END")


@query("label_from_filename", f"""
SELECT doc_id, source, {_GROUP_SQL} AS label FROM documents
WHERE {_GROUP_SQL} IS NOT NULL""")
def q_label_from_filename(spark, sf):
    return T.label_from_filename(_docs(spark, sf), FX.SOURCE_RULES, name="source").select(
        "doc_id", "source", "label")


@query("grouped_term_counts", f"""
WITH m AS (SELECT {_GROUP_SQL} AS grp, lower(unnest(regexp_extract_all(text, '{LEN2}'))) AS w
           FROM documents),
v AS (SELECT grp, w, substr(regexp_extract(w, '{RUN2_RE2}', 1), 1, 1) AS vowel FROM m
      WHERE grp IS NOT NULL)
SELECT grp AS "group", vowel, CASE vowel {_CANON_SQL} END AS canonical, count(*) AS n
FROM v GROUP BY ALL""")
def q_grouped_term_counts(spark, sf):
    d = T.label_from_filename(_docs(spark, sf), FX.SOURCE_RULES, name="source", out="group")
    m = T.with_canonical(T.elongated_words(d, "text", "doc_id", 2, keep=["group"]), "word", 2)
    return T.grouped_term_counts(m, ["group", "vowel"], "canonical")


@query("top_words_per_vowel", f"""
WITH m AS (SELECT lower(unnest(regexp_extract_all(text, '{LEN2}'))) AS w FROM documents),
v AS (SELECT substr(regexp_extract(w, '{RUN2_RE2}', 1), 1, 1) AS vowel, w FROM m),
c AS (SELECT vowel, CASE vowel {_CANON_SQL} END AS canonical, count(*) AS n FROM v GROUP BY ALL)
SELECT vowel, canonical, n, CAST(rk AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY vowel ORDER BY n DESC, canonical) AS rk FROM c)
WHERE rk <= 3""")
def q_top_words_per_vowel(spark, sf):
    m = T.with_canonical(T.elongated_words(_docs(spark, sf), "text", "doc_id", 2), "word", 2)
    c = T.grouped_term_counts(m, ["vowel"], "canonical")
    return T.top_words_per_group(c, ["vowel"], 3, term="canonical")


@query("match_totals", f"""
SELECT 'R1' AS pattern, count(*) AS n_matches
FROM (SELECT unnest(regexp_extract_all(text, '{R1_RE2}')) FROM documents)
UNION ALL
SELECT 'R2', count(*) FROM (SELECT unnest(regexp_extract_all(text, '{LEN2}')) FROM documents)""")
def q_match_totals(spark, sf):
    # one scan: both patterns' matches are labelled arms of each document
    d = _docs(spark, sf)
    arms = F.array(*[F.struct(F.lit(name).alias("pattern"),
                              F.regexp_extract_all("text", F.lit(pat), 0).alias("m"))
                     for name, pat in (("R1", P.vowel_cluster()), ("R2", P.elongated(2)))])
    long = C.explode_rows(d, [], arms, "a").select("a.pattern", "a.m")
    return T.match_totals(C.explode_rows(long, ["pattern"], F.col("m"), "word"), "pattern")


@query("symmetric_difference", f"""
WITH a AS (SELECT w AS word, count(*) AS n FROM
             (SELECT unnest(regexp_extract_all(text, '{R1_RE2}')) AS w FROM documents) GROUP BY w),
b AS (SELECT DISTINCT unnest(regexp_extract_all(text, '{LEN2}')) AS word FROM documents)
SELECT coalesce(a.word, b.word) AS word, CAST(coalesce(a.n, 0) AS BIGINT) AS n_first,
       a.word IS NOT NULL AS in_first
FROM a FULL OUTER JOIN b ON a.word = b.word WHERE a.word IS NULL OR b.word IS NULL""")
def q_symmetric_difference(spark, sf):
    d = _docs(spark, sf)
    a = T.term_counts(T.vowel_cluster_words(d), "word")
    b = T.term_counts(T.elongated_words(d, min_run=2), "word")
    return T.symmetric_difference(a, b, "word")


@query("remove_stopwords", f"""
SELECT doc_id, pos, term FROM (
  SELECT doc_id, CAST(generate_subscripts(t, 1) - 1 AS INTEGER) AS pos, unnest(t) AS term
  FROM (SELECT doc_id, {r6()} AS t FROM documents))
WHERE term NOT IN ({FX.stopword_sql_list()})""")
def q_remove_stopwords(spark, sf):
    return T.remove_stopwords(T.tokenize(_docs(spark, sf), "text", "doc_id", "default"))


@query("normalize_terms", f"""
WITH t AS (SELECT unnest({r6()}) AS term FROM documents),
l AS (SELECT DISTINCT word, lemma FROM {FX.lemma_sql_values()})
SELECT coalesce(l.lemma, t.term) AS term, count(*) AS n
FROM t LEFT JOIN l ON t.term = l.word GROUP BY 1""")
def q_normalize_terms(spark, sf):
    toks = T.tokenize(_docs(spark, sf), "text", "doc_id", "default")
    lem = FX.lemma_df(spark).select("word", "lemma")
    return T.normalize_counts(T.term_counts(toks), lem, "lemma")


@query("normalize_terms_class", f"""
WITH t AS (SELECT unnest({r6()}) AS term FROM documents),
g AS (SELECT term, CASE length(term) % 4 WHEN 0 THEN 'JJR' WHEN 1 THEN 'VBD' WHEN 2 THEN 'RB' ELSE 'DT' END AS tag FROM t),
k AS (SELECT term, CASE WHEN tag LIKE 'J%' THEN 'a' WHEN tag LIKE 'V%' THEN 'v' WHEN tag LIKE 'R%' THEN 'r' ELSE 'n' END AS cat FROM g),
l AS (SELECT word, cat, min(lemma) AS lemma FROM {FX.lemma_sql_values()} GROUP BY ALL)
SELECT coalesce(l.lemma, k.term) AS term, k.cat, count(*) AS n
FROM k LEFT JOIN l ON l.word = k.term AND l.cat = k.cat GROUP BY ALL""")
def q_normalize_terms_class(spark, sf):
    """Lemma by (word, class); the class comes from a part-of-speech tag
    (fixture rule: the word's length)."""
    toks = T.tokenize(_docs(spark, sf), "text", "doc_id", "default")
    n = F.length("term") % 4
    tag = F.when(n == 0, "JJR").when(n == 1, "VBD").when(n == 2, "RB").otherwise("DT")
    counts = toks.select("term", C.wordnet_class(tag).alias("cat")).groupBy("term", "cat").agg(F.count("*").alias("n"))
    found = T.normalize_terms(counts, FX.lemma_df(spark), "lemma", cat="cat")
    return found.groupBy("term", "cat").agg(F.sum("n").alias("n"))


@query("lemma_summary", f"""
WITH t AS (SELECT DISTINCT unnest({r6()}) AS term FROM documents),
l AS (SELECT DISTINCT word, lemma FROM {FX.lemma_sql_values()})
SELECT count(*) AS n_words, count(DISTINCT coalesce(l.lemma, t.term)) AS n_lemmas
FROM t LEFT JOIN l ON t.term = l.word""")
def q_lemma_summary(spark, sf):
    words = T.tokenize(_docs(spark, sf), "text", "doc_id", "default").select("term").distinct()
    lem = FX.lemma_df(spark).select("word", "lemma")
    return T.lemma_summary(T.normalize_terms(words, lem, "lemma", out="lemma"), "term", "lemma")
