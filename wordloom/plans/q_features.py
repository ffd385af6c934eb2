"""Registered queries: vocabulary, term-document counts, TF-IDF,
co-occurrence and similarity."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.patterns import ENGLISH_STOPWORDS
from ..operators import features as FE
from ..operators import text as T
from ..session import cut_lineage, table
from . import fixtures as FX
from .registry import query, r6

_TD = f"""td AS (SELECT doc_id, term, count(*) AS n
       FROM (SELECT doc_id, unnest({r6()}) AS term FROM documents) GROUP BY doc_id, term)"""
_TFIDF = _TD + """,
nd AS (SELECT count(*) AS n FROM documents),
dfq AS (SELECT term, count(*) AS df FROM td GROUP BY term),
w0 AS (SELECT td.doc_id, td.term, td.n * (ln((1.0 + nd.n) / (1.0 + dfq.df)) + 1.0) AS w
       FROM td JOIN dfq USING (term), nd),
nr AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w0 GROUP BY doc_id),
tf AS (SELECT w0.doc_id, w0.term, w0.w / nr.norm AS w FROM w0 JOIN nr USING (doc_id))"""
_TARGET = """(SELECT term FROM (SELECT term, count(*) AS c FROM
     (SELECT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS term
      FROM documents WHERE lang = 'en') GROUP BY term) ORDER BY c DESC, term LIMIT 1)"""


def _docs(spark, sf):
    return table(spark, sf, "documents")


def _td(spark, sf):
    return FE.doc_term_counts(_docs(spark, sf), "text", "doc_id", "default")


def _tfidf(spark, sf):
    """TF-IDF weights, dealt by document (the similarity queries read them once)."""
    docs = _docs(spark, sf)
    return FE.tfidf(FE.doc_term_counts(docs), docs).withColumnRenamed("tfidf", "w")


def target_word(spark, sf):
    """Most frequent term of English documents, ties by term (a scalar
    subquery evaluated by Spark)."""
    en = _docs(spark, sf).filter(F.col("lang") == "en")
    c = T.term_counts(T.tokenize(en, "text", "doc_id", "default"))
    return c.orderBy(F.desc("n"), "term").limit(1).select("term").first()[0]


@query("term_document", f"WITH {_TD} SELECT doc_id, term, n FROM td")
def q_term_document(spark, sf):
    return _td(spark, sf)


@query("document_frequency", f"WITH {_TD} SELECT term, count(*) AS df FROM td GROUP BY term")
def q_document_frequency(spark, sf):
    return FE.document_frequency(_td(spark, sf))


@query("matrix_shape", f"""WITH {_TD}
SELECT (SELECT count(*) FROM documents) AS n_rows, count(DISTINCT term) AS n_cols,
       count(*) AS n_cells FROM td""")
def q_matrix_shape(spark, sf):
    return FE.matrix_shape(_td(spark, sf), _docs(spark, sf))


@query("vocabulary", f"""
WITH t AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text),
             '[a-zA-Z]+(?:\\.[a-zA-Z]+)*|\\p{{Nd}}+|[.!?,:;()"'']\\s')) AS term FROM documents),
a AS (SELECT DISTINCT term FROM t WHERE regexp_matches(term, '^\\p{{L}}+$')
      AND term NOT IN ({FX.stopword_sql_list()}))
SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS BIGINT) AS idx FROM a""")
def q_vocabulary(spark, sf):
    # construct_vocabulary: rule tokens, letters only, stop words removed, sorted
    toks = T.tokenize(_docs(spark, sf), "text", "doc_id", "rule", alpha_only=True)
    return FE.vocabulary(toks, stopwords=ENGLISH_STOPWORDS)


@query("tfidf", f"WITH {_TFIDF} SELECT doc_id, term, round(w, 9) AS tfidf FROM tf")
def q_tfidf(spark, sf):
    return _tfidf(spark, sf).select("doc_id", "term", F.round("w", 9).alias("tfidf"))


@query("max_cell", f"""WITH {_TFIDF}
SELECT term, doc_id, round(w, 9) AS tfidf FROM tf ORDER BY w DESC, term, doc_id LIMIT 1""")
def q_max_cell(spark, sf):
    m = FE.max_cell(_tfidf(spark, sf), "term", "doc_id", "w")
    return m.select("term", "doc_id", F.round("w", 9).alias("tfidf"))


_RANK_SQL = f"""WITH {_TFIDF},
tg AS (SELECT doc_id, w AS wt FROM tf WHERE term = {_TARGET}),
tn AS (SELECT sqrt(sum(wt * wt)) AS n FROM tg),
nrm AS (SELECT term, sqrt(sum(w * w)) AS norm FROM tf GROUP BY term),
dt AS (SELECT term, sum(w * wt) AS d FROM tf JOIN tg USING (doc_id) GROUP BY term),
sims AS (SELECT nrm.term, coalesce(dt.d / (nrm.norm * tn.n), 0.0) AS similarity
         FROM nrm LEFT JOIN dt USING (term), tn WHERE nrm.term <> {_TARGET})"""


@query("rank_by_similarity", _RANK_SQL + " SELECT term, round(similarity, 9) AS similarity FROM sims")
def q_rank_by_similarity(spark, sf):
    r = FE.rank_by_similarity(_tfidf(spark, sf), target_word(spark, sf))
    return r.select("term", F.round("similarity", 9).alias("similarity"))


@query("find_similar_words", _RANK_SQL + """
SELECT term, round(similarity, 9) AS similarity FROM sims ORDER BY similarity DESC, term LIMIT 10""")
def q_find_similar_words(spark, sf):
    r = FE.find_similar_words(_tfidf(spark, sf), target_word(spark, sf), 10)
    return r.select("term", F.round("similarity", 9).alias("similarity"))


@query("cooccurrence", f"""
WITH t AS (SELECT doc_id, {r6()} AS tok FROM documents),
p AS (SELECT least(tok[i], tok[i + d]) AS t1, greatest(tok[i], tok[i + d]) AS t2
      FROM t, range(1, 3) dd(d), range(1, CAST(len(tok) AS BIGINT) + 1) r(i)
      WHERE i + d <= len(tok)),
h AS (SELECT t1, t2, count(*) AS n FROM p WHERE t1 <> t2 GROUP BY t1, t2)
SELECT t1, t2, n FROM h UNION ALL SELECT t2, t1, n FROM h""")
def q_cooccurrence(spark, sf):
    return FE.cooccurrence(_docs(spark, sf), window=2)


@query("cooccurrence_sentence", f"""
WITH s AS (SELECT unnest(string_split_regex(text, '[.!?\\n]+')) AS s FROM documents),
n AS (SELECT row_number() OVER () AS id, {r6("s")} AS tok FROM s),
c AS (SELECT id, term, count(*) AS c FROM (SELECT id, unnest(tok) AS term FROM n) GROUP BY ALL),
p AS (SELECT a.term AS t1, b.term AS t2, CAST(sum(a.c * b.c) AS BIGINT) AS n
      FROM c a JOIN c b ON a.id = b.id AND a.term <> b.term GROUP BY ALL)
SELECT t1 AS term, count(*) AS n_partners, CAST(sum(n) AS BIGINT) AS n_total, max(n) AS n_most,
       min(t2) AS first_partner FROM p GROUP BY t1""")
def q_cooccurrence_sentence(spark, sf):
    """The co-occurrence table, one row per term."""
    pairs = FE.sentence_cooccurrence(_docs(spark, sf))
    return pairs.groupBy(F.col("t1").alias("term")).agg(
        F.count("*").alias("n_partners"), F.sum("n").alias("n_total"), F.max("n").alias("n_most"),
        F.min("t2").alias("first_partner"))


@query("cooccurrence_document", f"""
WITH c AS (SELECT item_id, term, count(*) AS n FROM (SELECT item_id, unnest({r6()}) AS term FROM benchmark) GROUP BY ALL)
SELECT a.term AS t1, b.term AS t2, CAST(sum(a.n * b.n) AS BIGINT) AS n
FROM c a JOIN c b ON a.item_id = b.item_id AND a.term <> b.term GROUP BY ALL""")
def q_cooccurrence_document(spark, sf):
    """The whole term-term table over the benchmark's items."""
    return FE.context_cooccurrence(FE.doc_term_counts(table(spark, sf, "benchmark"), "text", "item_id"), "item_id")


@query("cooccurrence_focus", f"""
WITH c AS (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest({r6()}) AS term FROM documents) GROUP BY ALL)
SELECT a.term AS t1, b.term AS t2, CAST(sum(a.n * b.n) AS BIGINT) AS n
FROM c a JOIN c b ON a.doc_id = b.doc_id AND a.term <> b.term WHERE a.term = {_TARGET} GROUP BY ALL""")
def q_cooccurrence_focus(spark, sf):
    """Partners of the target word over whole documents."""
    word = _docs(spark, sf).limit(1).select(F.lit(target_word(spark, sf)).alias("term"))
    return FE.context_cooccurrence(FE.doc_term_counts(_docs(spark, sf)), focus=word)


@query("vocabulary_normalized", f"""
WITH t AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text),
             '[a-zA-Z]+(?:\\.[a-zA-Z]+)*|\\p{{Nd}}+|[.!?,:;()"'']\\s')) AS term FROM documents),
l AS (SELECT word, min(lemma) AS lemma FROM {FX.lemma_sql_values()} GROUP BY word),
a AS (SELECT DISTINCT coalesce(l.lemma, t.term) AS term FROM t LEFT JOIN l ON l.word = t.term
      WHERE regexp_matches(t.term, '^\\p{{L}}+$'))
SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS BIGINT) AS idx FROM a
WHERE term NOT IN ({FX.stopword_sql_list()})""")
def q_vocabulary_normalized(spark, sf):
    """One call in the order: tokenise, letters only, lemma, stop words."""
    return FE.vocabulary_from_text(_docs(spark, sf), "lemma", FX.lemma_df(spark).select("word", "lemma"))


_PAIRS_SQL = f"""pairs AS (SELECT item_id, tok[1] AS w1, tok[len(tok)] AS w2
  FROM (SELECT item_id, {r6()} AS tok FROM benchmark) WHERE len(tok) > 0)"""


def _pairs(spark, sf):
    b = T.token_arrays(table(spark, sf, "benchmark"), "text", "tok", "default")
    return b.filter(F.size("tok") > 0).select(
        "item_id", F.element_at("tok", 1).alias("w1"), F.element_at("tok", -1).alias("w2"))


@query("pair_similarity", f"""WITH {_TFIDF}, {_PAIRS_SQL},
lw AS (SELECT w1 AS term FROM pairs UNION SELECT w2 FROM pairs),
tl AS MATERIALIZED (SELECT tf.* FROM tf SEMI JOIN lw USING (term)),
nrm AS (SELECT term, sqrt(sum(w * w)) AS norm FROM tl GROUP BY term),
dp AS (SELECT DISTINCT w1, w2 FROM pairs),
dt AS (SELECT dp.w1, dp.w2, sum(a.w * b.w) AS d FROM dp
       JOIN tl a ON a.term = dp.w1 JOIN tl b ON b.term = dp.w2 AND b.doc_id = a.doc_id
       GROUP BY dp.w1, dp.w2)
SELECT p.item_id, p.w1, p.w2,
       round(CASE WHEN n1.norm IS NOT NULL AND n2.norm IS NOT NULL
             THEN coalesce(dt.d / (n1.norm * n2.norm), 0.0) END, 9) AS similarity
FROM pairs p LEFT JOIN nrm n1 ON n1.term = p.w1 LEFT JOIN nrm n2 ON n2.term = p.w2
LEFT JOIN dt ON dt.w1 = p.w1 AND dt.w2 = p.w2""")
def q_pair_similarity(spark, sf):
    r = FE.pair_similarity(_tfidf(spark, sf), cut_lineage(_pairs(spark, sf)))
    return r.select("item_id", "w1", "w2", F.round("similarity", 9).alias("similarity"))


@query("vocab_overlap", f"""
WITH a AS (SELECT DISTINCT unnest({r6()}) AS term FROM documents),
b AS (SELECT DISTINCT unnest({r6()}) AS term FROM benchmark)
SELECT count(a.term) AS n_a, count(b.term) AS n_b,
       count(CASE WHEN a.term IS NOT NULL AND b.term IS NOT NULL THEN 1 END) AS n_shared,
       count(CASE WHEN b.term IS NULL THEN 1 END) AS n_only_a,
       count(CASE WHEN a.term IS NULL THEN 1 END) AS n_only_b
FROM a FULL OUTER JOIN b ON a.term = b.term""")
def q_vocab_overlap(spark, sf):
    a = T.tokenize(_docs(spark, sf), "text", "doc_id", "default")
    b = T.tokenize(table(spark, sf, "benchmark"), "text", "item_id", "default")
    return FE.vocab_overlap(a, b)


@query("vocab_union", f"""
SELECT DISTINCT term FROM (SELECT unnest({r6()}) AS term FROM documents
                           UNION ALL SELECT unnest({r6()}) FROM benchmark)""")
def q_vocab_union(spark, sf):
    a = T.tokenize(_docs(spark, sf), "text", "doc_id", "default").select("term")
    b = T.tokenize(table(spark, sf, "benchmark"), "text", "item_id", "default").select("term")
    return a.union(b).distinct()
