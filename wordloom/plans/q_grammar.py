"""Registered queries: lexicons built from the corpus (category = language
of the documents a word occurs in) and coverage of benchmark tokens."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import grammar as G
from ..operators import text as T
from ..session import table
from .registry import query, r6

_LEX_SQL = f"lex AS (SELECT DISTINCT unnest({r6()}) AS word, lang AS cat FROM documents)"


def lexicon(spark, sf):
    d = table(spark, sf, "documents")
    return (T.tokenize(d, "text", "doc_id", "default", keep=["lang"])
            .select(F.col("term").alias("word"), F.col("lang").alias("cat")).distinct())


@query("lexicon_sets", f"""WITH {_LEX_SQL}
SELECT cat, word, CAST(row_number() OVER (PARTITION BY cat ORDER BY word) - 1 AS BIGINT) AS idx
FROM lex""")
def q_lexicon_sets(spark, sf):
    return G.lexicon_sets(lexicon(spark, sf))


@query("lexicon_coverage", f"""WITH {_LEX_SQL},
t AS (SELECT item_id, CAST(generate_subscripts(tok, 1) - 1 AS INTEGER) AS pos, unnest(tok) AS term
      FROM (SELECT item_id, {r6()} AS tok FROM benchmark)),
c AS (SELECT word, count(*) AS n FROM lex GROUP BY word)
SELECT t.item_id, t.pos, t.term, coalesce(c.n, 0) AS n_cats FROM t LEFT JOIN c ON c.word = t.term""")
def q_lexicon_coverage(spark, sf):
    b = table(spark, sf, "benchmark")
    toks = T.tokenize(b, "text", "item_id", "default")
    cov = G.lexicon_coverage(toks, lexicon(spark, sf))
    return cov.select("item_id", "pos", "term", "n_cats")


@query("missing_words", f"""WITH {_LEX_SQL},
t AS (SELECT item_id, unnest({r6()}) AS term FROM benchmark)
SELECT DISTINCT term FROM t WHERE term NOT IN (SELECT word FROM lex)""")
def q_missing_words(spark, sf):
    b = table(spark, sf, "benchmark")
    toks = T.tokenize(b, "text", "item_id", "default")
    return G.missing_words(toks, lexicon(spark, sf)).select("term").distinct()


@query("keep_categories", f"""WITH {_LEX_SQL}
SELECT word, cat FROM lex WHERE cat IN ('en', 'fr') AND trim(word) <> ''""")
def q_keep_categories(spark, sf):
    return T.keep_categories(lexicon(spark, sf), ["en", "fr"])
