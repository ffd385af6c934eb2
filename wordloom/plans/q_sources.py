"""Registered queries: file sources and sinks as round trips through the
shared folder (written from a driver table, read back by the library's own
reader), and chart parsing of the role sequences of conversations."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import patterns as P
from ..operators import grammar as G
from ..session import checkpoint_dir, table
from ..sources import files as SRC
from ..sources import sinks as SNK
from .q_grammar import _LEX_SQL, lexicon
from .q_vectors import _PAIRS_SQL, gold_pairs, questions
from .registry import query


def scratch(spark, name: str) -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("read_corpus", "SELECT doc_id, text || chr(10) AS text FROM documents")
def q_read_corpus(spark, sf):
    """write_corpus, then read_corpus: one file per document, whole texts
    (the text sink ends each with a line break)."""
    path = scratch(spark, "corpus")
    SNK.write_corpus(table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("file"), "text"), path)
    back = SRC.read_corpus(spark, path)
    return back.select(F.regexp_extract("path", r"file=(-?\d+)", 1).cast("long").alias("doc_id"), "text")


@query("read_lines", """
SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS place, unnest(l) AS line
FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)""")
def q_read_lines(spark, sf):
    """The lines of all documents in files that hold many documents each;
    ``place`` comes from the line numbers that read_lines finds."""
    path = scratch(spark, "lines")
    docs = table(spark, sf, "documents")
    (docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
         .repartitionByRange(8, "doc_id").sortWithinPartitions("doc_id", "pos")
         .select(F.concat_ws("\t", "doc_id", "line")).write.text(path))
    lines = SRC.read_lines(spark, path).select(
        "line_no", F.regexp_extract("text", r"^(-?\d+)\t", 1).cast("long").alias("doc_id"),
        F.expr("substring(text, locate('\t', text) + 1)").alias("line"))
    first = lines.groupBy("doc_id").agg(F.min("line_no").alias("_first"))
    return lines.join(first, "doc_id").select("doc_id", (F.col("line_no") - F.col("_first")).alias("place"), "line")


@query("read_word_pairs", f"WITH {_PAIRS_SQL} SELECT w1, w2, score FROM gp")
def q_read_word_pairs(spark, sf):
    path = scratch(spark, "pairs")
    gold_pairs(spark, sf).write.option("sep", "\t").csv(path)
    return SRC.read_word_pairs(spark, path)


@query("read_analogies", """
SELECT CAST(label AS VARCHAR) AS section, CAST(vec_id AS VARCHAR) AS a,
       CAST((vec_id + 1) % (SELECT count(*) FROM embeddings) AS VARCHAR) AS b,
       CAST((vec_id + 2) % (SELECT count(*) FROM embeddings) AS VARCHAR) AS c,
       CAST((vec_id + 3) % (SELECT count(*) FROM embeddings) AS VARCHAR) AS d FROM embeddings""")
def q_read_analogies(spark, sf):
    """One file per section: its header line, then its questions."""
    path = scratch(spark, "analogies")
    q = questions(spark, sf)
    rows = (q.select("section", F.lit(1).alias("kind"), "qid", F.concat_ws(" ", "a", "b", "c", "d").alias("value"))
             .unionByName(q.select("section").distinct().select(
                 "section", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("qid"),
                 F.concat(F.lit(": "), "section").alias("value"))))
    (rows.withColumn("file", F.col("section")).repartition("file").sortWithinPartitions("file", "kind", "qid")
         .select("file", "value").write.partitionBy("file").text(path))
    return SRC.read_analogies(spark, path).drop("qid")


@query("read_lexicon", f"WITH {_LEX_SQL} SELECT word, cat FROM lex")
def q_read_lexicon(spark, sf):
    path = scratch(spark, "lexicon")
    SNK.write_lexicon(lexicon(spark, sf), path)
    return SRC.read_lexicon(spark, path)


#: A small ambiguous grammar over the roles of a conversation.
ROLE_GRAMMAR = ["T -> U A", "S -> T", "S -> S S", "S -> Y S"]
ROLE_LEXICON = [("user", "U"), ("assistant", "A"), ("system", "Y")]


def role_sentences(spark, sf):
    c = table(spark, sf, "conversations")
    return c.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))),
                                                             lambda t: t["role"]), " ").alias("text"))


def role_grammar(spark, rules):
    """The grammar goes through a file and read_grammar."""
    path = scratch(spark, "grammar")
    spark.createDataFrame([(r,) for r in rules], "value string").write.text(path)
    return SRC.read_grammar(spark, path)


def role_parses(spark, sf):
    lex = spark.createDataFrame(ROLE_LEXICON, "word string, cat string")
    return G.chart_parse(role_sentences(spark, sf), lex, role_grammar(spark, ROLE_GRAMMAR), "S", "conv_id")


# n pairs have plain[n] trees, and led[n] with a system turn in front: either
# it covers all pairs, or the first k of them
_PARSE_SQL = """
RECURSIVE s AS (SELECT conv_id, string_agg(CASE role WHEN 'user' THEN 'U' WHEN 'assistant' THEN 'A' WHEN 'system' THEN 'Y' ELSE '?' END,
                                 '' ORDER BY turn) AS r, count(*) AS n_words FROM conversations GROUP BY conv_id),
f(n, plain, led) AS (
  SELECT 1, [1::BIGINT], [1::BIGINT]
  UNION ALL
  SELECT n + 1, list_append(plain, p), list_append(led, p + l) FROM (
    SELECT n, plain, led,
      CAST(list_sum(list_transform(range(1, n + 1), lambda k: plain[k] * plain[n + 1 - k])) AS BIGINT) AS p,
      CAST(list_sum(list_transform(range(1, n + 1), lambda k: led[k] * plain[n + 1 - k])) AS BIGINT) AS l
    FROM f) WHERE n < 30),
c AS (SELECT max(plain) AS plain, max(led) AS led FROM f WHERE n = 30),
p AS (SELECT conv_id, n_words, CASE WHEN regexp_full_match(r, '(UA)+') THEN plain[len(r) // 2]
      WHEN regexp_full_match(r, 'Y(UA)+') THEN led[(len(r) - 1) // 2] ELSE 0 END AS n_parses FROM s, c)"""


@query("chart_parse", f"WITH {_PARSE_SQL} SELECT conv_id, n_words, CAST(n_parses AS BIGINT) AS n_parses FROM p")
def q_chart_parse(spark, sf):
    return role_parses(spark, sf)


# the first five trees of n pairs, and of n pairs after a system turn: the
# longest first part first, then the parts' own trees in order
_TREES_SQL = """
RECURSIVE s AS (SELECT conv_id, string_agg(CASE role WHEN 'user' THEN 'U' WHEN 'assistant' THEN 'A' WHEN 'system' THEN 'Y' ELSE '?' END,
                                 '' ORDER BY turn) AS r, count(*) AS n_words FROM conversations GROUP BY conv_id),
f(n, plain, led) AS (
  SELECT 1, [['(S (T (U user) (A assistant)))']], [['(S (Y system) (S (T (U user) (A assistant))))']]
  UNION ALL
  SELECT n + 1, list_append(plain, p), list_append(led, (l || list_transform(p, lambda t: '(S (Y system) ' || t || ')'))[1:5]) FROM (
    SELECT n, plain, led,
      flatten(list_transform(range(n, 0, -1), lambda k: flatten(list_transform(plain[k], lambda a:
        list_transform(plain[n + 1 - k], lambda b: '(S ' || a || ' ' || b || ')')))))[1:5] AS p,
      flatten(list_transform(range(n, 0, -1), lambda k: flatten(list_transform(led[k], lambda a:
        list_transform(plain[n + 1 - k], lambda b: '(S ' || a || ' ' || b || ')')))))[1:5] AS l
    FROM f) WHERE n < 30),
c AS (SELECT max_by(plain, n) AS plain, max_by(led, n) AS led FROM f)"""


@query("parse_trees", f"""WITH {_TREES_SQL}
SELECT conv_id, n_words, CASE WHEN regexp_full_match(r, '(UA)+') THEN plain[len(r) // 2]
       WHEN regexp_full_match(r, 'Y(UA)+') THEN led[(len(r) - 1) // 2] ELSE []::VARCHAR[] END AS trees FROM s, c""")
def q_parse_trees(spark, sf):
    lex = spark.createDataFrame(ROLE_LEXICON, "word string, cat string")
    trees = G.parse_trees(role_sentences(spark, sf), lex, role_grammar(spark, ROLE_GRAMMAR), "S", 5, "conv_id")
    return trees.select("conv_id", "n_words", "trees")


#: Two more rules, one with a symbol no word has, one that nothing leads to.
DEAD_RULES = ["S -> X S", "Z -> U A"]


@query("rule_coverage", f"""
WITH RECURSIVE r(lhs, rhs) AS (VALUES {", ".join("('%s', %s)" % (a, b.split()) for a, b in (x.split(" -> ") for x in [*ROLE_GRAMMAR, *DEAD_RULES]))}),
lex AS (SELECT DISTINCT CASE role WHEN 'user' THEN 'U' WHEN 'assistant' THEN 'A' WHEN 'system' THEN 'Y' END AS cat FROM conversations),
p(i, syms) AS (SELECT 0, list(cat) FROM lex WHERE cat IS NOT NULL
  UNION ALL SELECT i + 1, list_distinct(syms || (SELECT list(lhs) FROM r WHERE list_has_all(syms, rhs))) FROM p WHERE i < 9),
pf AS (SELECT max_by(syms, i) AS syms FROM p),
ok AS (SELECT lhs, rhs FROM r, pf WHERE list_has_all(syms, rhs)),
q(i, syms) AS (SELECT 0, ['S'] UNION ALL
  SELECT i + 1, list_distinct(syms || coalesce((SELECT flatten(list(rhs)) FROM ok WHERE list_contains(syms, lhs)), [])) FROM q WHERE i < 9),
qf AS (SELECT max_by(syms, i) AS syms FROM q)
SELECT lhs, array_to_string(rhs, ' ') AS rhs, list_has_all(pf.syms, rhs) AS productive, list_contains(qf.syms, lhs) AS reachable,
       list_has_all(pf.syms, rhs) AND list_contains(qf.syms, lhs) AS usable FROM r, pf, qf""")
def q_rule_coverage(spark, sf):
    """Coverage by the roles that occur in the conversations."""
    roles = table(spark, sf, "conversations").select(F.col("role").alias("word")).distinct()
    lex = roles.join(F.broadcast(spark.createDataFrame(ROLE_LEXICON, "word string, cat string")), "word")
    out = G.rule_coverage(role_grammar(spark, [*ROLE_GRAMMAR, *DEAD_RULES]), lex)
    return out.withColumn("rhs", F.array_join("rhs", " "))


@query("parse_statistics", f"""WITH {_PARSE_SQL}
SELECT CAST(n_parses AS BIGINT) AS n_parses, count(*) AS n_sentences, (SELECT count(*) FROM p) AS sentences_read,
       (SELECT avg(CAST(n_parses > 0 AS DOUBLE)) FROM p) AS share_parsed FROM p GROUP BY n_parses""")
def q_parse_statistics(spark, sf):
    return G.parse_statistics(role_parses(spark, sf))


@query("append_results", """
SELECT event_type AS model_id, CAST(user_id AS VARCHAR) AS adapter_id, 'classification' AS task_type,
       CAST(day(ts) AS VARCHAR) AS n_shot, 'greedy' AS decoding_strategy, max(value) AS p50_ttft_seconds
FROM events GROUP BY ALL""")
def q_append_results(spark, sf):
    """Two appends under the fixed header, then read_results."""
    ev = table(spark, sf, "events")
    runs = ev.groupBy(F.concat(F.lit(" "), "event_type", F.lit(" ")).alias("model_id"),
                      F.col("user_id").cast("string").alias("adapter_id"), F.lit("classification").alias("task_type"),
                      F.dayofmonth("ts").alias("n_shot"), F.lit("greedy").alias("decoding_strategy")).agg(
        F.max("value").alias("p50_ttft_seconds"))
    path = scratch(spark, "results")
    SNK.append_results(runs.filter("n_shot < 15"), path)
    SNK.append_results(runs.filter("n_shot >= 15"), path)
    back = SRC.read_results(spark, path)
    return back.select("model_id", "adapter_id", "task_type", "n_shot", "decoding_strategy",
                       F.col("p50_ttft_seconds").cast("double").alias("p50_ttft_seconds"))


@query("save_result_docs", """
SELECT 'org_' || event_type AS model_id, CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END AS task,
       CAST(hour(ts) % 4 AS INTEGER) AS n_shot, 'greedy' AS strategy, max(value) AS best, count(*) AS n
FROM events GROUP BY ALL""")
def q_save_result_docs(spark, sf):
    """Two saves into one folder, one task each: the second keeps the
    documents of the first."""
    ev = table(spark, sf, "events")
    docs = ev.groupBy(F.concat(F.lit("org/"), "event_type").alias("model_id"),
                      F.when(F.col("user_id") % 2 == 0, "even").otherwise("odd").alias("task"),
                      (F.hour("ts") % 4).alias("n_shot"), F.lit("greedy").alias("strategy")).agg(
        F.max("value").alias("best"), F.count("*").alias("n"))
    path = scratch(spark, "docs")
    for task in ("even", "odd"):
        SNK.save_result_docs(docs.filter(F.col("task") == task), path)
    return spark.read.json(path).select("model_id", "task", F.col("n_shot").cast("int").alias("n_shot"),
                                        "strategy", "best", "n")


@query("match_report", f"""
SELECT doc_id, 'Long runs' || chr(10) || array_to_string(regexp_extract_all(text, '{P.re2_elongated(2)}'), chr(10))
  || chr(10) || chr(10) || chr(10) || 'Capitals' || chr(10)
  || array_to_string(regexp_extract_all(text, '[A-Z]{{2,}}'), chr(10)) AS report FROM documents""")
def q_match_report(spark, sf):
    docs = table(spark, sf, "documents")
    return SNK.match_report(docs, {"Long runs": P.re2_elongated(2), "Capitals": "[A-Z]{2,}"}, "doc_id")
