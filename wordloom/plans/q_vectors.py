"""Registered queries on ``embeddings`` (word = vec_id as text).  Gold pairs:
i with (7 i + 3) mod n, score 10 - |label difference|; analogies:
(i, i+1, i+2, i+3) mod n in the section of a's label (fixture rules)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import text as T
from ..operators import vectors as VE
from ..operators.vector_index import VectorIndex
from ..session import checkpoint_dir, table
from .registry import query

_U = """u AS (SELECT CAST(vec_id AS VARCHAR) AS word, label, CAST(embedding AS DOUBLE[]) AS v
       FROM embeddings)"""
_N = "(SELECT count(*) FROM embeddings)"


def _cos_sql(a, b):
    return (f"list_inner_product({a}, {b}) / (sqrt(list_inner_product({a}, {a})) "
            f"* sqrt(list_inner_product({b}, {b})))")


def _emb(spark, sf):
    return table(spark, sf, "embeddings")


def _vec(spark, sf):
    return VE.read_vectors(_emb(spark, sf))


def gold_pairs(spark, sf):
    e = _emb(spark, sf)
    n = e.count()
    lab = e.select(F.col("vec_id").alias("_j"), F.col("label").alias("_lj"))
    p = e.select(F.col("vec_id"), F.pmod(7 * F.col("vec_id") + 3, n).alias("_j"), "label")
    p = p.join(lab, "_j", "left")
    return p.select(F.col("vec_id").cast("string").alias("w1"), F.col("_j").cast("string").alias("w2"),
                    (10 - F.abs(F.col("label") - F.col("_lj"))).cast("double").alias("score"))


_PAIRS_SQL = f"""{_U},
p AS (SELECT vec_id AS i, (7 * vec_id + 3) % {_N} AS j, label FROM embeddings),
gp AS (SELECT CAST(p.i AS VARCHAR) AS w1, CAST(p.j AS VARCHAR) AS w2,
       CAST(10 - abs(p.label - e2.label) AS DOUBLE) AS score
       FROM p LEFT JOIN embeddings e2 ON e2.vec_id = p.j),
cs AS (SELECT gp.*, {_cos_sql('a.v', 'b.v')} AS cosine
       FROM gp LEFT JOIN u a ON a.word = gp.w1 LEFT JOIN u b ON b.word = gp.w2)"""


@query("read_vectors", """
SELECT CAST(vec_id AS VARCHAR) AS word, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS i,
       CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings""")
def q_read_vectors(spark, sf):
    return _vec(spark, sf).select("word", F.posexplode("vector").alias("i", "x"))


@query("cosine", f"WITH {_PAIRS_SQL} SELECT w1, w2, round(cosine, 9) AS cosine FROM cs")
def q_cosine(spark, sf):
    v = _vec(spark, sf)
    v1 = v.select(F.col("word").alias("w1"), F.col("vector").alias("a"))
    v2 = v.select(F.col("word").alias("w2"), F.col("vector").alias("b"))
    j = gold_pairs(spark, sf).join(v1, "w1", "left").join(v2, "w2", "left")
    return j.select("w1", "w2", F.round(C.cosine("a", "b"), 9).alias("cosine"))


@query("cosine_distance", f"""WITH {_PAIRS_SQL}
SELECT w1, w2, round(1.0 - cosine, 9) AS distance FROM cs""")
def q_cosine_distance(spark, sf):
    d = VE.cosine_distance(_vec(spark, sf), gold_pairs(spark, sf).select("w1", "w2"))
    return d.select("w1", "w2", F.round("distance", 9).alias("distance"))


def _most_similar_sql(pos, neg, n):
    words = ", ".join(f"'{w}'" for w in pos + neg)
    return f"""WITH {_U},
un AS (SELECT word, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) AS uv,
       CASE WHEN word IN ({', '.join(f"'{w}'" for w in pos)}) THEN 1.0 ELSE -1.0 END AS s
       FROM u WHERE word IN ({words})),
comp AS (SELECT i, sum(s * uv[i]) / {len(pos) + len(neg)} AS x
         FROM un, range(1, (SELECT max(len(uv)) FROM un) + 1) r(i) GROUP BY i),
q AS (SELECT list(x ORDER BY i) AS qv FROM comp),
sims AS (SELECT word, {_cos_sql('v', 'qv')} AS similarity FROM u, q WHERE word NOT IN ({words}))
SELECT word, round(similarity, 9) AS similarity FROM
  (SELECT * FROM sims ORDER BY similarity DESC, word LIMIT {n})"""


@query("most_similar", _most_similar_sql(["0"], [], 10))
def q_most_similar(spark, sf):
    r = VE.most_similar(_vec(spark, sf), ["0"], [], 10)
    return r.select("word", F.round("similarity", 9).alias("similarity"))


@query("most_similar_analogy", _most_similar_sql(["1", "2"], ["0"], 10))
def q_most_similar_analogy(spark, sf):
    r = VE.most_similar(_vec(spark, sf), ["1", "2"], ["0"], 10)
    return r.select("word", F.round("similarity", 9).alias("similarity"))


@query("most_similar_index", _most_similar_sql(["1", "2"], ["0"], 10))
def q_most_similar_index(spark, sf):
    """The same question to a stored index of all vectors."""
    index = VectorIndex.build(_vec(spark, sf), f"{checkpoint_dir(spark).rstrip('/')}/index-{uuid.uuid4().hex}")
    r = index.most_similar(["1", "2"], ["0"], 10)
    return r.select("word", F.round("similarity", 9).alias("similarity"))


@query("compare_models", f"""WITH {_U},
m AS (SELECT 'plain' AS model, word, v FROM u
      UNION ALL SELECT 'weighted', word, list_transform(v, lambda x, i: x * i) FROM u),
q AS (SELECT model, v AS qv FROM m WHERE word = '0'),
s AS (SELECT m.model, m.word, {_cos_sql('m.v', 'q.qv')} AS similarity
      FROM m JOIN q USING (model) WHERE m.word <> '0'),
r AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY similarity DESC, word) AS rk FROM s)
SELECT model, word, round(similarity, 9) AS similarity, CAST(rk AS INTEGER) AS rank FROM r WHERE rk <= 5""")
def q_compare_models(spark, sf):
    """Two vector tables: the vectors, and all their entries weighted by position."""
    v = _vec(spark, sf)
    models = (v.select(F.lit("plain").alias("model"), "word", "vector")
              .unionByName(v.select(F.lit("weighted").alias("model"), "word",
                                    F.transform("vector", lambda x, i: x * (i + 1)).alias("vector"))))
    r = VE.compare_models(models, "0", 5)
    return r.select("model", "word", F.round("similarity", 9).alias("similarity"), "rank")


def questions(spark, sf):
    e = _emb(spark, sf)
    n = e.count()
    w = lambda d: F.pmod(F.col("vec_id") + d, n).cast("string")
    return e.select(F.col("vec_id").alias("qid"), F.col("label").cast("string").alias("section"),
                    w(0).alias("a"), w(1).alias("b"), w(2).alias("c"), w(3).alias("d"))


_ANALOGY_SQL = f"""{_U},
un AS (SELECT word, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) AS uv FROM u),
q AS (SELECT vec_id AS qid, CAST(label AS VARCHAR) AS section, CAST(vec_id AS VARCHAR) AS a,
        CAST((vec_id + 1) % {_N} AS VARCHAR) AS b, CAST((vec_id + 2) % {_N} AS VARCHAR) AS c,
        CAST((vec_id + 3) % {_N} AS VARCHAR) AS d FROM embeddings),
qv AS (SELECT q.*, list_transform(range(1, len(ub.uv) + 1),
         lambda i: (ub.uv[i] + uc.uv[i] - ua.uv[i]) / 3.0) AS qv
       FROM q JOIN un ua ON ua.word = q.a JOIN un ub ON ub.word = q.b JOIN un uc ON uc.word = q.c
       JOIN un ud ON ud.word = q.d),
s AS (SELECT qv.qid, un.word, list_inner_product(un.uv, qv.qv) / sqrt(list_inner_product(qv.qv, qv.qv)) AS sim
      FROM qv, un WHERE un.word NOT IN (qv.a, qv.b, qv.c)),
b AS (SELECT qid, word AS predicted, sim FROM (
        SELECT *, row_number() OVER (PARTITION BY qid ORDER BY sim DESC, word) AS r FROM s) WHERE r = 1),
res AS (SELECT qv.qid, qv.section, qv.a, qv.b, qv.c, qv.d, b.predicted, b.sim,
          coalesce(b.predicted = qv.d, false) AS correct FROM qv LEFT JOIN b USING (qid))"""


def _solved(spark, sf):
    return VE.solve_analogies(questions(spark, sf), _vec(spark, sf))


@query("solve_analogies", f"""WITH {_ANALOGY_SQL}
SELECT qid, section, a, b, c, d, predicted, round(sim, 9) AS similarity, correct FROM res""")
def q_solve_analogies(spark, sf):
    r = _solved(spark, sf)
    return r.select("qid", "section", "a", "b", "c", "d", "predicted",
                    F.round("similarity", 9).alias("similarity"), "correct")


@query("analogy_accuracy", f"""WITH {_ANALOGY_SQL}
SELECT coalesce(section, 'Total') AS section, CAST(sum(CAST(correct AS BIGINT)) AS BIGINT) AS n_correct,
       CAST(sum(CAST(NOT correct AS BIGINT)) AS BIGINT) AS n_incorrect,
       sum(CAST(correct AS BIGINT)) / NULLIF(count(*), 0) AS accuracy
FROM res GROUP BY ROLLUP (section)""")
def q_analogy_accuracy(spark, sf):
    return VE.analogy_accuracy(_solved(spark, sf))


@query("word_pair_eval", f"""WITH {_PAIRS_SQL},
k AS (SELECT score, cosine FROM cs WHERE cosine IS NOT NULL),
r AS (SELECT score, cosine,
        rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rs,
        rank() OVER (ORDER BY cosine) + (count(*) OVER (PARTITION BY cosine) - 1) / 2.0 AS rc FROM k)
SELECT corr(score, cosine) AS pearson, corr(rs, rc) AS spearman, count(*) AS n_pairs,
       (SELECT count(*) FILTER (WHERE cosine IS NULL) * 100.0 / count(*) FROM cs) AS oov_ratio
FROM r""")
def q_word_pair_eval(spark, sf):
    return VE.word_pair_eval(gold_pairs(spark, sf), _vec(spark, sf))


_MIXED_SQL = f"""m AS (SELECT 'w' || vec_id AS word, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
      UNION ALL SELECT 'W' || vec_id, list_reverse(CAST(embedding AS DOUBLE[])) FROM embeddings WHERE vec_id % 3 = 0),
fd AS (SELECT upper(word) AS word, arg_min(v, word) AS v FROM m GROUP BY 1),
mp AS (SELECT i, j, score FROM (SELECT p.i, p.j, CAST(10 - abs(p.label - e2.label) AS DOUBLE) AS score
       FROM (SELECT vec_id AS i, (7 * vec_id + 3) % {_N} AS j, label FROM embeddings) p JOIN embeddings e2 ON e2.vec_id = p.j)),
cs AS (SELECT score, {_cos_sql('a.v', 'b.v')} AS cosine
       FROM mp LEFT JOIN fd a ON a.word = 'W' || i LEFT JOIN fd b ON b.word = 'W' || j)"""


@query("word_pair_eval_mixed", f"""WITH {_MIXED_SQL},
k AS (SELECT score, cosine FROM cs WHERE cosine IS NOT NULL),
r AS (SELECT score, cosine,
        rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rs,
        rank() OVER (ORDER BY cosine) + (count(*) OVER (PARTITION BY cosine) - 1) / 2.0 AS rc FROM k)
SELECT corr(score, cosine) AS pearson, corr(rs, rc) AS spearman, count(*) AS n_pairs,
       (SELECT count(*) FILTER (WHERE cosine IS NULL) * 100.0 / count(*) FROM cs) AS oov_ratio
FROM r""")
def q_word_pair_eval_mixed(spark, sf):
    """Words in both cases (``w7``, ``W6`` and ``w6``), pairs in mixed case:
    each folded word counts once, with its first vector."""
    e = _emb(spark, sf)
    rows = e.select(F.concat(F.lit("w"), "vec_id").alias("vec_id"), "embedding").unionByName(
        e.filter("vec_id % 3 = 0").select(F.concat(F.lit("W"), "vec_id").alias("vec_id"), F.reverse("embedding").alias("embedding")))
    pairs = gold_pairs(spark, sf).select(F.concat(F.lit("W"), "w1").alias("w1"), F.concat(F.lit("w"), "w2").alias("w2"), "score")
    return VE.word_pair_eval(pairs, VE.read_vectors(rows))


def _sentences(spark, sf):
    d = table(spark, sf, "documents")
    return T.token_arrays(d, "text", "tokens", "default").select("doc_id", "tokens")


@query("word2vec_fit", """
SELECT term AS word, CAST(16 AS INTEGER) AS dims FROM (
  SELECT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS term FROM documents)
GROUP BY term HAVING count(*) >= 5""")
def q_word2vec_fit(spark, sf):
    par = spark.sparkContext.defaultParallelism
    return VE.word2vec_fit(_sentences(spark, sf), vector_size=16, window=5, min_count=5,
                           num_partitions=par).select("word", F.size("vector").alias("dims"))


def _grid(spark, sf):
    bench = table(spark, sf, "benchmark")
    toks = T.tokenize(bench, "text", "item_id", "default")
    t2 = toks.select("item_id", F.col("pos").alias("p0"), F.col("term").alias("t0"))
    q = (t2.join(toks.select("item_id", (F.col("pos") - 1).alias("p0"), F.col("term").alias("b")), ["item_id", "p0"])
           .join(toks.select("item_id", (F.col("pos") - 2).alias("p0"), F.col("term").alias("c")), ["item_id", "p0"])
           .join(toks.select("item_id", (F.col("pos") - 3).alias("p0"), F.col("term").alias("d")), ["item_id", "p0"])
           .select(F.xxhash64("item_id", "p0").alias("qid"),
                   F.col("item_id").cast("string").alias("section"), F.col("t0").alias("a"), "b", "c", "d"))
    pairs = (t2.join(toks.select("item_id", (F.col("pos") - 1).alias("p0"), F.col("term").alias("w2")),
                     ["item_id", "p0"])
               .select(F.col("t0").alias("w1"), "w2",
                       F.abs(F.length("t0") - F.length("w2")).cast("double").alias("score")))
    par = spark.sparkContext.defaultParallelism
    return VE.word2vec_grid(_sentences(spark, sf), {"vector_size": [8, 16], "window": [2]},
                            q, pairs, min_count=2, num_partitions=par)


@query("word2vec_grid")
def q_word2vec_grid(spark, sf):
    return _grid(spark, sf).drop("train_seconds")


@query("project_2d")
def q_project_2d(spark, sf):
    return VE.project_2d(_vec(spark, sf))
