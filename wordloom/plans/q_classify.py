"""Registered queries: naive Bayes on ``documents`` (class = lang; test
documents are those with ``doc_id % 5 = 0``, the fixture rule), metrics and
splits."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.patterns import ENGLISH_STOPWORDS
from ..operators import classify as CL
from ..operators import pairs
from ..operators import text as T
from ..operators.features import by_document
from ..session import broadcast_checked, cut_lineage, table
from . import fixtures as FX
from .registry import query


def _test():
    return F.col("doc_id") % 5 == 0


def nb_inputs(spark, sf, n=1, stop=False, lower=True):
    docs = table(spark, sf, "documents").withColumnRenamed("lang", "label")
    # texts are dealt by document, so that their terms are counted where they are made
    arr = T.token_arrays(by_document(docs.select("doc_id", "label", "text")), "text", "tokens", "word", lowercase=lower)
    toks = T.ngrams(arr, n, "tokens", "doc_id", keep=["label"])
    if stop:
        toks = T.remove_stopwords(toks, ENGLISH_STOPWORDS)
    # counted once and written to the shared checkpoint folder: the fit and
    # the scoring read it several times
    td = cut_lineage(toks.groupBy("doc_id", "label", "term").agg(F.count("*").alias("n")))
    return {"train_td": td.filter(~_test()), "test_td": td.filter(_test()).drop("label"),
            "train_docs": docs.filter(~_test()).select("doc_id", "label"),
            "test_docs": docs.filter(_test()).select("doc_id", "label")}


def nb_run(spark, sf, alpha=1.0, **kw):
    d = nb_inputs(spark, sf, **kw)
    model = CL.nb_fit(d["train_td"], d["train_docs"], alpha)
    proba = CL.nb_predict_proba(d["test_td"], d["test_docs"], model)
    return d, model, proba


def _ln(x: str) -> str:
    return f"(CASE WHEN ({x}) > 0 THEN ln({x}) WHEN ({x}) = 0 THEN CAST('-inf' AS DOUBLE) END)"


def nb_sql(alpha=1.0, n=1, stop=False, lower=True) -> str:
    """CTE chain ending in ``sc (doc_id, label, log_score)`` and ``vs (v)``."""
    low = "lower(text)" if lower else "text"
    tok = f"regexp_extract_all({low}, '[\\p{{L}}\\p{{N}}_]+')"
    if n == 1:
        grams = "SELECT doc_id, lang, unnest(tok) AS term FROM t"
    else:
        grams = (f"SELECT doc_id, lang, array_to_string(tok[i:i+{n - 1}], ' ') AS term "
                 f"FROM t, range(1, CAST(len(tok) AS BIGINT) - {n - 2}) r(i)")
    stop_f = f"WHERE term NOT IN ({FX.stopword_sql_list()})" if stop else ""
    a = f"{float(alpha)}"
    return f"""
t AS (SELECT doc_id, lang, {tok} AS tok FROM documents),
g AS (SELECT * FROM ({grams}) {stop_f}),
td AS (SELECT doc_id, lang, term, count(*) AS n FROM g GROUP BY ALL),
tr AS (SELECT * FROM td WHERE doc_id % 5 <> 0),
te AS (SELECT * FROM td WHERE doc_id % 5 = 0),
vocab AS (SELECT DISTINCT term FROM tr),
vs AS (SELECT count(*) AS v FROM vocab),
cd AS (SELECT lang AS label, count(*) AS nd FROM documents WHERE doc_id % 5 <> 0 GROUP BY lang),
pri AS (SELECT label, nd, {_ln('nd / (SELECT sum(nd) FROM cd)')} AS log_prior FROM cd),
ct AS (SELECT lang AS label, term, sum(n) AS c FROM tr GROUP BY ALL),
tot AS (SELECT label, sum(c) AS total FROM ct GROUP BY label),
cls AS (SELECT pri.label, pri.log_prior, coalesce(tot.total, 0) AS total
        FROM pri LEFT JOIN tot USING (label)),
lik AS (SELECT ct.label, ct.term, {_ln(f'(ct.c + {a}) / (cls.total + {a} * vs.v)')} AS ll
        FROM ct JOIN cls USING (label), vs),
dflt AS (SELECT label, log_prior, {_ln(f'{a} / (total + {a} * vs.v)')} AS ld FROM cls, vs),
tv AS (SELECT te.doc_id, te.term, te.n FROM te SEMI JOIN vocab USING (term)),
nin AS (SELECT doc_id, sum(n) AS nin FROM tv GROUP BY doc_id),
m AS (SELECT tv.doc_id, lik.label, sum(tv.n * lik.ll) AS s, sum(tv.n) AS mt
      FROM tv JOIN lik USING (term) GROUP BY ALL),
d0 AS (SELECT doc_id, lang AS gold FROM documents WHERE doc_id % 5 = 0),
sc AS (SELECT d.doc_id, d.gold, f.label,
         f.log_prior + coalesce(m.s, 0.0)
         + CASE WHEN coalesce(nin.nin, 0) - coalesce(m.mt, 0) > 0
                THEN (coalesce(nin.nin, 0) - coalesce(m.mt, 0)) * f.ld ELSE 0.0 END AS log_score
       FROM d0 d CROSS JOIN dflt f LEFT JOIN nin ON nin.doc_id = d.doc_id
       LEFT JOIN m ON m.doc_id = d.doc_id AND m.label = f.label),
pr AS (SELECT doc_id, gold, label AS prediction FROM (
         SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY log_score DESC, label) AS r
         FROM sc) WHERE r = 1)"""


@query("class_priors", """
WITH cd AS (SELECT lang AS label, count(*) AS n_docs FROM documents WHERE doc_id % 5 <> 0 GROUP BY lang)
SELECT label, n_docs, n_docs / (SELECT sum(n_docs) FROM cd) AS prior,
       ln(n_docs / (SELECT sum(n_docs) FROM cd)) AS log_prior FROM cd""")
def q_class_priors(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("label"))
    return CL.class_priors(docs.filter(~_test()))


@query("class_term_totals", f"""WITH {nb_sql()}
SELECT ct.label, ct.term, CAST(ct.c AS BIGINT) AS count, CAST(tot.total AS BIGINT) AS total
FROM ct JOIN tot USING (label)""")
def q_class_term_totals(spark, sf):
    ct, tot = CL.class_term_totals(nb_inputs(spark, sf)["train_td"])
    return ct.join(broadcast_checked(tot), "label")  # one row per class


@query("nb_fit", f"WITH {nb_sql()} SELECT label, term, round(ll, 9) AS log_lik FROM lik")
def q_nb_fit(spark, sf):
    d = nb_inputs(spark, sf)
    lik = CL.nb_fit(d["train_td"], d["train_docs"], 1.0)["likelihood"]
    return lik.select("label", "term", F.round("log_lik", 9).alias("log_lik"))


@query("nb_predict_proba", f"""WITH {nb_sql()},
mx AS (SELECT doc_id, max(log_score) AS mx FROM sc GROUP BY doc_id),
e AS (SELECT sc.doc_id, sc.label, sc.log_score,
        CASE WHEN mx.mx > CAST('-inf' AS DOUBLE) THEN exp(sc.log_score - mx.mx) END AS e
      FROM sc JOIN mx USING (doc_id))
SELECT doc_id, label, round(log_score, 6) AS log_score,
       round(e / sum(e) OVER (PARTITION BY doc_id), 9) AS prob FROM e""")
def q_nb_predict_proba(spark, sf):
    _, _, p = nb_run(spark, sf)
    return p.select("doc_id", "label", F.round("log_score", 6).alias("log_score"),
                    F.round("prob", 9).alias("prob"))


@query("nb_predict", f"WITH {nb_sql()} SELECT doc_id, prediction, gold AS label FROM pr")
def q_nb_predict(spark, sf):
    d, _, p = nb_run(spark, sf)
    return CL.nb_argmax(p).join(d["test_docs"], "doc_id")


@query("predictions_vs_gold", f"""WITH {nb_sql()}
SELECT doc_id, prediction, gold AS label, prediction = gold AS correct FROM pr""")
def q_predictions_vs_gold(spark, sf):
    d, _, p = nb_run(spark, sf)
    j = CL.predictions_vs_gold(CL.nb_argmax(p), d["test_docs"])
    return j.withColumn("correct", F.col("prediction") == F.col("label"))


@query("accuracy", f"""WITH {nb_sql()}
SELECT avg(CAST(prediction = gold AS DOUBLE)) AS accuracy, count(*) AS n FROM pr""")
def q_accuracy(spark, sf):
    d, _, p = nb_run(spark, sf)
    return CL.accuracy(CL.nb_argmax(p).join(d["test_docs"], "doc_id"))


@query("classification_f1", f"""WITH {nb_sql()},
u AS (SELECT prediction AS cls, 1 AS p, 0 AS g, CAST(prediction = gold AS INTEGER) AS tp FROM pr
      UNION ALL SELECT gold, 0, 1, 0 FROM pr),
c AS (SELECT cls, sum(tp) AS tp, sum(p) AS np, sum(g) AS ng FROM u GROUP BY cls),
per AS (SELECT cls, coalesce(tp / NULLIF(np, 0), 0.0) AS precision,
               coalesce(tp / NULLIF(ng, 0), 0.0) AS recall FROM c),
f AS (SELECT *, CASE WHEN precision + recall > 0
                THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM per)
SELECT * FROM f UNION ALL
SELECT 'macro', avg(precision), avg(recall), avg(f1) FROM f""")
def q_classification_f1(spark, sf):
    d, _, p = nb_run(spark, sf)
    return CL.classification_f1(CL.nb_argmax(p).join(d["test_docs"], "doc_id"))


NB_SETTINGS = [
    ("unigram", dict(alpha=1.0, n=1)),
    ("no_smoothing", dict(alpha=0.0, n=1)),
    ("stopwords", dict(alpha=1.0, n=1, stop=True)),
    ("cased", dict(alpha=1.0, n=1, lower=False)),
    ("bigram", dict(alpha=1.0, n=2)),
    ("trigram", dict(alpha=1.0, n=3)),
]


def _nb_experiment_sql():
    parts = []
    for name, s in NB_SETTINGS:
        parts.append(f"""SELECT '{name}' AS setting, (SELECT v FROM vs) AS vocab_size,
  (SELECT avg(CAST(prediction = gold AS DOUBLE)) FROM pr) AS accuracy""")
        parts[-1] = f"(WITH {nb_sql(**s)} {parts[-1]})"
    return "\nUNION ALL\n".join(parts)


@query("nb_experiment", _nb_experiment_sql())
def q_nb_experiment(spark, sf):
    """Accuracy and vocabulary size under each setting.  Each token view
    (cased or lower-cased words, bigrams, trigrams) is counted for all
    settings that share it; these differ only in data: alpha and the stop list
    are applied to its counts, and one model per setting is fitted and scored
    in one plan (``by=["setting"]``).

    Counts are added up in the tasks that tokenise (``T.ngram_counts_by``):
    training counts per class, test counts per document.  A term stays in two
    columns, and both sides are dealt once by the first; fitting and scoring
    group and join them there."""
    docs = table(spark, sf, "documents").withColumnRenamed("lang", "label")
    views: dict[tuple[str, int], list[str]] = {}
    for name, s in NB_SETTINGS:
        views.setdefault(("low" if s.get("lower", True) else "cased", s.get("n", 1)), []).append(name)
    arms, left = [], set(views)
    while left:  # the longest first: its runs of one less are counted with it
        column, n = max(left, key=lambda v: v[1])
        arms.append(pairs.Arm(column, n, *(f"{column} {k}" for k in range(max(1, n - 1), n + 1))))
        left -= {(column, n), (column, n - 1)}
    # the settings of each view, exploded per row (no join on a few-valued key); a view of none has no rows
    settings = F.create_map(*[x for (column, n), names in views.items()
                              for x in (F.lit(f"{column} {n}"), F.array(*[F.lit(name) for name in names]))])
    stop = [name for name, s in NB_SETTINGS if s.get("stop")]
    tasks = gram_tasks(docs, len(arms))

    def counts(part, by, deal=None):
        arr = by_document(part.select("doc_id", "label", "text")).select(
            by, C.regex_tokens("text", T.TOKENIZERS["word"], True).alias("low"),
            C.regex_tokens("text", T.TOKENIZERS["word"], False).alias("cased"))
        return T.ngram_counts_by(arr, by, arms, deal)

    def per_setting(x, by):
        x = x.select(F.explode(settings[F.col("view")]).alias("setting"), by, "t1", "t2", F.col("cnt").alias("n"))
        return x.filter(~(F.col("setting").isin(stop) & (F.col("t2") == "") & F.col("t1").isin(ENGLISH_STOPWORDS)))

    test = cut_lineage(counts(docs.filter(_test()), "doc_id")).repartition(tasks, "t1")
    train = counts(docs.filter(~_test()), "label", tasks)
    names = F.array(*[F.lit(name) for name, _ in NB_SETTINGS])
    all_docs = docs.select("doc_id", "label", F.explode(names).alias("setting"))
    alpha = spark.createDataFrame([(name, float(s["alpha"])) for name, s in NB_SETTINGS],
                                  "setting string, alpha double")
    by, term = ["setting"], ["t1", "t2"]
    model = CL.nb_fit(per_setting(train, "label"), all_docs.filter(~_test()), alpha, term=term, by=by)
    pred = CL.nb_predict(per_setting(test, "doc_id"), all_docs.filter(_test()), model, term=term, by=by)
    acc = CL.accuracy(pred.join(all_docs.filter(_test()), ["setting", "doc_id"]), by=by)
    vs = model["classes"].filter("n_terms > 0").groupBy("setting").agg(F.max("n_terms").alias("vocab_size"))
    return acc.join(vs, "setting").select("setting", "vocab_size", "accuracy")


#: Rows that a task of the dealt counts gets before equal ones are added up, and about how many an arm makes of a character of text.
DEALT_COUNTS, COUNTS_OF_CHARACTER = 1_500_000, 0.2


def gram_tasks(docs, arms: int) -> int:
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    return max(1, math.ceil(chars * COUNTS_OF_CHARACTER * arms / DEALT_COUNTS))


@query("train_eval_split", """
WITH n AS (SELECT least(500, count(*) // 10) AS m FROM documents),
o AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS r FROM documents)
SELECT doc_id, CASE WHEN r <= (SELECT m FROM n) THEN 'eval' ELSE 'train' END AS split FROM o""")
def q_train_eval_split(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    return CL.train_eval_split(docs, "doc_id")


@query("read_split", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 100")
def q_read_split(spark, sf):
    return CL.read_split(table(spark, sf, "documents").select("doc_id", "lang"),
                         100, "doc_id")
