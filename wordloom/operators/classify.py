"""Multinomial naive Bayes and classification metrics on coordinate
DataFrames.  The model is two small tables -- per class and per
(class, term) -- and scoring is a join plus an aggregate, never a matrix."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_checked, cut_lineage
from .selection import first_rows, mark_first

NEG_INF = float("-inf")


def _safe_ln(x) -> F.Column:
    """ln with ln(0) = -infinity (Spark's ln(0) is null, Q2)."""
    return F.when(x > 0, F.log(x)).when(x == 0, F.lit(NEG_INF))


def class_priors(docs: DataFrame, label="label",
                 class_prior: Mapping[str, float] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Class share of training documents (per ``by`` group), or supplied
    weights normalised."""
    by = list(by)
    counts = docs.groupBy(*by, label).agg(F.count("*").alias("n_docs"))
    if class_prior is None:
        # one row per class (and group): a window over these few rows, not a
        # second pass over the documents
        prior = F.col("n_docs") / F.sum("n_docs").over(Window.partitionBy(*by))
    else:
        weights = F.create_map(*[x for k, v in class_prior.items() for x in (F.lit(k), F.lit(float(v)))])
        prior = weights[F.col(label).cast("string")] / F.lit(float(sum(class_prior.values())))
    return counts.select(*by, label, "n_docs", prior.alias("prior"),
                         _safe_ln(prior).alias("log_prior"))


def _terms(term: str | Sequence[str]) -> list[str]:
    return [term] if isinstance(term, str) else list(term)


def class_term_totals(td: DataFrame, label="label", term: str | Sequence[str] = "term", n="n", by: Sequence[str] = ()):
    """Tokens per (class, term) and per class."""
    ct = td.groupBy(*by, label, *_terms(term)).agg(F.sum(n).alias("count"))
    tot = ct.groupBy(*by, label).agg(F.sum("count").alias("total"))
    return ct, tot


def nb_fit(td: DataFrame, docs: DataFrame, alpha: float | DataFrame = 1.0, label="label",
           term: str | Sequence[str] = "term", n="n", class_prior=None, by: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Fit on training counts ``td (by..., doc_id, label, term, n)`` and
    training documents ``docs (by..., doc_id, label)``.

    Returns ``classes (by..., label, log_prior, n_docs, total, n_terms, log_default)``
    (``n_terms``: size of the vocabulary), ``likelihood (by..., label, term, log_lik)`` for observed pairs and
    ``vocab (by..., term)``.  log_lik = ln((count + alpha) / (total + alpha V));
    ``log_default`` is the same with count 0 (-infinity when alpha = 0, and
    where a class has no tokens and alpha or the vocabulary leaves nothing).

    ``by`` fits one model per group in the same plan (e.g. a grid of
    settings as data); ``alpha`` is then a number or a DataFrame
    ``(by..., alpha)``.  A term may be several columns; rows that come dealt
    by one of them are not shuffled again.
    """
    by = list(by)
    keys = [*_terms(term), *by]
    ct, _ = class_term_totals(td, label, term, n, by)
    vocab = ct.select(*keys).distinct()
    # a term is new in its first class: one pass over the counts gives the classes' totals and the vocabulary's size
    new = (F.row_number().over(Window.partitionBy(*keys).orderBy(label)) == 1).cast("long")
    tot = cut_lineage(ct.withColumn("_new", new).groupBy(*by, label).agg(F.sum("count").alias("total"), F.sum("_new").alias("_v")))
    pri = class_priors(docs, label, class_prior, by)
    classes = pri.join(tot.drop("_v"), [*by, label], "left").fillna(0, ["total"])
    if by:
        classes = classes.join(tot.groupBy(*by).agg(F.sum("_v").alias("_v")), by, "left")
        v_size = F.coalesce(F.col("_v"), F.lit(0))
    else:
        v_size = tot.select(F.coalesce(F.sum("_v"), F.lit(0))).scalar()
    if isinstance(alpha, DataFrame):
        classes = classes.join(alpha.select(*by, F.col("alpha").cast("double").alias("_alpha")), by)
        a = F.col("_alpha")
    else:
        classes = classes.withColumn("_alpha", F.lit(float(alpha)))
        a = F.col("_alpha")
    classes = classes.withColumn("_denom", F.col("total") + a * v_size)
    classes = classes.select(*by, label, "log_prior", "n_docs", "total", v_size.alias("n_terms"), "_alpha", "_denom",
                             F.coalesce(_safe_ln(F.try_divide(a, F.col("_denom"))), F.lit(NEG_INF)).alias("log_default"))
    # one row per class: broadcast after that is checked, so the few labels
    # never decide how the (class, term) rows are dealt
    classes = cut_lineage(classes)
    lik = (ct.join(broadcast_checked(classes.select(*by, label, "_alpha", "_denom")), [*by, label])
             .select(*by, label, *_terms(term),
                     _safe_ln(F.try_divide(F.col("count") + F.col("_alpha"), F.col("_denom"))).alias("log_lik")))
    return {"classes": classes.drop("_alpha", "_denom"), "likelihood": lik, "vocab": vocab}


def nb_predict_proba(td: DataFrame, docs: DataFrame, model: dict[str, DataFrame],
                     id_col="doc_id", label="label", term: str | Sequence[str] = "term", n="n",
                     by: Sequence[str] = (), max_classes: int = 10_000) -> DataFrame:
    """Per (document, class): ``log_score`` and ``prob``.

    Only terms present in the document are summed (out-of-vocabulary terms
    ignored); a term unseen in a class contributes ``log_default``.  Scores
    are shifted by the document maximum before exponentiating; when every
    class is -infinity the probabilities are null (Q2).  Documents without
    known terms keep the prior.  Without ``by``, every class is attached to
    every document through a scalar subquery holding the classes, not a join
    (more than ``max_classes`` are an error); with ``by`` through an
    equi-join on the group.  A term may be several columns; if ``td`` and
    the model come dealt by one of them over as many tasks, neither is
    shuffled again.
    """
    by = list(by)
    classes = model["classes"]
    if classes.limit(max_classes + 1).count() > max_classes:
        raise ValueError(f"more than {max_classes} classes")
    # a term's counts and its likelihoods in one group: the counts get the likelihoods of
    # all classes; the first of these also counts the term as known
    keys = [*_terms(term), *by]  # the term first: it tells rows apart in a sort
    none = lambda c, of: F.lit(None).cast(of.schema[c].dataType).alias(c)
    lik = model["likelihood"].dropna(subset=keys)
    met = td.select(*keys, id_col, n, none(label, lik), none("log_lik", lik), F.lit(True).alias("_td")).dropna(subset=keys).union(
        lik.select(*keys, none(id_col, td), none(n, td), label, "log_lik", F.lit(False).alias("_td")))
    of_term = F.collect_list(F.when(~F.col("_td"), F.struct(label, "log_lik"))).over(Window.partitionBy(*keys))
    matched = (met.withColumn("_l", of_term).filter("_td")
                  .select(*by, id_col, n, F.posexplode("_l").alias("_i", "_l")).select(*by, id_col, n, "_i", f"_l.{label}", "_l.log_lik")
                  .groupBy(*by, id_col, label)
                  .agg(F.sum(F.col(n) * F.col("log_lik")).alias("_s"), F.sum(n).alias("_m"),
                       F.sum(F.when(F.col("_i") == 0, F.col(n))).alias("_f")))
    if by:
        few = broadcast_checked(classes.select(*by, label, "log_prior", "log_default"))
        grid = docs.select(*by, id_col).distinct().join(few, by)
    else:
        cls_arr = classes.select(F.array_sort(F.collect_list(
            F.struct(F.col(label).alias("label"), "log_prior", "log_default")))).scalar()
        grid = (docs.select(id_col).distinct()
                    .select(id_col, F.explode(cls_arr).alias("c"))
                    .select(id_col, F.col("c.label").alias(label), "c.log_prior", "c.log_default"))
    of_doc = Window.partitionBy(*by, id_col)
    unseen = F.coalesce(F.sum("_f").over(of_doc), F.lit(0)) - F.coalesce(F.col("_m"), F.lit(0))
    score = (F.col("log_prior") + F.coalesce(F.col("_s"), F.lit(0.0))
             + F.when(unseen > 0, unseen * F.col("log_default")).otherwise(F.lit(0.0)))
    scored = (grid.join(matched, [*by, id_col, label], "left")
                  .select(*by, id_col, label, score.alias("log_score")))
    w = Window.partitionBy(*by, id_col)
    shifted = F.when(F.col("_mx") > F.lit(NEG_INF), F.col("log_score") - F.col("_mx"))
    return (scored.withColumn("_mx", F.max("log_score").over(w))
                  .withColumn("_e", F.exp(shifted))
                  .withColumn("prob", F.col("_e") / F.sum("_e").over(w))
                  .drop("_mx", "_e"))


def nb_argmax(proba: DataFrame, id_col="doc_id", label="label", score="log_score",
              out="prediction", by: Sequence[str] = ()) -> DataFrame:
    """Class with the largest score per document; smallest class on ties."""
    w = Window.partitionBy(*by, id_col).orderBy(F.desc(score), F.asc(label))
    return (proba.withColumn("_r", F.row_number().over(w)).filter("_r = 1")
                 .select(*by, id_col, F.col(label).alias(out)))


def nb_predict(td, docs, model, id_col="doc_id", label="label", by: Sequence[str] = (),
               **kw) -> DataFrame:
    return nb_argmax(nb_predict_proba(td, docs, model, id_col, label, by=by, **kw),
                     id_col, label, by=by)


def predictions_vs_gold(pred: DataFrame, gold: DataFrame, id_col="doc_id") -> DataFrame:
    """Align predictions with labels by id (never by position)."""
    return pred.join(gold, id_col)


def accuracy(df: DataFrame, pred="prediction", gold="label", by: Sequence[str] = ()) -> DataFrame:
    """Share of equal labels (a fraction, not a percentage)."""
    return df.groupBy(*by).agg(F.avg((F.col(pred) == F.col(gold)).cast("double")).alias("accuracy"),
                  F.count("*").alias("n"))


def classification_f1(df: DataFrame, pred="prediction", gold="label") -> DataFrame:
    """Per-class precision, recall and F1, plus a ``macro`` row (mean over
    classes).  Confusion counts come from one grouped pass."""
    # one pass: each row counts once as predicted and once as gold
    roles = F.array(
        F.struct(F.col(pred).cast("string").alias("cls"), F.lit(1).alias("_p"), F.lit(0).alias("_g"),
                 (F.col(pred) == F.col(gold)).cast("int").alias("_tp")),
        F.struct(F.col(gold).cast("string").alias("cls"), F.lit(0).alias("_p"), F.lit(1).alias("_g"),
                 F.lit(0).alias("_tp")))
    c = df.select(F.explode(roles).alias("_r")).select("_r.*").groupBy("cls").agg(F.sum("_tp").alias("tp"),
                                            F.sum("_p").alias("n_pred"),
                                            F.sum("_g").alias("n_gold"))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("n_pred")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("n_gold")), F.lit(0.0))
    per = c.select("cls", prec.alias("precision"), rec.alias("recall"))
    per = per.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                      2 * F.col("precision") * F.col("recall")
                                      / (F.col("precision") + F.col("recall"))).otherwise(0.0))
    # per-class rows and the macro row from one rollup: each class group
    # averages its single row, the grand total averages the classes (a union
    # with a separate aggregate would evaluate the predictions twice)
    r = per.rollup("cls").agg(F.avg("precision").alias("precision"),
                              F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                              F.grouping("cls").alias("_g"))
    return r.select(F.when(F.col("_g") == 1, F.lit("macro")).otherwise(F.col("cls")).alias("cls"),
                    "precision", "recall", "f1")


def train_eval_split(df: DataFrame, order: str, n_train: int | None = None,
                     n_eval: int | None = None, eval_df: DataFrame | None = None,
                     max_eval: int = 500) -> DataFrame:
    """Sized head slices with a ``split`` column (Q22 made explicit).

    With ``eval_df`` the evaluation part is its first ``n_eval`` rows (500 by
    default) and training is the first ``n_train`` rows of ``df``.  Without
    it, evaluation is the head ``min(max_eval, total div 10)`` of ``df`` and
    training the rest.  The border is found by histograms of the order column
    (ties by a hash of the row), so nothing is sorted, numbered or written,
    and rows with equal ``order`` stay.
    """
    train = df if n_train is None else first_rows(df, n_train, order)
    if eval_df is not None:
        ev = first_rows(eval_df, n_eval if n_eval is not None else max_eval, order)
        return (train.withColumn("split", F.lit("train"))
                .unionByName(ev.withColumn("split", F.lit("eval"))))
    size = min(max_eval, train.count() // 10)
    return (mark_first(train, size, order, "__eval")
            .withColumn("split", F.when(F.col("__eval"), "eval").otherwise("train")).drop("__eval"))


def read_split(df: DataFrame, n: int, order: str) -> DataFrame:
    """First n rows of a named split in a stable order."""
    return first_rows(df, n, order)
