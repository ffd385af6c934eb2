"""Evaluation data and scores: prompts, conversations, experiment grids with
resume, best-k choice, exact match / token F1 / ROUGE, report pivots."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..functions import prompts as PR
from ..session import broadcast_checked
from .counts import counted


# ------------------------------------------------------------------ prompts
def few_shot_prompt(queries: DataFrame, examples: DataFrame, k, task: str,
                    text="text", order="ex_id") -> DataFrame:
    """Base instruction + the first ``min(k, n_examples)`` numbered examples +
    the query block.  ``k`` is an int or a column; ``k_effective`` records
    that only so many examples exist (Q17); an unknown task is an error (Q18).

    The examples' cumulative texts form a table with one row per example up
    to the largest k asked for, joined on ``k_effective``; it is broadcast
    only if it has few rows."""
    layout = PR.TASK_LAYOUTS.get(task)
    if layout is None:
        raise ValueError(f"unknown task {task!r}; use one of {sorted(PR.TASK_LAYOUTS)}")
    fields = layout["fields"]
    largest = queries.select(F.max(k)).first()[0] if isinstance(k, Column) else int(k)
    ex = examples.orderBy(order).limit(max(0, int(largest or 0)))
    n_ex = ex.select(F.count("*")).scalar()
    num = Window.orderBy(order)
    blocks = ex.select(F.row_number().over(num).alias("ke"), *fields).select(
        "ke", F.format_string(layout["example"], F.col("ke"), *[F.col(f) for f in fields])
        .alias("block"))
    upto = Window.orderBy("ke").rowsBetween(Window.unboundedPreceding, 0)
    prefixes = blocks.select("ke", F.array_join(F.collect_list("block").over(upto), "")
                             .alias("_examples"))
    prefixes = prefixes.unionByName(
        prefixes.sparkSession.range(1).select(F.lit(0).alias("ke"), F.lit("").alias("_examples")))
    kcol = k if isinstance(k, Column) else F.lit(int(k))
    base = queries.withColumn("k_effective", F.greatest(F.least(kcol, n_ex), F.lit(0)).cast("int"))
    query_block = (F.format_string(layout["query"], *[F.col(c) for c in layout["query_cols"]])
                   if layout["query_cols"] else F.lit(layout["query"]))
    j = base.join(broadcast_checked(prefixes, 64), F.col("k_effective") == F.col("ke"), "left")
    return (j.withColumn("prompt", F.concat(F.lit(layout["base"]),
                                            F.coalesce("_examples", F.lit("")), query_block))
             .drop("ke", "_examples"))


def prompt_variants(tasks: DataFrame, variants: Sequence[Mapping], text="text") -> DataFrame:
    """Each task under every variant: messages = system, optional example
    turns, then the user turn (``{task}`` in the user template is replaced by
    the task text).  Variants are a literal array, exploded per row."""
    structs = []
    for v in variants:
        ex = [F.struct(F.lit(m["role"]).alias("role"), F.lit(m["content"]).alias("content"))
              for m in v.get("examples", [])]
        structs.append(F.struct(
            F.lit(v["name"]).alias("name"), F.lit(v["system"]).alias("system"),
            F.lit(v["user"]).alias("user"),
            (F.array(*ex) if ex else F.array().cast("array<struct<role:string,content:string>>"))
            .alias("examples")))
    x = tasks.withColumn("_v", F.explode(F.array(*structs)))
    user = F.replace(F.col("_v.user"), F.lit("{task}"), F.col(text))
    msgs = F.concat(
        F.array(F.struct(F.lit("system").alias("role"), F.col("_v.system").alias("content"))),
        F.col("_v.examples"),
        F.array(F.struct(F.lit("user").alias("role"), user.alias("content"))))
    return x.withColumn("variant", F.col("_v.name")).withColumn("messages", msgs).drop("_v")


def answer_text(answers: str = "answers", kind: T.DataType | None = None) -> Column:
    """The first of ``answers.text``, else ``answers.value``, else empty, if
    the column is a struct; the value as text if it is a scalar (``kind`` is
    the column's type; without it a struct is assumed)."""
    a = F.col(answers)
    if kind is not None and not isinstance(kind, T.StructType):
        return a.cast("string")
    names = kind.names if kind is not None else ["text", "value"]
    found = [F.get(a["text"], 0)] if "text" in names else []
    found += [a["value"].cast("string")] if "value" in names else []
    return F.coalesce(*found, F.lit(""))


def label_name(label: str | Column, names) -> Column:
    """Class id to name; ``names`` is a list or an array column."""
    arr = names if isinstance(names, Column) else F.array(*[F.lit(x) for x in names])
    return F.get(arr, C.col(label))


def to_conversation(df: DataFrame, question="question", context="context",
                    answers="answers", text="text", label="label",
                    label_names="label_names", observation=None) -> DataFrame:
    """Question-answer or classification rows to system / user / assistant
    messages (``conversation``).  Rows matching neither layout get a null
    conversation and ``reject = true`` (Q21) instead of failing; an
    ``observation`` counts ``rows`` and ``rejected``.

    ``label_names`` is the list of class names, which a class id picks from,
    or the class name itself as text; without it the label is used as text."""
    cols = set(df.columns)
    msg = lambda r, c: F.struct(F.lit(r).alias("role"), c.alias("content"))
    conv = None
    if {question, answers} <= cols:
        ctx = F.coalesce(F.col(context), F.lit("")) if context in cols else F.lit("")
        user = F.concat(F.lit(PR.QA_USER_PREFIX), ctx, F.lit("\n\nQuestion: "), F.col(question))
        qa = F.array(msg("system", F.lit(PR.QA_SYSTEM)), msg("user", user),
                     msg("assistant", answer_text(answers, df.schema[answers].dataType)))
        conv = F.when(F.col(question).isNotNull() & F.col(answers).isNotNull(), qa)
    if {text, label} <= cols:
        ans = F.col(label).cast("string")
        if label_names in cols:
            listed = isinstance(df.schema[label_names].dataType, T.ArrayType)
            ans = F.coalesce(label_name(label, F.col(label_names)) if listed else F.col(label_names).cast("string"), ans)
        user = F.concat(F.lit(PR.CLS_USER_PREFIX), F.col(text), F.lit("\n\nLabel:"))
        cl = F.array(msg("system", F.lit(PR.CLS_SYSTEM)), msg("user", user), msg("assistant", ans))
        cond = F.col(text).isNotNull() & F.col(label).isNotNull()
        conv = F.when(cond, cl) if conv is None else conv.when(cond, cl)
    if conv is None:
        raise ValueError("rows have neither question/answers nor text/label columns")
    out = df.withColumn("conversation", conv).withColumn("reject", F.col("conversation").isNull())
    return counted(out, observation, rows=None, rejected=F.col("reject"))


def strip_ws(c: Column) -> Column:
    """Leading and trailing white space removed (``str.strip``; Spark's
    ``trim`` removes blanks only)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def render_chat(conv: str | Column, template: Mapping = PR.TURN_TEMPLATE,
                add_generation_prompt: bool = False) -> Column:
    """Conversation array to training text with a chat template.  A leading
    system message is folded into the first user turn (as the template the
    reference used does); the ``<bos>`` prefix is not emitted."""
    c = C.col(conv)
    roles = template["roles"]
    has_sys = F.get(c, 0)["role"] == "system"
    sys_text = F.when(has_sys, F.get(c, 0)["content"])
    turns = F.when(has_sys, F.slice(c, 2, F.size(c))).otherwise(c)
    role_map = F.create_map(*[x for k, v in roles.items() for x in (F.lit(k), F.lit(v))])

    def seg(m, i):
        prefix = F.when((i == 0) & sys_text.isNotNull(),
                        F.concat(sys_text, F.lit(template["system_sep"]))).otherwise(F.lit(""))
        return F.concat(F.lit(template["turn_start"]), F.coalesce(role_map[m["role"]], m["role"]),
                        F.lit("\n"), prefix, strip_ws(m["content"]), F.lit(template["turn_end"]))

    body = F.array_join(F.transform(turns, seg), "")
    if add_generation_prompt:
        body = F.concat(body, F.lit(template["generation_prompt"]))
    return body


# ------------------------------------------------------------- experiment grid
def experiment_grid(models: DataFrame, adapters: DataFrame | None, tasks: Sequence[str],
                    ks: Sequence[int], strategies: Sequence[str]) -> DataFrame:
    """All combinations: every base model plus each of its adapters (equi
    join on the model), times tasks, k values and decoding strategies.  The
    literal lists are exploded per row -- no cross join."""
    base = models.select("model_id", F.lit(None).cast("string").alias("adapter_id"))
    if adapters is not None:
        base = base.unionByName(adapters.join(models.select("model_id"), "model_id")
                                .select("model_id", "adapter_id"))
    return (base.withColumn("task_type", F.explode(F.array(*[F.lit(t) for t in tasks])))
                .withColumn("n_shot", F.explode(F.array(*[F.lit(int(k)) for k in ks])))
                .withColumn("decoding_strategy",
                            F.explode(F.array(*[F.lit(s) for s in strategies]))))


# ---- fixed values: the columns that identify a stored run ----
RESULT_KEYS = ("model_id", "adapter_id", "task_type", "n_shot", "decoding_strategy")


def _trim_keys(df, keys):
    return df.select(*[F.trim(F.coalesce(F.col(k).cast("string"), F.lit(""))).alias(f"_k{i}")
                       for i, k in enumerate(keys)], *df.columns)


def pending_runs(grid: DataFrame, done: DataFrame, keys: Sequence[str] = RESULT_KEYS) -> DataFrame:
    """Grid rows without a stored result; keys compared as trimmed text, a
    missing value as empty text (Q25)."""
    g = _trim_keys(grid, keys)
    d = _trim_keys(done, keys).select(*[f"_k{i}" for i in range(len(keys))]).distinct()
    return g.join(d, [f"_k{i}" for i in range(len(keys))], "left_anti").select(*grid.columns)


def pending_groups(grid: DataFrame, done: DataFrame, group: Sequence[str] = RESULT_KEYS[:3],
                   keys: Sequence[str] = RESULT_KEYS) -> DataFrame:
    """(model, adapter, task) groups having any pending run."""
    p = pending_runs(grid, done, keys).select(*[F.col(g).alias(f"_p{i}") for i, g in enumerate(group)])
    cond = None
    for i, g in enumerate(group):  # null-safe: base models have no adapter
        c = F.col(g).eqNullSafe(F.col(f"_p{i}"))
        cond = c if cond is None else cond & c
    return grid.select(*group).distinct().join(p.distinct(), cond, "left_semi")


def best_k_shot(results: DataFrame, metric_keys: Mapping[str, Sequence[str]],
                group=("model_id", "task"), task_type="task_type", k="n_shot",
                metrics="metrics", fallback_k: int = 10) -> DataFrame:
    """Per group, the k with the best metric (strictly greater, so the
    smallest k wins ties).  The metric is the first present key of the task
    type's list -- 0.0 is a value, not missing (Q19).  Groups without any
    metric fall back to ``fallback_k`` and are flagged."""
    m = F.col(metrics)
    chains = None
    for tt, keys in metric_keys.items():
        val = F.coalesce(*[m[key] for key in keys]) if len(keys) > 1 else m[keys[0]]
        chains = (F.when(F.col(task_type) == tt, val) if chains is None
                  else chains.when(F.col(task_type) == tt, val))
    scored = results.withColumn("_metric", chains.cast("double"))
    w = Window.partitionBy(*group).orderBy(F.desc_nulls_last("_metric"), F.asc(k))
    best = (scored.withColumn("_r", F.row_number().over(w)).filter("_r = 1")
                  .select(*group, F.col(k).alias("_bk"), F.col("_metric").alias("best_metric")))
    return best.select(*group,
                       F.when(F.col("best_metric").isNull(), F.lit(fallback_k))
                        .otherwise(F.col("_bk")).cast("long").alias("best_k"),
                       "best_metric",
                       F.col("best_metric").isNull().alias("fallback"))


def best_params(grid_results: DataFrame, order="grid_idx") -> DataFrame:
    """Three winners, one row each: least time, best analogy accuracy, best
    Spearman; the first grid row wins ties (Q13).  Each is one aggregate: the
    smallest (metric, position) with its row."""
    out = None
    for name, metric, sign in (("time", "train_seconds", 1.0), ("analogy", "analogy_accuracy", -1.0),
                               ("word_pairs", "spearman", -1.0)):
        rank = F.struct((F.col(metric).cast("double") * sign).alias("m"), F.col(order).alias("o"))
        best = (grid_results.filter(F.col(metric).isNotNull())
                .agg(F.min_by(F.struct("*"), rank).alias("_b")).filter("_b is not null").select("_b.*")
                .withColumn("criterion", F.lit(name)).withColumn("value", F.col(metric).cast("double")))
        out = best if out is None else out.unionByName(best)
    return out


def score_pivot(df: DataFrame, rows: Sequence[str], column: str, value: str,
                values: Sequence[str], decimals: int | None = 2) -> DataFrame:
    """Rows x dataset columns plus the row mean; listed pivot values avoid a
    second pass.  Means use decimal (half-up) rounding, as printed tables do."""
    p = df.groupBy(*rows).pivot(column, list(values)).agg(F.first(value))
    # decimal arithmetic, as printed tables are computed: 0.39, 0.57, 0.67
    # and 0.47 average to 0.525 (0.5249... in binary) and print as 0.53
    dec = "decimal(38,12)"
    total = sum((F.col(v).cast(dec) for v in values[1:]), F.col(values[0]).cast(dec))
    mean = total / F.lit(len(values)).cast(dec)
    if decimals is not None:
        mean = F.round(mean, decimals)
    return p.withColumn("mean", mean.cast("double"))


def relative_change(df: DataFrame, group: Sequence[str], order: str, value: str,
                    decimals: int | None = 0) -> DataFrame:
    """Percent change of ``value`` from the first row of its group (smallest
    ``order``), e.g. k = 0 to k = 10; null from a first value of 0.
    Half-to-even rounding when asked."""
    w = Window.partitionBy(*group).orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    chg = 100.0 * (F.try_divide(F.col(value), F.first(value).over(w)) - 1.0)
    if decimals is not None:
        chg = F.bround(chg, decimals)
    return df.withColumn("pct_change", chg)


# ------------------------------------------------------------------ scores
_PUNCT = r"""[!"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~]"""


def squad_tokens(text) -> Column:
    """Answer normalisation as tokens: lower case, ASCII punctuation removed,
    split on white space, the articles a / an / the dropped (our documented
    choice; whole-token article removal avoids regex word-boundary
    differences between engines)."""
    t = F.regexp_replace(F.lower(C.col(text)), _PUNCT, "")
    toks = F.split(F.trim(F.regexp_replace(t, r"\s+", " ")), " ")
    return F.filter(toks, lambda x: (x != "") & ~x.isin("a", "an", "the"))


def squad_normalize(text) -> Column:
    return F.array_join(squad_tokens(text), " ")


def _overlaps(ns: Sequence[int]):
    """Per row, for each n: common, predicted and reference n-grams of the
    collected token lists (n-grams do not cross from one list to the next)."""
    def bag(lists, n):
        grams: Counter = Counter()
        for toks in lists:
            toks = list(toks)
            grams.update(toks if n == 1 else zip(*[toks[i:] for i in range(n)]))
        return grams

    def fn(pred: pd.Series, gold: pd.Series) -> pd.Series:
        out = []
        for p, g in zip(pred, gold):
            row = []
            for n in ns:
                cp, cg = bag(p, n), bag(g, n)
                row.append({"_arm": n, "_common": sum(min(v, cg[t]) for t, v in cp.items() if t in cg),
                            "_np": sum(cp.values()), "_ng": sum(cg.values())})
            out.append(row)
        return pd.Series(out, dtype="object")

    return F.pandas_udf(fn, "array<struct<_arm:int,_common:long,_np:long,_ng:long>>")


def _overlap_counts(df, id_cols, ns, pred="_pt", gold="_gt"):
    """Bag overlap per id and n.  The token arrays of an id are collected
    (one row as a rule), and its n-grams counted in an Arrow-batched pandas
    UDF: they are never rows, so a task holds those of one id at a time."""
    lists = df.groupBy(*id_cols).agg(F.collect_list(pred).alias("_p"), F.collect_list(gold).alias("_g"))
    return (lists.select(*id_cols, _overlaps(list(ns))("_p", "_g").alias("_o"))
                 .select(*id_cols, F.explode("_o").alias("_o")).select(*id_cols, "_o.*"))


def _prf(counts):
    """(precision, recall, f1) columns from the overlap counts."""
    p = F.coalesce(F.try_divide(F.col("_common").cast("double"), F.col("_np")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("_common").cast("double"), F.col("_ng")), F.lit(0.0))
    return p, r, F.when(F.col("_common") > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def exact_match(df: DataFrame, pred="prediction", gold="reference", id_cols=("id",)) -> DataFrame:
    """1.0 when the normalised answers are equal, best over gold answers
    when ``gold`` is an array."""
    ids = list(id_cols)
    g = F.col(gold)
    if isinstance(df.schema[gold].dataType, T.ArrayType):
        x = df.select(*ids, pred, F.explode(g).alias("_gold"))
        gold = "_gold"
    else:
        x = df
    em = (squad_normalize(pred) == squad_normalize(gold)).cast("double")
    return x.groupBy(*ids).agg(F.max(em).alias("em"))


def token_f1(df: DataFrame, pred="prediction", gold="reference", id_cols=("id",)) -> DataFrame:
    """Token overlap F1 of normalised answers, best over gold answers; when
    either side has no token, F1 is 1 if both are empty else 0."""
    ids = list(id_cols)
    if isinstance(df.schema[gold].dataType, T.ArrayType):
        x = df.select(*ids, pred, F.posexplode(gold).alias("_gi", "_gold"))
        gold, key = "_gold", [*ids, "_gi"]
    else:
        x, key = df, ids
    toks = x.select(*key, squad_tokens(pred).alias("_pt"), squad_tokens(gold).alias("_gt"))
    counts = _overlap_counts(toks, key, [1])
    f1 = F.when((F.col("_np") == 0) | (F.col("_ng") == 0),
                ((F.col("_np") == 0) & (F.col("_ng") == 0)).cast("double")).otherwise(_prf(counts)[2])
    return counts.groupBy(*ids).agg(F.max(f1).alias("f1"))


def rouge_tokens(text) -> Column:
    """Default ROUGE tokenisation: lower case, ASCII letters and digits."""
    return F.regexp_extract_all(F.lower(C.col(text)), F.lit("[a-z0-9]+"), 0)


def rouge_ns(df: DataFrame, ns: Sequence[int], pred="prediction", gold="reference",
             id_cols=("id",)) -> DataFrame:
    """ROUGE-n for several n in one pass: ``(id..., n, precision, recall, f1)``
    (n-gram bag overlap)."""
    ids = list(id_cols)
    t = df.select(*ids, rouge_tokens(pred).alias("_pt"), rouge_tokens(gold).alias("_gt"))
    counts = _overlap_counts(t, ids, ns)
    p, r, f = _prf(counts)
    return counts.select(*ids, F.col("_arm").alias("n"), p.alias("precision"), r.alias("recall"), f.alias("f1"))


def rouge_n(df: DataFrame, n: int, pred="prediction", gold="reference", id_cols=("id",)) -> DataFrame:
    """ROUGE-n precision / recall / F1 per row (n-gram bag overlap)."""
    r = rouge_ns(df, [n], pred, gold, id_cols)
    return r.select(*id_cols, *[F.col(c).alias(f"rouge{n}_{c}") for c in ("precision", "recall", "f1")])


def lcs_length(a: Sequence, b: Sequence) -> int:
    """Longest common subsequence length, bit-parallel over the shorter
    sequence (a row of the dynamic programme per machine word)."""
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return 0
    masks: dict = {}
    for j, tok in enumerate(b):
        masks[tok] = masks.get(tok, 0) | (1 << j)
    full = (1 << len(b)) - 1
    v = full
    for tok in a:
        u = v & masks.get(tok, 0)
        v = ((v + u) | (v - u)) & full
    return len(b) - bin(v).count("1")


def _lcs_batch(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([lcs_length(list(x), list(y)) for x, y in zip(a, b)], dtype="int64")


_LCS_UDF = None


def _lcs_udf(a, b):
    """Arrow-batched LCS lengths (created lazily: a UDF needs a session)."""
    global _LCS_UDF
    if _LCS_UDF is None:
        _LCS_UDF = F.pandas_udf(_lcs_batch, T.LongType())
    return _LCS_UDF(a, b)


def rouge_l(df: DataFrame, pred="prediction", gold="reference", id_cols=("id",)) -> DataFrame:
    """ROUGE-L: longest common subsequence precision / recall / F1 per row
    on whole texts (bit-parallel LCS in an Arrow-batched pandas UDF)."""
    ids = list(id_cols)
    x = df.select(*ids, rouge_tokens(pred).alias("_p"), rouge_tokens(gold).alias("_g"))
    x = x.withColumn("_lcs", _lcs_udf("_p", "_g"))
    p = F.try_divide(F.col("_lcs").cast("double"), F.size("_p"))
    r = F.try_divide(F.col("_lcs").cast("double"), F.size("_g"))
    f = F.when(F.col("_lcs") > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
    return x.select(*ids, F.coalesce(p, F.lit(0.0)).alias("rougeL_precision"),
                    F.coalesce(r, F.lit(0.0)).alias("rougeL_recall"), f.alias("rougeL_f1"))


def mean_scores(scores: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Scores averaged over rows."""
    return scores.agg(*[F.avg(c).alias(c) for c in cols])


