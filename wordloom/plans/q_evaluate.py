"""Registered queries: prompts, conversations, answer scores, best-k choice
and report tables.  Prediction pairs are (conv_id, turn) text against
(conv_id, turn + 1) text (fixture rule)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import prompts as PR
from ..operators import evaluate as EV
from ..sources import files as SRC
from ..session import table
from .registry import query

LANGS = ["de", "en", "es", "fr"]
PUNCT_SQL = EV._PUNCT.replace("'", "''")


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _norm_sql(x: str) -> str:
    inner = (f"trim(regexp_replace(regexp_replace(lower({x}), '{PUNCT_SQL}', '', 'g'), "
             f"'\\s+', ' ', 'g'))")
    return (f"list_filter(string_split({inner}, ' '), "
            f"lambda t: t <> '' AND t NOT IN ('a', 'an', 'the'))")


def pred_pairs(spark, sf):
    c = table(spark, sf, "conversations")
    a = c.select("conv_id", "turn", F.col("text").alias("prediction"))
    b = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reference"))
    return a.join(b, ["conv_id", "turn"])


PAIRS_SQL = """pairs AS (SELECT a.conv_id, a.turn, a.text AS prediction, b.text AS reference
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)"""
IDS = ("conv_id", "turn")


@query("exact_match", f"""WITH {PAIRS_SQL}
SELECT conv_id, turn, CAST(array_to_string({_norm_sql('prediction')}, ' ')
       = array_to_string({_norm_sql('reference')}, ' ') AS DOUBLE) AS em FROM pairs""")
def q_exact_match(spark, sf):
    return EV.exact_match(pred_pairs(spark, sf), id_cols=IDS)


@query("token_f1", f"""WITH {PAIRS_SQL},
nt AS (SELECT conv_id, turn, {_norm_sql('prediction')} AS p, {_norm_sql('reference')} AS g FROM pairs),
cp AS (SELECT conv_id, turn, tok, count(*) AS c FROM (SELECT conv_id, turn, unnest(p) AS tok FROM nt) GROUP BY ALL),
cg AS (SELECT conv_id, turn, tok, count(*) AS c FROM (SELECT conv_id, turn, unnest(g) AS tok FROM nt) GROUP BY ALL),
cm AS (SELECT conv_id, turn, sum(least(cp.c, cg.c)) AS common FROM cp JOIN cg USING (conv_id, turn, tok) GROUP BY ALL),
s AS (SELECT nt.conv_id, nt.turn, len(p) AS np, len(g) AS ng, coalesce(cm.common, 0) AS common
      FROM nt LEFT JOIN cm USING (conv_id, turn))
SELECT conv_id, turn,
  CASE WHEN np = 0 OR ng = 0 THEN CAST(np = 0 AND ng = 0 AS DOUBLE)
       WHEN common = 0 THEN 0.0
       ELSE 2 * (common / np) * (common / ng) / ((common / np) + (common / ng)) END AS f1
FROM s""")
def q_token_f1(spark, sf):
    return EV.token_f1(pred_pairs(spark, sf), id_cols=IDS)


def _rouge_sql(n: int) -> str:
    tok = "regexp_extract_all(lower({x}), '[a-z0-9]+')"
    if n == 1:
        g = lambda x: f"SELECT conv_id, turn, unnest({tok.format(x=x)}) AS gram FROM pairs"
    else:
        g = lambda x: (f"SELECT conv_id, turn, array_to_string(t[i:i+{n - 1}], ' ') AS gram FROM "  # noqa: E731
                       f"(SELECT conv_id, turn, {tok.format(x=x)} AS t FROM pairs), "
                       f"range(1, CAST(len(t) AS BIGINT) - {n - 2}) r(i)")
    return f"""
gp{n} AS ({g('prediction')}), gg{n} AS ({g('reference')}),
cp{n} AS (SELECT conv_id, turn, gram, count(*) AS c FROM gp{n} GROUP BY ALL),
cg{n} AS (SELECT conv_id, turn, gram, count(*) AS c FROM gg{n} GROUP BY ALL),
np{n} AS (SELECT conv_id, turn, sum(c) AS np FROM cp{n} GROUP BY ALL),
ng{n} AS (SELECT conv_id, turn, sum(c) AS ng FROM cg{n} GROUP BY ALL),
cm{n} AS (SELECT conv_id, turn, sum(least(cp{n}.c, cg{n}.c)) AS common
          FROM cp{n} JOIN cg{n} USING (conv_id, turn, gram) GROUP BY ALL),
s{n} AS (SELECT p.conv_id, p.turn, coalesce(cm.common, 0) AS common,
          coalesce(a.np, 0) AS np, coalesce(b.ng, 0) AS ng FROM pairs p
          LEFT JOIN cm{n} cm USING (conv_id, turn) LEFT JOIN np{n} a USING (conv_id, turn)
          LEFT JOIN ng{n} b USING (conv_id, turn)),
r{n} AS (SELECT conv_id, turn, {n} AS n,
   CASE WHEN np > 0 THEN common / np ELSE 0.0 END AS precision,
   CASE WHEN ng > 0 THEN common / ng ELSE 0.0 END AS recall,
   CASE WHEN common > 0 THEN 2 * (common / np) * (common / ng) / (common / np + common / ng)
        ELSE 0.0 END AS f1 FROM s{n})"""


@query("rouge_n", f"""WITH {PAIRS_SQL}, {_rouge_sql(1)}, {_rouge_sql(2)}
SELECT * FROM r1 UNION ALL SELECT * FROM r2""")
def q_rouge_n(spark, sf):
    return EV.rouge_ns(pred_pairs(spark, sf), (1, 2), id_cols=IDS)


# longest common subsequence: after each token of the prediction, cell j holds
# the longest one with the first j tokens of the reference, as a running maximum
_LCS_SQL = f"""{PAIRS_SQL},
tk AS (SELECT conv_id, turn, regexp_extract_all(lower(prediction), '[a-z0-9]+') AS p,
              regexp_extract_all(lower(reference), '[a-z0-9]+') AS g FROM pairs),
lc(conv_id, turn, i, j, v) AS (
  SELECT conv_id, turn, 0, CAST(j AS INTEGER), 0 FROM tk, range(0, CAST(len(g) AS BIGINT) + 1) r(j)
  UNION ALL
  SELECT conv_id, turn, i, j, max(greatest(v, u)) OVER (PARTITION BY conv_id, turn ORDER BY j) FROM (
    SELECT lc.conv_id, lc.turn, lc.i + 1 AS i, lc.j, lc.v,
           CASE WHEN lc.j > 0 AND tk.p[lc.i + 1] = tk.g[lc.j]
                THEN lag(lc.v) OVER (PARTITION BY lc.conv_id, lc.turn ORDER BY lc.j) + 1 ELSE 0 END AS u
    FROM lc JOIN tk USING (conv_id, turn) WHERE lc.i < len(tk.p))),
rl AS (SELECT tk.conv_id, tk.turn, lc.v AS l, len(p) AS np, len(g) AS ng
       FROM tk JOIN lc ON lc.conv_id = tk.conv_id AND lc.turn = tk.turn AND lc.i = len(p) AND lc.j = len(g)),
rls AS (SELECT conv_id, turn, CASE WHEN np > 0 THEN l / np ELSE 0.0 END AS precision,
               CASE WHEN ng > 0 THEN l / ng ELSE 0.0 END AS recall,
               CASE WHEN l > 0 THEN 2 * (l / np) * (l / ng) / (l / np + l / ng) ELSE 0.0 END AS f1 FROM rl)"""


@query("rouge_l", f"""WITH RECURSIVE {_LCS_SQL}
SELECT conv_id, turn, precision AS "rougeL_precision", recall AS "rougeL_recall", f1 AS "rougeL_f1" FROM rls""")
def q_rouge_l(spark, sf):
    return EV.rouge_l(pred_pairs(spark, sf), id_cols=IDS)


@query("rouge_summary", f"""WITH RECURSIVE {_LCS_SQL}, {_rouge_sql(1)}, {_rouge_sql(2)}
SELECT (SELECT avg(f1) FROM r1) AS rouge1_f1, (SELECT avg(f1) FROM r2) AS rouge2_f1,
       (SELECT avg(f1) FROM rls) AS "rougeL_f1"
""")
def q_rouge_summary(spark, sf):
    p = pred_pairs(spark, sf)
    scores = (EV.rouge_ns(p, (1, 2), id_cols=IDS).select(F.col("n").cast("string").alias("n"), "f1")
              .unionByName(EV.rouge_l(p, id_cols=IDS).select(F.lit("L").alias("n"), F.col("rougeL_f1").alias("f1"))))
    return scores.agg(*[F.avg(F.when(F.col("n") == n, F.col("f1"))).alias(f"rouge{n}_f1") for n in ("1", "2", "L")])


def _examples(spark):
    return spark.createDataFrame(
        [(i + 1, t, lab) for i, (t, lab) in enumerate(PR.CLASSIFICATION_EXAMPLES)],
        "ex_id int, text string, label string")


_EX_VALUES = ", ".join(f"({i + 1}, {_lit(t)}, {_lit(lab)})"
                       for i, (t, lab) in enumerate(PR.CLASSIFICATION_EXAMPLES))
_BASE = _lit(PR.TASK_LAYOUTS["classification"]["base"])


@query("few_shot_prompt", f"""
WITH ex(i, text, label) AS (VALUES {_EX_VALUES}),
ks(k) AS (VALUES (0), (5), (10), (25)),
kb AS (SELECT k, least(k, (SELECT count(*) FROM ex)) AS ke,
  coalesce((SELECT string_agg(chr(10) || 'Example ' || i || ':' || chr(10) || 'Text: ' || text
            || chr(10) || 'Category: ' || label || chr(10), '' ORDER BY i)
            FROM ex WHERE i <= ks.k), '') AS exs FROM ks)
SELECT d.doc_id, CAST(kb.k AS INTEGER) AS k, CAST(kb.ke AS INTEGER) AS k_effective,
  {_BASE} || kb.exs || chr(10) || 'Text: ' || d.text || chr(10) || 'Category:' AS prompt
FROM documents d, kb""")
def q_few_shot_prompt(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    q = docs.withColumn("k", F.explode(F.array(*[F.lit(k) for k in (0, 5, 10, 25)])))
    res = EV.few_shot_prompt(q, _examples(spark), F.col("k"), "classification")
    return res.select("doc_id", "k", F.col("k_effective").cast("int"), "prompt")


_QA_EX_VALUES = ", ".join(f"({i + 1}, {_lit(c)}, {_lit(q)}, {_lit(a)})"
                          for i, (c, q, a) in enumerate(PR.QA_EXAMPLES))
_QA_BASE = _lit(PR.TASK_LAYOUTS["question_answering"]["base"])


@query("few_shot_prompt_qa", f"""
WITH ex(i, context, question, answer) AS (VALUES {_QA_EX_VALUES}),
ks(k) AS (VALUES (0), (2), (100)),
kb AS (SELECT k, least(k, (SELECT count(*) FROM ex)) AS ke,
  coalesce((SELECT string_agg(chr(10) || 'Example ' || i || ':' || chr(10) || 'Context: ' || context || chr(10)
            || 'Question: ' || question || chr(10) || 'Answer: ' || answer || chr(10), '' ORDER BY i)
            FROM ex WHERE i <= ks.k), '') AS exs FROM ks)
SELECT c.conv_id, c.turn, CAST(kb.k AS INTEGER) AS k, CAST(kb.ke AS INTEGER) AS k_effective,
  {_QA_BASE} || kb.exs || chr(10) || 'Context: ' || b.text || chr(10) || 'Question: ' || c.text || chr(10) || 'Answer:' AS prompt
FROM conversations c JOIN benchmark b ON b.item_id = c.conv_id, kb WHERE c.role = 'user'""")
def q_few_shot_prompt_qa(spark, sf):
    """The user turns of a conversation as questions about the benchmark
    passage with its number."""
    ex = spark.createDataFrame([(i + 1, *e) for i, e in enumerate(PR.QA_EXAMPLES)],
                               "ex_id int, context string, question string, answer string")
    b = table(spark, sf, "benchmark").select(F.col("item_id").alias("conv_id"), F.col("text").alias("context"))
    q = (table(spark, sf, "conversations").filter("role = 'user'").join(b, "conv_id")
         .select("conv_id", "turn", "context", F.col("text").alias("question"),
                 F.explode(F.array(*[F.lit(k) for k in (0, 2, 100)])).alias("k")))
    res = EV.few_shot_prompt(q, ex, F.col("k"), "question_answering")
    return res.select("conv_id", "turn", "k", F.col("k_effective").cast("int"), "prompt")


def _strip_sql(x):
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _variant_sql():
    parts = []
    for v in PR.PROMPT_VARIANTS:
        user = _lit(v["user"]).replace("{task}", "' || text || '")
        turns = [(m["role"], _lit(m["content"])) for m in v.get("examples", [])] + [("user", user)]
        segs = []
        for i, (role, content) in enumerate(turns):
            r = "model" if role == "assistant" else role
            pre = f"{_lit(v['system'])} || chr(10) || chr(10) || " if i == 0 else ""
            segs.append(f"'<start_of_turn>{r}' || chr(10) || {pre}{_strip_sql(content)} "
                        f"|| '<end_of_turn>' || chr(10)")
        parts.append(f"SELECT item_id, {_lit(v['name'])} AS variant, "
                     f"CAST({len(turns) + 1} AS INTEGER) AS n_messages, "
                     f"{' || '.join(segs)} AS rendered FROM benchmark")
    return "\nUNION ALL\n".join(parts)


@query("prompt_variants", _variant_sql())
def q_prompt_variants(spark, sf):
    tasks = table(spark, sf, "benchmark")
    v = EV.prompt_variants(tasks, PR.PROMPT_VARIANTS)
    return v.select("item_id", "variant", F.size("messages").alias("n_messages"),
                    EV.render_chat("messages").alias("rendered"))


def _cls_rows(spark, sf):
    docs = table(spark, sf, "documents")
    names = F.array(*[F.lit(x) for x in LANGS])
    return docs.select("doc_id", "text",
                       (F.array_position(names, F.col("lang")) - 1).cast("int").alias("label"),
                       names.alias("label_names"))


_LANGS_SQL = "[" + ", ".join(_lit(x) for x in LANGS) + "]"


@query("label_name", f"""
SELECT doc_id, CAST(list_position({_LANGS_SQL}, lang) - 1 AS INTEGER) AS label,
       {_LANGS_SQL}[list_position({_LANGS_SQL}, lang)] AS label_name FROM documents""")
def q_label_name(spark, sf):
    r = _cls_rows(spark, sf)
    return r.select("doc_id", "label", EV.label_name("label", F.col("label_names")).alias("label_name"))


@query("to_conversation", f"""
SELECT doc_id, {_lit(PR.CLS_SYSTEM)} AS system,
  {_lit(PR.CLS_USER_PREFIX)} || text || chr(10) || chr(10) || 'Label:' AS "user",
  lang AS assistant, false AS reject FROM documents""")
def q_to_conversation(spark, sf):
    c = EV.to_conversation(_cls_rows(spark, sf))
    return c.select("doc_id", F.col("conversation")[0]["content"].alias("system"),
                    F.col("conversation")[1]["content"].alias("user"),
                    F.col("conversation")[2]["content"].alias("assistant"), "reject")


@query("render_chat", f"""
WITH s AS (SELECT conv_id, text AS sys FROM conversations WHERE turn = 0 AND role = 'system'),
t AS (SELECT c.*, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn
      FROM conversations c WHERE NOT (turn = 0 AND role = 'system'))
SELECT t.conv_id, string_agg('<start_of_turn>' || CASE role WHEN 'assistant' THEN 'model' ELSE role END
   || chr(10) || CASE WHEN rn = 1 AND s.sys IS NOT NULL THEN s.sys || chr(10) || chr(10) ELSE '' END
   || {_strip_sql('t.text')} || '<end_of_turn>' || chr(10), '' ORDER BY turn) AS rendered
FROM t LEFT JOIN s USING (conv_id) GROUP BY t.conv_id""")
def q_render_chat(spark, sf):
    c = table(spark, sf, "conversations")
    conv = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(
        F.struct("turn", "role", F.col("text").alias("content")))).alias("_t"))
    conv = conv.select("conv_id", F.transform("_t", lambda m: F.struct(
        m["role"].alias("role"), m["content"].alias("content"))).alias("conversation"))
    return conv.select("conv_id", EV.render_chat("conversation").alias("rendered"))


def _event_results(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select(F.col("event_type").alias("model_id"),
                     F.col("user_id").cast("string").alias("task"),
                     F.lit("classification").alias("task_type"),
                     F.dayofmonth("ts").alias("n_shot"),
                     F.from_json("props", "map<string,double>").alias("metrics"))


@query("best_k_shot", """
WITH r AS (SELECT event_type AS model_id, CAST(user_id AS VARCHAR) AS task, day(ts) AS n_shot,
             CAST(props->>'$.k' AS DOUBLE) AS metric FROM events),
b AS (SELECT *, row_number() OVER (PARTITION BY model_id, task
                                   ORDER BY metric DESC NULLS LAST, n_shot) AS rn FROM r)
SELECT model_id, task, CAST(CASE WHEN metric IS NULL THEN 10 ELSE n_shot END AS BIGINT) AS best_k,
       metric AS best_metric, metric IS NULL AS fallback FROM b WHERE rn = 1""")
def q_best_k_shot(spark, sf):
    keys = {"classification": ["acc_norm,none", "acc_norm", "acc", "k"],
            "question_answering": ["em,none", "em", "f1,none", "f1"]}
    return EV.best_k_shot(_event_results(spark, sf), keys, group=("model_id", "task"))


@query("valid_results", """
SELECT event_id, coalesce(json_valid(props) AND json_type(props) = 'OBJECT'
  AND list_has_any(json_keys(props), ['acc', 'acc_norm', 'em', 'f1', 'k']), false) AS valid
FROM events""")
def q_valid_results(spark, sf):
    ev = table(spark, sf, "events").select("event_id", F.col("props").alias("json"))
    return SRC.valid_results(ev, ["acc", "acc_norm", "em", "f1", "k"]).select("event_id", "valid")


#: Means from exact decimal sums: the same double however the rows are dealt.
_MEAN_SQL = "CAST(sum(CAST(value AS DECIMAL(18, 6))) AS DOUBLE) / count(value)"


def _mean(column):
    return F.sum(F.col(column).cast("decimal(18,6)")).cast("double") / F.count(column)


WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


@query("score_pivot", f"""
WITH c AS (SELECT event_type, strftime(ts, '%a') AS wd, {_MEAN_SQL} AS v FROM events GROUP BY ALL),
p AS (SELECT event_type, {', '.join(f"max(CASE WHEN wd = '{d}' THEN v END) AS {d}" for d in WEEKDAYS)}
      FROM c GROUP BY event_type)
SELECT *, round(({' + '.join(WEEKDAYS)}) / 7.0, 2) AS mean FROM p""")
def q_score_pivot(spark, sf):
    ev = table(spark, sf, "events")
    cells = ev.groupBy("event_type", F.date_format("ts", "E").alias("wd")).agg(
        _mean("value").alias("v"))
    return EV.score_pivot(cells, ["event_type"], "wd", "v", WEEKDAYS, 2)


@query("relative_change", f"""
WITH c AS (SELECT event_type, day(ts) AS day, {_MEAN_SQL} AS value FROM events GROUP BY ALL)
SELECT event_type, day, value,
  100.0 * (value / first_value(value) OVER (PARTITION BY event_type ORDER BY day) - 1.0) AS pct_change
FROM c""")
def q_relative_change(spark, sf):
    ev = table(spark, sf, "events")
    c = ev.groupBy("event_type", F.dayofmonth("ts").alias("day")).agg(_mean("value").alias("value"))
    return EV.relative_change(c, ["event_type"], "day", "value", decimals=None)


# ------------------------------------------------------------ grid and resume
TASKS = ["classification", "question_answering"]
KS = [0, 5, 10, 25]
STRATEGIES = ["default", "greedy", "beam", "top_p"]


def _grid(spark, sf):
    ev = table(spark, sf, "events")
    models = ev.select(F.col("event_type").alias("model_id")).distinct()
    adapters = models.select("model_id", F.concat("model_id", F.lit("-lora")).alias("adapter_id"))
    return EV.experiment_grid(models, adapters, TASKS, KS, STRATEGIES)


_GRID_SQL = f"""m AS (SELECT DISTINCT event_type AS model_id FROM events),
b AS (SELECT model_id, CAST(NULL AS VARCHAR) AS adapter_id FROM m
      UNION ALL SELECT model_id, model_id || '-lora' FROM m),
g AS (SELECT b.model_id, b.adapter_id, t.task_type, CAST(k.n_shot AS INTEGER) AS n_shot,
             s.decoding_strategy
      FROM b, (VALUES {', '.join(f"('{t}')" for t in TASKS)}) t(task_type),
      (VALUES {', '.join(f'({k})' for k in KS)}) k(n_shot),
      (VALUES {', '.join(f"('{s}')" for s in STRATEGIES)}) s(decoding_strategy))"""


@query("experiment_grid", f"WITH {_GRID_SQL} SELECT * FROM g")
def q_experiment_grid(spark, sf):
    return _grid(spark, sf)


def _done(spark, sf):
    """Stored results derived from events, keys padded with blanks (Q25)."""
    ev = table(spark, sf, "events")
    ks = F.array(*[F.lit(k) for k in KS])
    st = F.array(*[F.lit(s) for s in STRATEGIES])
    return ev.select(
        F.concat(F.lit(" "), "event_type", F.lit(" ")).alias("model_id"),
        F.when(F.col("user_id") % 2 == 0, F.concat("event_type", F.lit("-lora"))).alias("adapter_id"),
        F.when(F.col("value") > 300, F.lit("classification"))
         .otherwise(F.lit("question_answering ")).alias("task_type"),
        F.element_at(ks, (F.col("user_id") % 4 + 1).cast("int")).cast("string").alias("n_shot"),
        F.element_at(st, (F.hour("ts") % 4 + 1).cast("int")).alias("decoding_strategy"))


@query("pending_runs", f"""WITH {_GRID_SQL},
d AS (SELECT DISTINCT trim(' ' || event_type || ' ') AS k0,
        coalesce(CASE WHEN user_id % 2 = 0 THEN event_type || '-lora' END, '') AS k1,
        trim(CASE WHEN value > 300 THEN 'classification' ELSE 'question_answering ' END) AS k2,
        CAST([{', '.join(str(k) for k in KS)}][user_id % 4 + 1] AS VARCHAR) AS k3,
        [{', '.join(f"'{s}'" for s in STRATEGIES)}][hour(ts) % 4 + 1] AS k4 FROM events)
SELECT g.* FROM g WHERE NOT EXISTS (
  SELECT 1 FROM d WHERE d.k0 = g.model_id AND d.k1 = coalesce(g.adapter_id, '')
    AND d.k2 = g.task_type AND d.k3 = CAST(g.n_shot AS VARCHAR) AND d.k4 = g.decoding_strategy)""")
def q_pending_runs(spark, sf):
    return EV.pending_runs(_grid(spark, sf), _done(spark, sf))


_QA_CONV_SQL = f"""
WITH s AS (SELECT conv_id, text AS sys FROM conversations WHERE role = 'system'),
q AS (SELECT u.conv_id, u.turn, u.text AS question, coalesce(s.sys, '') AS context, a.text AS answer
      FROM conversations u LEFT JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
        AND a.role = 'assistant'
      LEFT JOIN s ON s.conv_id = u.conv_id WHERE u.role = 'user')
SELECT conv_id, turn, CASE WHEN answer IS NOT NULL THEN {_lit(PR.QA_SYSTEM)} END AS system,
  CASE WHEN answer IS NOT NULL THEN {_lit(PR.QA_USER_PREFIX)} || context || chr(10) || chr(10) || 'Question: ' || question END AS "user",
  answer AS assistant, answer IS NULL AS reject FROM q"""


def _qa_rows(spark, sf):
    """Every user turn with the assistant turn after it, if there is one."""
    c = table(spark, sf, "conversations")
    sys_ = c.filter(F.col("role") == "system").select("conv_id", F.col("text").alias("context"))
    u = c.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    a = c.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("_ans"))
    return u.join(a, ["conv_id", "turn"], "left").join(sys_, "conv_id", "left")


def _turns(conv):
    text = lambda i: F.col("conversation")[i]["content"]
    return conv.select("conv_id", "turn", text(0).alias("system"), text(1).alias("user"),
                       text(2).alias("assistant"), "reject")


@query("to_conversation_qa", _QA_CONV_SQL)
def q_to_conversation_qa(spark, sf):
    """Answers as a struct; questions without an answer are rejected."""
    answers = F.when(F.col("_ans").isNotNull(), F.struct(
        F.array("_ans").alias("text"), F.lit(None).cast("string").alias("value")))
    return _turns(EV.to_conversation(_qa_rows(spark, sf).withColumn("answers", answers)))


@query("to_conversation_scalar", _QA_CONV_SQL)
def q_to_conversation_scalar(spark, sf):
    """Answers as plain text."""
    return _turns(EV.to_conversation(_qa_rows(spark, sf).withColumnRenamed("_ans", "answers")))


@query("to_conversation_names", f"""
SELECT doc_id, {_lit(PR.CLS_SYSTEM)} AS system,
  {_lit(PR.CLS_USER_PREFIX)} || text || chr(10) || chr(10) || 'Label:' AS "user",
  lang AS assistant, false AS reject FROM documents""")
def q_to_conversation_names(spark, sf):
    """The class name carried as text next to the class id."""
    rows = _cls_rows(spark, sf).withColumn("label_names", EV.label_name("label", F.col("label_names")))
    c = EV.to_conversation(rows)
    return c.select("doc_id", F.col("conversation")[0]["content"].alias("system"),
                    F.col("conversation")[1]["content"].alias("user"),
                    F.col("conversation")[2]["content"].alias("assistant"), "reject")


@query("best_params", """
WITH g AS (SELECT user_id % 16 AS grid_idx, min(value) AS train_seconds, count(DISTINCT event_type) / 5 AS analogy_accuracy,
                  max(value) AS spearman FROM events GROUP BY 1)
SELECT 'time' AS criterion, arg_min(grid_idx, (train_seconds, grid_idx)) AS grid_idx, min(train_seconds) AS value FROM g
UNION ALL SELECT 'analogy', arg_min(grid_idx, (-analogy_accuracy, grid_idx)), max(analogy_accuracy) FROM g
UNION ALL SELECT 'word_pairs', arg_min(grid_idx, (-spearman, grid_idx)), max(spearman) FROM g""")
def q_best_params(spark, sf):
    """Winners of a score table that is fixed by the events (ties included)."""
    grid = table(spark, sf, "events").groupBy((F.col("user_id") % 16).alias("grid_idx")).agg(
        F.min("value").alias("train_seconds"), (F.count_distinct("event_type") / 5).alias("analogy_accuracy"),
        F.max("value").alias("spearman"))
    return EV.best_params(grid).select("criterion", "grid_idx", "value")
