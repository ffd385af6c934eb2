"""Lexicons, grammar coverage, parse counting and parse trees.

A sentence's candidate categories come from a join of its words with the
lexicon; then each sentence is parsed whole inside a task (``forest.Forest``,
bit sets per span), without a shuffle or a round per sentence length.  A
grammar is small: its rules are counted before they are sent to the tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..session import broadcast_checked, cut_lineage


def lexicon_sets(lexicon: DataFrame, word="word", cat="cat") -> DataFrame:
    """Distinct words per category, sorted, as rows ``(cat, word, idx)``
    with ``idx`` the 0-based position of the word within its category.

    Rows, not one array per category: a category (a language, "Noun") can
    hold a large share of all words and must not become one group."""
    from . import ordering
    d = lexicon.select(cat, word).distinct()
    before = ordering.exclusive_prefix_sum(d.withColumn("_one", F.lit(1)), [cat, word], "_one", "_b")
    first = before.groupBy(cat).agg(F.min("_b").alias("_start"))
    return (before.join(broadcast_checked(first), cat)  # one row per category
                  .select(cat, word, (F.col("_b") - F.col("_start")).alias("idx")))


def lexicon_coverage(tokens: DataFrame, lexicon: DataFrame, term="term", word="word",
                     cat="cat") -> DataFrame:
    """Category candidates per token (``n_cats`` 0 when missing)."""
    lx = lexicon.select(F.col(word).alias(term), F.col(cat)).distinct()
    cats = lx.groupBy(term).agg(F.array_sort(F.collect_set(cat)).alias("cats"))
    j = tokens.join(cats, term, "left")
    return j.withColumn("n_cats", F.coalesce(F.size("cats"), F.lit(0)).cast("long"))


def missing_words(tokens: DataFrame, lexicon: DataFrame, term="term", word="word") -> DataFrame:
    """Tokens absent from the lexicon."""
    return tokens.join(lexicon.select(F.col(word).alias(term)).distinct(), term, "left_anti")


#: Rules that are sent to the tasks; more of them are an error.
MAX_RULES = 1_000_000


def rule_list(rules: DataFrame) -> list[tuple[str, tuple[str, ...], float]]:
    """The distinct rules ``(lhs, rhs, cost)`` in the order of their symbols;
    the cost is 0 without a column ``cost``."""
    cost = F.col("cost").cast("double") if "cost" in rules.columns else F.lit(0.0)
    rows = rules.select("lhs", "rhs", cost.alias("cost")).distinct().limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    return sorted((r.lhs, tuple(r.rhs), r.cost or 0.0) for r in rows)


def parse_trees(sentences: DataFrame, lexicon: DataFrame, rules: DataFrame, start="S", k: int = 10,
                sent="sent_id", text="text") -> DataFrame:
    """``(sent_id, n_words, n_parses, trees)`` per sentence: the number of
    parses and the first ``k`` trees in brackets, ``(S (NP (Noun fans)) ...)``.

    Trees come in ascending order of the summed ``cost`` of their rules (a
    column of ``rules``; 0 without it).  Of equal cost, a tree whose first
    part is longer comes first, then by rule, then by the order of the parts'
    own trees.  Sentences without words are left out; words outside the
    lexicon have no category.  A cycle of one-symbol rules, and a number of
    parses beyond 64 bits, are an error."""
    from .forest import Grammar
    grammar = Grammar(rule_list(rules), start)
    toks = C.posexplode_rows(sentences.select(F.col(sent).alias("sent"), text), ["sent"],
                             F.filter(F.split(F.trim(F.col(text)), r"\s+"), lambda w: w != ""), "i", "w")
    # one row per (word, sentence place) and a word's few categories; a
    # sentence's words are one row in the end, as they were at the start
    cats = lexicon.select(F.col("word").alias("w"), "cat").distinct().groupBy("w").agg(F.array_sort(F.collect_set("cat")).alias("cats"))
    placed = toks.join(broadcast_checked(cut_lineage(cats)), "w", "left")
    whole = placed.groupBy("sent").agg(F.array_sort(F.collect_list(F.struct("i", "w", "cats"))).alias("words"))

    def parse(batches):
        import pyarrow as pa
        for batch in batches:
            rows = [grammar.parse([(x["w"], x["cats"] or []) for x in words], k) for words in batch.column("words").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("sent"), pa.array(map(len, batch.column("words").to_pylist()), pa.int64()),
                 pa.array([n for n, _ in rows], pa.int64()), pa.array([t for _, t in rows], pa.list_(pa.string()))],
                names=["sent", "n_words", "n_parses", "trees"])

    kind = whole.schema["sent"].dataType.simpleString()
    return whole.mapInArrow(parse, f"sent {kind}, n_words long, n_parses long, trees array<string>").withColumnRenamed("sent", sent)


def chart_parse(sentences: DataFrame, lexicon: DataFrame, rules: DataFrame, start="S",
                sent="sent_id", text="text") -> DataFrame:
    """Number of parses per sentence (0 when none): ``(sent_id, n_words, n_parses)``."""
    return parse_trees(sentences, lexicon, rules, start, 0, sent, text).drop("trees")


def _grow(known: DataFrame, step) -> DataFrame:
    """The least fixpoint of ``known`` (one column ``sym``) under ``step``; a
    round adds a symbol, so there are no more rounds than symbols."""
    known = cut_lineage(known.distinct())
    while True:
        more = cut_lineage(step(known).distinct().join(broadcast_checked(known), "sym", "left_anti"))
        if more.isEmpty():
            return known
        known = cut_lineage(known.unionByName(more))


def rule_coverage(rules: DataFrame, lexicon: DataFrame, start="S") -> DataFrame:
    """Which rules can ever be part of a parse: ``(lhs, rhs, productive,
    reachable, usable)``.

    A symbol is productive if it is a category of the lexicon or the left
    side of a rule whose symbols are all productive; such a rule is
    productive itself.  A rule is reachable if its left side is the start or
    occurs in a reachable productive rule.  Usable rules are both."""
    r = cut_lineage(rules.select("lhs", "rhs").distinct())
    parts = r.select("lhs", "rhs", F.explode(F.array_distinct("rhs")).alias("sym"))

    def all_known(known):
        hit = parts.join(broadcast_checked(known), "sym").groupBy("lhs", "rhs").agg(F.count("*").alias("_n"))
        return hit.filter(F.col("_n") == F.size(F.array_distinct("rhs"))).drop("_n")

    productive = _grow(lexicon.select(F.col("cat").alias("sym")), lambda known: all_known(known).select(F.col("lhs").alias("sym")))
    fine = cut_lineage(all_known(productive))
    reached = _grow(r.sparkSession.createDataFrame([(start,)], "sym string"), lambda known: fine.join(
        broadcast_checked(known.withColumnRenamed("sym", "lhs")), "lhs").select(F.explode("rhs").alias("sym")))
    out = (r.join(fine.withColumn("_p", F.lit(True)), ["lhs", "rhs"], "left")
           .join(reached.select(F.col("sym").alias("lhs"), F.lit(True).alias("_r")), "lhs", "left"))
    p, q = F.coalesce("_p", F.lit(False)), F.coalesce("_r", F.lit(False))
    return out.select("lhs", "rhs", p.alias("productive"), q.alias("reachable"), (p & q).alias("usable"))


def parse_statistics(parses: DataFrame, n="n_parses") -> DataFrame:
    """Sentences by number of parses, with sentences read and share parsed."""
    by = parses.groupBy(n).agg(F.count("*").alias("n_sentences"))
    total = parses.select(F.count("*")).scalar()
    parsed = parses.select(F.avg((F.col(n) > 0).cast("double"))).scalar()
    return by.select(n, "n_sentences", total.alias("sentences_read"),
                     parsed.alias("share_parsed"))
