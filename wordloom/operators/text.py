"""Text operators: tokenisers, regex mining, normalisation and counts.

Token tables are long form ``(ids..., pos, term)``: one row per token, so a
20,000-word document is 20,000 small rows spread over tasks instead of one
large array carried through every shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import patterns as P
from ..session import broadcast_checked
from . import pairs
from .counts import counted

TOKENIZERS = {
    "word": P.word_token(1),      # R5, Unicode
    "default": P.word_token(2),   # R6, two or more word characters
    "rule": P.rule_token(),       # R4
}


def _ids(id_cols) -> list[str]:
    return [id_cols] if isinstance(id_cols, str) else list(id_cols)


def _pattern(tokenizer: str) -> str:
    return TOKENIZERS.get(tokenizer, tokenizer)


def tokenize(df: DataFrame, text: str = "text", id_cols="doc_id",
             tokenizer: str = "word", lowercase: bool = True,
             alpha_only: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Long-form tokens ``(ids..., keep..., pos, term)``; ``pos`` starts at 0.

    ``tokenizer`` is ``word`` (R5), ``default`` (R6), ``rule`` (R4) or a
    Java regular expression.
    """
    toks = C.regex_tokens(text, _pattern(tokenizer), lowercase)
    if alpha_only:
        toks = C.alpha_only(toks)
    cols = _ids(id_cols) + list(keep)
    return C.posexplode_rows(df, cols, toks)


def tokenize_word(df, text="text", id_cols="doc_id", pattern: str = "word",
                  lowercase=True, keep=()) -> DataFrame:
    """Word tokens; ``pattern`` is a parameter (default R5, Unicode)."""
    return tokenize(df, text, id_cols, pattern, lowercase, keep=keep)


def tokenize_rule(df, text="text", id_cols="doc_id", keep=()) -> DataFrame:
    """Own rule tokenizer (R4) on lower-cased text: dotted words, numbers,
    and punctuation that stands before white space."""
    return tokenize(df, text, id_cols, "rule", True, keep=keep)


def token_arrays(df: DataFrame, text="text", out="tokens", tokenizer="word",
                 lowercase=True) -> DataFrame:
    """Adds the token array column (for n-grams and per-row metrics)."""
    return df.withColumn(out, C.regex_tokens(text, _pattern(tokenizer), lowercase))


def ngrams(df: DataFrame, n: int, tokens: str = "tokens", id_cols="doc_id",
           keep=()) -> DataFrame:
    """Long-form contiguous n-grams ``(ids..., pos, term)``."""
    return C.posexplode_rows(df, [*_ids(id_cols), *keep], C.ngram_array(tokens, n))


#: Grams that a task of the dealt grams gets before equal ones are added up.
DEALT_GRAMS = 1_500_000


def ngram_counts(df: DataFrame, n: int, tokens: str = "tokens", about=None) -> DataFrame:
    """How often each run of n and of n - 1 tokens (without nulls and blanks)
    occurs: ``(n, term, cnt)``, n from 2.

    A run of n tokens holds one of n - 1, so both are counted from one row
    per n - 1 tokens with all that follow them.  Equal ones are added up
    where they are made, a large batch of rows at a time, and the rows go to
    enough tasks for each to hold its share.  ``about`` (a column) is about
    how many tokens a row has, if that is cheaper to tell than to count."""
    if n < 2:
        raise ValueError("n must be 2 at least")
    size = F.size(tokens) if about is None else about
    made = 2 * float(df.agg(F.sum(F.greatest(size, F.lit(0)))).first()[0] or 0)
    rows = df.select(F.col(tokens).alias("t")).mapInArrow(lambda batches: pairs.grams(batches, n), pairs.GRAMS)
    dealt = rows.repartition(max(1, math.ceil(made / DEALT_GRAMS)), "t1")
    alone = F.struct(F.lit(None).cast("string").alias("t2"), F.col("n1").alias("n"))
    both = F.concat(F.array(alone), F.arrays_zip(F.split("t2", pairs.SEPARATOR).alias("t2"), F.col("n").alias("n")))
    # grouped as they were dealt, so without another shuffle; where nothing follows the split still gives a text, without a count
    counts = (C.explode_rows(dealt, ["t1"], both, "_p").select("t1", "_p.t2", "_p.n").filter(F.col("n").isNotNull())
               .groupBy("t1", "t2").agg(F.sum("n").alias("cnt")))
    head, last = pairs.unescaped("t1"), pairs.unescaped("t2")
    short = F.col("t2").isNull()
    return counts.select(F.when(short, F.lit(n - 1)).otherwise(F.lit(n)).alias("n"),
                         F.when(short, head).otherwise(F.concat(head, F.lit(" "), last)).alias("term"), "cnt")


def ngram_counts_by(df: DataFrame, by: str, arms: Sequence[pairs.Arm], deal: int | None = None) -> DataFrame:
    """:func:`ngram_counts` per value of ``by`` and arm (a column of tokens,
    none empty, an n, and names for the terms of n - 1 and of n tokens; with
    n = 1 the tokens alone are counted): ``(by, view, t1, t2, cnt)``.  The term
    is ``t1`` and, if that is not empty, a blank and ``t2`` (as
    ``pairs.unescaped`` shows them); ``view`` is the name.

    Equal ones are added up where they are made, a large batch of rows at a
    time, so a term has a row per batch.  With ``deal`` they travel, one row
    per ``t1`` and batch, to as many tasks, where a term's rows are together."""
    schema = f"{by} {df.schema[by].dataType.simpleString()}, v1 string, v2 string, {pairs.GRAMS}"
    columns = sorted({a.column for a in arms})
    made = df.select(by, *columns).mapInArrow(lambda batches: pairs.grams_by(batches, by, arms), schema)
    if deal:
        made = made.repartition(deal, "t1")
    alone = F.struct(F.lit("").alias("t2"), F.col("n1").alias("n"))
    both = F.concat(F.array(alone), F.arrays_zip(F.split("t2", pairs.SEPARATOR).alias("t2"), F.col("n").alias("n")))
    # where nothing follows the split still gives a text, without a count
    return (C.explode_rows(made, [by, "v1", "v2", "t1"], both, "_p").filter(F.col("_p.n").isNotNull())
             .select(by, F.when(F.col("_p.t2") == "", F.col("v1")).otherwise(F.col("v2")).alias("view"),
                     "t1", "_p.t2", F.col("_p.n").alias("cnt")))


def tokenizer_report(df: DataFrame, text="text",
                     tokenizers: dict[str, str] | None = None,
                     lowercase=True) -> DataFrame:
    """Tokens and distinct terms per tokenizer on the same text, one scan."""
    tokenizers = tokenizers or {"word": "word", "rule": "rule"}
    arms = [F.struct(F.lit(name).alias("tokenizer"),
                     C.regex_tokens(text, _pattern(p), lowercase).alias("toks"))
            for name, p in tokenizers.items()]
    arms_df = df.select(F.explode(F.array(*arms)).alias("a")).select("a.tokenizer", "a.toks")
    long = C.explode_rows(arms_df, ["tokenizer"], F.col("toks"), "term")
    return long.groupBy("tokenizer").agg(
        F.count("*").alias("n_tokens"), F.countDistinct("term").alias("n_terms"))


# --------------------------------------------------------------- regex mining
def _matches(df, text, id_cols, pattern, keep):
    return C.explode_rows(df, [*_ids(id_cols), *keep],
                          F.regexp_extract_all(F.col(text), F.lit(pattern), 0), "word")


def elongated_words(df: DataFrame, text="text", id_cols="doc_id", min_run=3,
                    keep=()) -> DataFrame:
    """Every word holding a vowel run of at least ``min_run`` (R2)."""
    return _matches(df, text, id_cols, P.elongated(min_run), keep)


def vowel_cluster_words(df: DataFrame, text="text", id_cols="doc_id",
                        keep=()) -> DataFrame:
    """Every word matching R1 (a triple vowel, or a double then another vowel)."""
    return _matches(df, text, id_cols, P.vowel_cluster(), keep)


def with_canonical(df: DataFrame, word="word", min_run=3) -> DataFrame:
    """Adds ``vowel`` (first run's vowel) and ``canonical`` (all runs replaced
    by that vowel, lower case) -- the reference's quirk Q5 kept on purpose."""
    w = F.lower(F.col(word))
    return (df.withColumn("vowel", C.run_vowel(w, min_run))
              .withColumn("canonical", C.canonical_word(w, min_run)))


def collapse_runs(df: DataFrame, text="text", min_run=3, out="normalized") -> DataFrame:
    """Each run replaced by its first letter (case kept), and ``n_runs``, the
    number of runs replaced (the reference's "corrected words", Q8)."""
    return (df.withColumn(out, C.collapse_runs(text, min_run))
              .withColumn("n_runs", C.count_runs(text, min_run)))


def match_totals(matches: DataFrame, pattern_col: str | None = None) -> DataFrame:
    keys = [pattern_col] if pattern_col else []
    return matches.groupBy(*keys).agg(F.count("*").alias("n_matches"))


# ----------------------------------------------------------- normalisation
NORMALIZE_MODES = ("lemma", "stem", "none")


def normalize_terms(tokens: DataFrame, dictionary: DataFrame | None, mode="lemma",
                    term="term", cat: str | None = None, default_cat="n",
                    out="term") -> DataFrame:
    """Lemma or stem by (word, class), the word itself when absent (Q1: an
    unknown mode is an error, not a silent no-op).

    ``dictionary`` has ``word``, optional ``cat`` and ``lemma`` (mode
    ``lemma``) or ``stem`` (mode ``stem``).  Left join: every token stays.
    Of several entries for a word the smallest value counts.  A dictionary
    with few rows is broadcast, so frequent words are not dealt by word; for
    a large one, normalise counts (:func:`normalize_counts`), not tokens.
    """
    if mode not in NORMALIZE_MODES:
        raise ValueError(f"unknown normalisation mode {mode!r}; use one of {NORMALIZE_MODES}")
    if mode == "none" or dictionary is None:
        return tokens if out == term else tokens.withColumn(out, F.col(term))
    value = "lemma" if mode == "lemma" else "stem"
    d = dictionary
    keys = [F.col(term) == F.col("_d_word")]
    if "cat" in d.columns:
        t_cat = F.col(cat) if cat else F.lit(default_cat)
        d = d.select(F.col("word").alias("_d_word"), F.col("cat").alias("_d_cat"),
                     F.col(value).alias("_d_val"))
        keys.append(t_cat == F.col("_d_cat"))
    else:
        d = d.select(F.col("word").alias("_d_word"), F.col(value).alias("_d_val"))
    d = d.groupBy(*[c for c in d.columns if c != "_d_val"]).agg(F.min("_d_val").alias("_d_val"))
    joined = tokens.join(broadcast_checked(d), keys, "left")
    return (joined.withColumn(out, F.coalesce(F.col("_d_val"), F.col(term)))
                  .drop(*[c for c in d.columns]))


def normalize_counts(counts: DataFrame, dictionary: DataFrame | None, mode="lemma", term="term",
                     n="n", **kw) -> DataFrame:
    """Counts per normalised term from counts per term: each distinct term
    meets the dictionary once, however frequent it is."""
    return (normalize_terms(counts, dictionary, mode, term, **kw)
            .groupBy(term).agg(F.sum(n).alias(n)))


def remove_stopwords(tokens: DataFrame, stopwords=None, term="term") -> DataFrame:
    """Drop listed words (duplicates of other words kept).  A Python list
    becomes a hash-set membership test in generated code -- no join; a
    DataFrame of words is a left-anti join."""
    if stopwords is None:
        stopwords = P.ENGLISH_STOPWORDS
    if isinstance(stopwords, DataFrame):
        sw = stopwords.select(F.col(stopwords.columns[0]).alias("_sw")).distinct()
        return tokens.join(sw, F.col(term) == F.col("_sw"), "left_anti")
    return tokens.filter(~F.col(term).isin(list(stopwords)))


def keep_categories(df: DataFrame, cats: Sequence[str], cat="cat", word="word") -> DataFrame:
    """Tokens whose word class is wanted; blank words skipped."""
    return df.filter(F.col(cat).isin(list(cats)) & (F.trim(F.col(word)) != ""))


def label_from_filename(df: DataFrame, rules: Sequence[tuple[str, str]],
                        name="path", default: str | None = None,
                        out="label", keep_unmatched=False, observation=None) -> DataFrame:
    """Class from the file name (last path segment, Q4): first rule whose
    regular expression matches wins, else ``default``; rows without a label
    are dropped (Q7) unless ``keep_unmatched``.  An ``observation`` counts
    ``rows`` and ``unmatched``."""
    fname = C.last_segment(name)
    expr = None
    for pattern, label in rules:
        expr = (F.when(fname.rlike(pattern), F.lit(label)) if expr is None
                else expr.when(fname.rlike(pattern), F.lit(label)))
    expr = F.lit(default) if expr is None else expr.otherwise(F.lit(default))
    res = counted(df.withColumn(out, expr), observation, rows=None, unmatched=F.col(out).isNull())
    return res if keep_unmatched else res.filter(F.col(out).isNotNull())


# ----------------------------------------------------------------- counts
def term_counts(tokens: DataFrame, term="term", out="n") -> DataFrame:
    """Occurrences per term (partial aggregation before the shuffle)."""
    return tokens.groupBy(term).agg(F.count("*").alias(out))


def grouped_term_counts(tokens: DataFrame, groups: Sequence[str], term="term",
                        out="n") -> DataFrame:
    return tokens.groupBy(*groups, term).agg(F.count("*").alias(out))


def top_words_per_group(counts: DataFrame, groups: Sequence[str], k=3,
                        term="term", n="n", out="rank") -> DataFrame:
    """k most frequent terms per group, ties by term.  ``row_number() <= k``
    is planned with a partial window-group limit before the shuffle, so a
    hot group sends at most k rows per map task."""
    w = Window.partitionBy(*groups).orderBy(F.desc(n), F.asc(term))
    return (counts.withColumn(out, F.row_number().over(w))
                  .filter(F.col(out) <= k))


def lemma_summary(words: DataFrame, word="term", lemma="lemma") -> DataFrame:
    """Number of words against number of distinct lemmas."""
    return words.agg(F.count(word).alias("n_words"),
                     F.countDistinct(lemma).alias("n_lemmas"))


def symmetric_difference(a: DataFrame, b: DataFrame, key="word", n="n") -> DataFrame:
    """Keys found by exactly one side, with the count from the first side
    (0 when only the second has it) and which side holds it."""
    a2 = a.select(F.col(key), F.col(n).alias("_na"))
    b2 = b.select(F.col(key), F.lit(True).alias("_in_b"))
    j = a2.join(b2, key, "full_outer")
    return (j.filter(F.col("_na").isNull() | F.col("_in_b").isNull())
             .select(key,
                     F.coalesce(F.col("_na"), F.lit(0)).cast("long").alias("n_first"),
                     F.col("_na").isNotNull().alias("in_first")))
