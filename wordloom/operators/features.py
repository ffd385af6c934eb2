"""Vocabulary, counts, TF-IDF, co-occurrence and similarity on coordinate
DataFrames ``(doc_id, term, n)`` -- never a dense matrix."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..session import broadcast_checked, cut_lineage
from . import ordering, pairs
from . import text as T


# ---------------------------------------------------------------- counts
def doc_term_counts(docs: DataFrame, text="text", id_col="doc_id", tokenizer="default",
                    lowercase=True, keep: Sequence[str] = ()) -> DataFrame:
    """Term-document counts ``(doc_id, keep..., term, n)`` from the text.

    Texts are dealt by document before they are tokenised: a text is far
    smaller than its (document, term) rows, and these are then counted where
    they are made, without a shuffle of their own.  (Counting inside the row
    with array lambdas was measured 3x slower: lambdas run outside generated
    code.)"""
    toks = T.tokenize(by_document(docs.select(id_col, *keep, text), id_col), text, id_col, tokenizer, lowercase, keep=keep)
    return toks.groupBy(id_col, *keep, "term").agg(F.count("*").alias("n"))


def by_document(docs: DataFrame, id_col="doc_id") -> DataFrame:
    """The rows dealt by id over ``spark.sql.shuffle.partitions`` tasks (a
    given number is not coalesced by the size of texts, whose tokens take
    far more memory)."""
    return docs.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), id_col)


def term_document(tokens: DataFrame, vocab: DataFrame | None = None, id_col="doc_id",
                  term="term") -> DataFrame:
    """Count per (document, term) from long-form tokens; with a vocabulary,
    out-of-vocabulary terms are ignored (inner join) and ``idx`` is kept."""
    td = tokens.groupBy(id_col, term).agg(F.count("*").alias("n"))
    if vocab is not None:
        td = td.join(vocab.select(term, *[c for c in ("idx",) if c in vocab.columns]), term)
    return td


# ---------------------------------------------------------------- vocabulary
def vocabulary(tokens: DataFrame, term="term", stopwords=None, index=True) -> DataFrame:
    """Distinct terms, sorted, with a dense 0-based ``idx`` (distributed)."""
    t = tokens
    if stopwords is not None:
        t = T.remove_stopwords(t, stopwords, term)
    v = t.select(term).distinct()
    return ordering.dense_index(v, [term], "idx") if index else v


def vocabulary_from_text(docs: DataFrame, mode="none", dictionary: DataFrame | None = None,
                         lowercase=True, stopwords=T.P.ENGLISH_STOPWORDS, text="text", id_col="doc_id",
                         index=True) -> DataFrame:
    """The vocabulary of a corpus in one call: rule tokens (lower-cased if
    asked), letters only, then normalised (``lemma``, ``stem`` or ``none``),
    then stop words removed (``None`` keeps them), sorted, indexed.  Distinct
    words are normalised, not tokens."""
    toks = T.tokenize(docs, text, id_col, "rule", lowercase, alpha_only=True)
    words = T.normalize_terms(toks.select("term").distinct(), dictionary, mode)
    return vocabulary(words, stopwords=stopwords, index=index)


def document_frequency(td: DataFrame, term="term", id_col="doc_id") -> DataFrame:
    """Documents holding each term (td has one row per (doc, term))."""
    return td.groupBy(term).agg(F.count(id_col).alias("df"))


def matrix_shape(td: DataFrame, docs: DataFrame | None = None, id_col="doc_id",
                 term="term") -> DataFrame:
    """Rows (documents), columns (distinct terms) and stored cells."""
    n_rows = (docs.select(F.count("*")).scalar() if docs is not None
              else td.select(F.countDistinct(id_col)).scalar())
    return td.agg(n_rows.cast("long").alias("n_rows"),
                  F.countDistinct(term).alias("n_cols"),
                  F.count("*").alias("n_cells"))


def tfidf(td: DataFrame, docs: DataFrame, id_col="doc_id", term="term", n="n",
          smooth=True, normalize=True, materialize=True) -> DataFrame:
    """``n * (ln((1+N)/(1+df)) + 1)``, then unit length per document (the
    off-the-shelf default the reference used).  N counts all documents,
    including those without tokens; it is a scalar subquery, not a join.

    The counts feed three branches (document frequency, weights, norms); with
    ``materialize`` they are written once to the shared checkpoint folder
    instead of being re-tokenised per branch (measured 4 scans otherwise)."""
    if materialize:
        td = cut_lineage(td)
    n_docs = docs.select(F.count("*")).scalar()
    dfreq = document_frequency(td, term, id_col)
    one = F.lit(1.0) if smooth else F.lit(0.0)
    idf = cut_lineage(dfreq.select(term, "df", (F.log((one + n_docs) / (one + F.col("df"))) + 1.0).alias("idf")))
    least = _frequent_from(idf)
    # the frequent terms' rows meet their idf where they are; only those of rare terms are shuffled by term
    often = F.broadcast(idf.filter(F.col("df") >= least).select(term, F.col("idf").alias("_often")))
    w = td.filter(F.col(term).isNotNull()).join(often, term, "left")
    if least > 1:
        rare = w.filter(F.col("_often").isNull()).join(idf.filter(F.col("df") < least).select(term, "idf"), term)
        w = (w.filter(F.col("_often").isNotNull()).withColumnRenamed("_often", "idf")
              .unionByName(rare.drop("_often")))
    else:
        w = w.withColumnRenamed("_often", "idf")
    w = w.select(id_col, term, (F.col(n) * F.col("idf")).alias("w"))
    if not normalize:
        return w.withColumnRenamed("w", "tfidf")
    # one shuffle by document for the norm and the weights; rows without an id have no norm to join
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    return (w.filter(F.col(id_col).isNotNull()).withColumn("_norm", norm)
             .select(id_col, term, F.try_divide(F.col("w"), F.col("_norm")).alias("tfidf")))


#: Terms that are broadcast with their idf.
FREQUENT_TERMS = 100_000


def _frequent_from(idf: DataFrame, most: int | None = None) -> int:
    """The least power of two such that at most ``most`` terms have that
    document frequency (from the counts per power, a few dozen rows)."""
    most = FREQUENT_TERMS if most is None else most
    powers = idf.groupBy(F.floor(F.log2(F.greatest("df", F.lit(1)))).alias("p")).agg(F.count("*").alias("n")).collect()
    total = 0
    for p, k in sorted(powers, reverse=True):
        total += k
        if total > most:
            return 2 ** (p + 1)
    return 1


def max_cell(df: DataFrame, row: str, col: str, value: str) -> DataFrame:
    """Largest cell with its row and column; ties to the smallest (row, col).
    Planned as a distributed take-ordered, not a sort of everything."""
    return df.orderBy(F.desc(value), F.asc(row), F.asc(col)).limit(1)


# ---------------------------------------------------------------- co-occurrence
#: About how many terms a character of text is (it only sets the number of tasks).
TERMS_OF_CHARACTER = 0.16
#: Widest window: a row of n tokens makes n * window pairs.
MAX_WINDOW = 1000


def cooccurrence(docs: DataFrame, window: int, text="text", id_col="doc_id",
                 tokenizer="default", lowercase=True, tokens: str | None = None,
                 binary=False) -> DataFrame:
    """Term-term co-occurrence within ``window`` positions, zero diagonal,
    symmetric ``(t1, t2, n)``.

    Each unordered position pair is produced once inside its document's row
    (``n_tokens * window`` pairs, never all pairs of a document), equal
    pairs are added up in their task and dealt by term (:func:`_dealt`), and
    mirrored last.  With ``binary`` a pair counts once per document.  A
    window as long as a document would pair all its tokens in one row; for a
    wider context use :func:`sentence_cooccurrence` or
    :func:`context_cooccurrence`.
    """
    if not 1 <= window <= MAX_WINDOW:
        raise ValueError(f"window must be between 1 and {MAX_WINDOW} positions")
    toks = F.col(tokens) if tokens else C.regex_tokens(text, T._pattern(tokenizer), lowercase)
    if not binary:
        places = F.size(tokens) if tokens else F.length(text) * TERMS_OF_CHARACTER
        made = window * float(docs.agg(F.sum(F.greatest(places, F.lit(0)))).first()[0] or 0)
        return _mirrored(_dealt(docs.select(toks.alias("t")).mapInArrow(
            lambda batches: pairs.stripes(batches, window), pairs.STRIPES), made))
    t = F.col("_t")
    # both ends of a distance side by side: no lambda, and a row per (document, distance)
    base = C.explode_rows(docs.select(id_col, toks.alias("_t")), [id_col, "_t"], F.sequence(F.lit(1), F.lit(window)), "_d")
    k = F.greatest(F.size(t) - F.col("_d"), F.lit(0))
    ends = F.arrays_zip(F.slice(t, 1, k).alias("a"), F.slice(t, F.col("_d") + 1, k).alias("b"))
    p = (C.explode_rows(base, [id_col], ends, "p")
             .select(id_col, F.least("p.a", "p.b").alias("t1"),
                     F.greatest("p.a", "p.b").alias("t2"))
             .filter(F.col("t1") != F.col("t2")))
    return _mirrored(p.distinct().groupBy("t1", "t2").agg(F.count("*").alias("n")))


#: Terms of one block of a context; a row of two blocks makes at most its square of pairs.
BLOCK_TERMS = 512


def context_cooccurrence(td: DataFrame, id_col="doc_id", term="term", n="n", focus: DataFrame | None = None,
                         block_terms: int = BLOCK_TERMS) -> DataFrame:
    """Term-term co-occurrence with whole contexts (documents), zero
    diagonal, symmetric ``(t1, t2, n)``: the sum over contexts of the product
    of the two terms' counts.  ``td`` has one row per (context, term) with
    its count; rows with a null are left out.

    This is the Gram product of the term-document table in blocks.  A
    context's terms are cut into blocks of about ``block_terms`` by hash, a
    pair of blocks is a row: a long context is many rows.  Products are added
    up in their task before they are shuffled (:func:`_pair_counts`), so a
    frequent term sends each partner once per batch.  With ``focus``
    (a column ``term``) only pairs whose ``t1`` is one of its terms are made
    (:func:`_focus_cooccurrence`)."""
    td = td.select(F.col(id_col).alias("_c"), F.col(term).alias("_t"), F.col(n).cast("long").alias("_n")).dropna()
    if focus is not None:
        return _focus_cooccurrence(cut_lineage(td), focus)
    part = [F.col("_t").alias("t"), F.col("_n").alias("n")]
    td = cut_lineage(td)
    sizes = td.groupBy("_c").agg(F.count("*").alias("_k"))
    many = sizes.filter(F.col("_k") > block_terms).select("_c", F.ceil(F.col("_k") / block_terms).cast("int").alias("_b"))
    blocks = td.join(broadcast_checked(cut_lineage(many)), "_c", "left").withColumn("_b", F.coalesce("_b", F.lit(1)))
    blocks = cut_lineage(blocks.groupBy("_c", "_b", F.pmod(F.xxhash64("_t"), F.col("_b")).cast("int").alias("_i"))
                         .agg(F.sort_array(F.collect_list(F.struct(*part))).alias("_x")))
    # one block: the pairs of a row with itself; several: every block with each later one
    own = blocks.filter(F.size("_x") > 1).select(F.col("_x.t").alias("t"), F.col("_x.n").alias("n"), F.lit(0).alias("cut"))
    later = C.explode_rows(blocks.filter("_i + 1 < _b"), ["_c", F.col("_x").alias("_y")], F.sequence(F.col("_i") + 1, F.col("_b") - 1), "_i")
    met = later.join(blocks.filter("_b > 1").select("_c", "_i", "_x"), ["_c", "_i"])
    across = met.select(F.concat("_x.t", "_y.t").alias("t"), F.concat("_x.n", "_y.n").alias("n"), F.size("_x").alias("cut"))
    made = sizes.agg(F.sum(F.col("_k") * (F.col("_k") - 1) / 2)).first()[0] or 0
    return _mirrored(_pair_counts(own.unionByName(across), made))


#: Pairs that a task of the dealt pairs gets before equal ones are added up (it holds them without a spill).
DEALT_PAIRS = 1_500_000


def _pair_counts(units: DataFrame, made: float, common: Sequence[str] | None = None) -> DataFrame:
    """``(t1, t2, n)``, each pair once (t1 < t2, or with ``common`` words the
    rarer one first), from rows ``(t array, n array, cut)``:
    the pairs of a row's different terms, or, with a ``cut`` above 0, those
    of a term before it with one after it.  ``made``: about how many.

    The pairs are many times the text, so they are added up where they are
    made, a large batch of rows at a time, and travel as one row per first
    term (its partners in one string) to enough tasks for each to hold its
    share: nothing is spilled, and no pair carries two terms and a key.  With
    ``common`` words a partner is mostly a number of two bytes until the pairs
    are counted."""
    if common is None:
        return _dealt(units.mapInArrow(pairs.stripes, pairs.STRIPES), made)
    dealt = units.mapInArrow(lambda batches: pairs.stripes(batches, common=common), pairs.CODED_STRIPES).repartition(
        max(1, math.ceil(made / (2 * DEALT_PAIRS))), "t1")  # a pair takes about half as much
    # a row has one of the two; the other is filled up with nulls
    partners = F.arrays_zip(F.coalesce(F.split("t2", pairs.SEPARATOR), F.array().cast("array<string>")).alias("t2"),
                            F.coalesce("c", F.array().cast("array<short>")).alias("c"), F.col("n").alias("n"))
    half = (C.explode_rows(dealt, ["t1"], partners, "_p").select("t1", "_p.t2", "_p.c", "_p.n")
             .groupBy("t1", "t2", "c").agg(F.sum("n").alias("n")))
    words = units.sparkSession.createDataFrame([(i - pairs.SHORT, w) for i, w in enumerate(common)], "c short, _word string")
    return half.join(F.broadcast(words), "c", "left").select(
        pairs.unescaped("t1").alias("t1"), F.coalesce("_word", pairs.unescaped("t2")).alias("t2"), "n")


def _dealt(stripes: DataFrame, made: float) -> DataFrame:
    """``(t1, t2, n)`` from the tasks' own sums, one row per first term."""
    dealt = stripes.repartition(max(1, math.ceil(made / DEALT_PAIRS)), "t1")
    partners = F.arrays_zip(F.split("t2", pairs.SEPARATOR).alias("t2"), F.col("n").alias("n"))
    # grouped as they were dealt (terms still escaped), so without another shuffle
    half = (C.explode_rows(dealt, ["t1"], partners, "_p").select("t1", "_p.t2", "_p.n")
             .groupBy("t1", "t2").agg(F.sum("n").alias("n")))
    return half.select(pairs.unescaped("t1").alias("t1"), pairs.unescaped("t2").alias("t2"), "n")


def _mirrored(half: DataFrame) -> DataFrame:
    both = F.array(F.struct("t1", "t2"), F.struct(F.col("t2").alias("t1"), F.col("t1").alias("t2")))
    return half.select(F.explode(both).alias("_m"), "n").select("_m.t1", "_m.t2", "n")


def _focus_cooccurrence(td: DataFrame, focus: DataFrame) -> DataFrame:
    """The pairs of the focus terms alone: their own rows, few per context,
    meet the rows of the same context, so no other pair is made."""
    wanted = broadcast_checked(cut_lineage(focus.select(F.col("term").alias("_t")).distinct()))
    own = td.join(wanted, "_t", "left_semi").select("_c", F.col("_t").alias("t1"), F.col("_n").alias("_n1"))
    met = td.join(own, "_c").filter(F.col("t1") != F.col("_t"))
    return met.groupBy("t1", F.col("_t").alias("t2")).agg(F.sum(F.col("_n1") * F.col("_n")).alias("n"))


#: About how many pairs a character of text makes within its sentence (0.9 to 1.4 on the driver's tables; it only sets the number of tasks).
PAIRS_OF_CHARACTER = 1.3


def sentence_cooccurrence(docs: DataFrame, text="text", id_col="doc_id", tokenizer="default",
                          lowercase=True, focus: DataFrame | None = None) -> DataFrame:
    """:func:`context_cooccurrence` with sentences (runs without ``.``,
    ``!``, ``?`` or a line break) as contexts, however long."""
    sents = C.explode_rows(docs.select(text), [], F.split(F.col(text), r"[.!?\n]+"), "s")
    toks = C.regex_tokens("s", T._pattern(tokenizer), lowercase)
    if focus is not None:
        sents = C.explode_rows(sents.withColumn("sent", F.monotonically_increasing_id()), ["sent"], toks, "term")
        return context_cooccurrence(sents.groupBy("sent", "term").agg(F.count("*").alias("n")), "sent", focus=focus)
    # a sentence is part of one text: its terms are counted where they are, without a shuffle
    units = sents.select(toks.alias("t"), F.lit(None).cast("array<long>").alias("n"), F.lit(0).alias("cut"))
    chars = docs.agg(F.sum(F.length(text))).first()[0] or 0
    seen = T.term_counts(T.tokenize(docs, text, [], tokenizer, lowercase))
    common = [r.term for r in seen.orderBy(F.desc("n"), "term").limit(pairs.COMMON).select("term").collect()]
    return _mirrored(_pair_counts(units, chars * PAIRS_OF_CHARACTER, common))


# ---------------------------------------------------------------- similarity
def term_norms(weights: DataFrame, term="term", w="w") -> DataFrame:
    return weights.groupBy(term).agg(F.sqrt(F.sum(F.col(w) * F.col(w))).alias("norm"))


def rank_by_similarity(weights: DataFrame, target: str, id_col="doc_id", term="term",
                       w="w") -> DataFrame:
    """Every other term with its cosine to ``target`` over documents.

    One pass: the target's weight in each document is a maximum over the
    document's rows, and a single aggregate by term gives each term's norm
    and its dot product with the target; the target's own norm is that
    aggregate's target row (so the aggregate, one row per term, is written
    once; weights that come dealt by document are neither written nor
    shuffled again).  Terms sharing no document with the target get 0."""
    own = F.max(F.when(F.col(term) == F.lit(target), F.col(w))).over(Window.partitionBy(id_col))
    seen = weights.select(id_col, term, w).withColumn("_wt", F.when(F.col(id_col).isNotNull(), own))
    agg = cut_lineage(seen.groupBy(term)
                          .agg(F.sqrt(F.sum(F.col(w) * F.col(w))).alias("_norm"),
                               F.sum(F.col(w) * F.coalesce(F.col("_wt"), F.lit(0.0))).alias("_dot")))
    tnorm = agg.filter(F.col(term) == F.lit(target)).select(F.first("_norm")).scalar()
    return agg.filter(F.col(term) != F.lit(target)).select(
        term, F.coalesce(F.try_divide(F.col("_dot"), F.col("_norm") * tnorm),
                         F.lit(0.0)).alias("similarity"))


def find_similar_words(weights: DataFrame, target: str, n: int = 10, **kw) -> DataFrame:
    """The n nearest terms to ``target`` (target excluded), best first."""
    return (rank_by_similarity(weights, target, **kw)
            .orderBy(F.desc("similarity"), F.asc(kw.get("term", "term"))).limit(n))


def pair_similarity(weights: DataFrame, pairs: DataFrame, id_col="doc_id", term="term",
                    w="w", best: int | None = None) -> DataFrame:
    """Cosine for listed (w1, w2) pairs over documents; null when a word is
    missing.  Postings are restricted to listed words before any join."""
    words = broadcast_checked(cut_lineage(pairs.select(F.explode(F.array("w1", "w2")).alias(term)).distinct()))
    # the listed words' postings are read four times: they are written, not the weights
    post = cut_lineage(weights.join(words, term, "left_semi").select(id_col, term, w))
    norms = term_norms(post, term, w)
    # the listed pairs go to the postings (broadcast if they are few), and the
    # two sides meet on (pair, document): no word's postings are one key
    few = broadcast_checked(pairs.select("w1", "w2").distinct())
    p1 = post.join(few, post[term] == F.col("w1")).select("w1", "w2", id_col, F.col(w).alias("x1"))
    p2 = post.join(few, post[term] == F.col("w2")).select("w1", "w2", id_col, F.col(w).alias("x2"))
    dots = (p1.join(p2, ["w1", "w2", id_col])
            .groupBy("w1", "w2").agg(F.sum(F.col("x1") * F.col("x2")).alias("_dot")))
    n1 = norms.select(F.col(term).alias("w1"), F.col("norm").alias("_n1"))
    n2 = norms.select(F.col(term).alias("w2"), F.col("norm").alias("_n2"))
    res = (pairs.join(n1, "w1", "left").join(n2, "w2", "left").join(dots, ["w1", "w2"], "left")
           .withColumn("similarity", F.when(
               F.col("_n1").isNotNull() & F.col("_n2").isNotNull(),
               F.coalesce(F.try_divide(F.col("_dot"), F.col("_n1") * F.col("_n2")), F.lit(0.0))))
           .drop("_n1", "_n2", "_dot"))
    if best is not None:
        res = (res.filter(F.col("similarity").isNotNull())
               .orderBy(F.desc("similarity"), "w1", "w2").limit(best))
    return res


def vocab_overlap(a: DataFrame, b: DataFrame, key="term") -> DataFrame:
    """Sizes of two vocabularies, shared words and words only in one."""
    da = a.select(key).distinct().withColumn("_a", F.lit(1))
    db = b.select(key).distinct().withColumn("_b", F.lit(1))
    j = da.join(db, key, "full_outer")
    return j.agg(F.count("_a").alias("n_a"), F.count("_b").alias("n_b"),
                 F.count(F.when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), 1)).alias("n_shared"),
                 F.count(F.when(F.col("_b").isNull(), 1)).alias("n_only_a"),
                 F.count(F.when(F.col("_a").isNull(), 1)).alias("n_only_b"))
