"""Column expressions shared by the operators.  All are built-in Spark
functions (JVM side, inside whole-stage code generation); none is a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def explode_rows(df, keep, arr, name: str):
    """``explode`` without Spark's inferred ``size(arr) > 0`` filter.

    For a plain ``explode`` the optimizer adds that filter and pushes it
    below the projection that built the array, so the array expression (a
    tokenizer, n-gram lambdas) is evaluated twice per row -- measured as the
    dominant cost of tokenisation.  ``explode_outer`` gets no inferred
    filter; the one null row of an empty array is dropped after."""
    return df.select(*keep, F.explode_outer(arr).alias(name)).filter(F.col(name).isNotNull())


def posexplode_rows(df, keep, arr, pos: str = "pos", name: str = "term"):
    """``posexplode`` counterpart of :func:`explode_rows`."""
    return (df.select(*keep, F.posexplode_outer(arr).alias(pos, name))
              .filter(F.col(pos).isNotNull()))


def regex_tokens(text, pattern: str, lowercase: bool = True) -> Column:
    """All matches of ``pattern`` in ``text`` (optionally lower-cased first)."""
    t = col(text)
    if lowercase:
        t = F.lower(t)
    return F.regexp_extract_all(t, F.lit(pattern), 0)


def alpha_only(tokens) -> Column:
    """Keep letter-only tokens (``str.isalpha``)."""
    return F.filter(col(tokens), lambda x: x.rlike(r"^\p{L}+$"))


def ngram_array(tokens, n: int) -> Column:
    """Contiguous n-grams joined by a blank; empty when fewer than n tokens."""
    t = col(tokens)
    if n == 1:
        return t
    grams = F.transform(
        F.sequence(F.lit(1), F.size(t) - n + 1),
        lambda i: F.array_join(F.slice(t, i, n), " "),
    )
    return F.when(F.size(t) >= n, grams).otherwise(F.array().cast("array<string>"))


def dot(v1, v2) -> Column:
    prods = F.zip_with(col(v1), col(v2), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0), lambda acc, x: acc + x)


def norm(v) -> Column:
    return F.sqrt(F.aggregate(col(v), F.lit(0.0),
                              lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine(v1, v2) -> Column:
    """Dot product over the product of norms; a zero norm gives null."""
    return F.try_divide(dot(v1, v2), norm(v1) * norm(v2))


def unit_vector(v) -> Column:
    n = norm(v)
    return F.transform(col(v), lambda x: F.try_divide(x.cast("double"), n))


def run_vowel(word, min_run: int = 3) -> Column:
    """Vowel of the first run, lower case."""
    return F.lower(F.regexp_extract(col(word), P.vowel_run(min_run), 1))


def canonical_word(word, min_run: int = 3) -> Column:
    """Lower-cased word with every run replaced by the first run's vowel."""
    w = F.lower(col(word))
    return F.regexp_replace(w, F.lit(P.vowel_run(min_run)), run_vowel(w, min_run))


def collapse_runs(text, min_run: int = 3) -> Column:
    """Each vowel run becomes its own first letter, case kept."""
    return F.regexp_replace(col(text), F.lit(P.vowel_run(min_run)), F.lit("$1"))


def count_runs(text, min_run: int = 3) -> Column:
    return F.regexp_count(col(text), F.lit(P.vowel_run(min_run))).cast("long")


def wordnet_class(tag) -> Column:
    """Penn tag prefix to WordNet class: J a, V v, N n, R r, else n."""
    t = col(tag)
    return (F.when(t.startswith("J"), "a").when(t.startswith("V"), "v")
            .when(t.startswith("N"), "n").when(t.startswith("R"), "r")
            .otherwise("n"))


def result_key(model_id) -> Column:
    """Path-safe key: ``/`` becomes ``_``."""
    return F.replace(col(model_id), F.lit("/"), F.lit("_"))


def last_segment(path) -> Column:
    return F.element_at(F.split(col(path), "/"), -1)


def seconds_between(later, earlier) -> Column:
    """Seconds between two timestamps (with or without zone), microsecond
    exact and independent of the session time zone (no cast of a zone-less
    timestamp, which would shift across daylight-saving changes)."""
    return F.timestamp_diff("MICROSECOND", col(earlier), col(later)) / F.lit(1e6)
