"""Quality rules from cross-document line frequency: hash normalised lines,
count the distinct documents per host that hold each, remove lines above the
limits and reject documents that are depleted by it.

Plan: one Python pass over the texts gives the distinct line keys of each
document, written once as a table; the count per (host, line) is a two-level
distinct aggregate, so a hot host or line is spread over (host, line,
document) first and combined map-side after; the few lines above the limits
join back to the keys (broadcast only after their number is checked).  One
join by document brings each text the list of its lines to remove, and a
second pass gives the word statistics and the cleaned text.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm.common import WHITE, broadcast_if_small, map_texts, pieces, written

SYMBOLS = "#*$%&|<>"  # fixed values: the characters counted as symbols


def text_stats(text: str | None) -> tuple[int, int, int, int, int, dict[bytes, int]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the
    words of each distinct normalised line by its 128-bit key."""
    import numpy as np

    if not text:
        return 0, 0, 0, 0, 0, {}
    words = text.encode().split()
    chars = len(text) - sum(text.count(c) for c in WHITE)
    symbols = sum(text.count(c) for c in SYMBOLS)
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line.strip(WHITE):
            dup += line in seen
            seen.add(line)
    n, repeat = len(words), 0
    if n > 3:
        own: dict[bytes, int] = {}
        ids = np.fromiter((own.setdefault(w, len(own)) for w in words), np.int64, n)
        pair = np.unique(ids[:-1] * len(own) + ids[1:], return_inverse=True)[1]
        _, at, count = np.unique(pair[:-1] * len(own) + ids[2:], return_inverse=True, return_counts=True)
        twice = count[at] > 1
        inside = np.zeros(n, bool)
        for shift in range(3):
            inside[shift:n - 2 + shift] |= twice
        repeat = int(inside.sum())
    return n, chars, symbols, dup, repeat, line_words(text)


def line_words(text: str | None) -> dict[bytes, int]:
    """The words of each distinct normalised line by its 128-bit key."""
    import xxhash

    lines: dict[bytes, int] = {}
    for line in (text or "").split("\n"):
        core = line.encode().strip()
        if core:
            k = xxhash.xxh3_128_digest(core.lower())
            lines[k] = lines.get(k, 0) + len(core.split())
    return lines


def without_lines(text: str | None, lost: set[bytes]) -> str | None:
    """The text without the lines whose key is in ``lost``."""
    import xxhash

    if not text:
        return text
    return "\n".join(line for line in text.split("\n")
                     if not (core := line.encode().strip()) or xxhash.xxh3_128_digest(core.lower()) not in lost)


def line_frequency_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         host_col: str = "source", max_docs: int = 10, max_share: float = 0.001,
                         min_share: float = 0.5, min_words: int = 50,
                         max_repeat: float = 0.5) -> DataFrame:
    """Per document: id, host, word statistics, ``removed_words`` (words of
    its lines above the limits), ``base_failed``, ``depleted``, ``kept`` and
    ``clean_text`` (the text without those lines; the others as they are).

    A line (stripped of ASCII white space, A-Z lowered, not empty) is
    removed on a host when more than ``max_docs`` and more than ``max_share``
    of the host's documents hold it.  A document is depleted when less than
    ``min_share`` of its words remain.  ``base_failed``: fewer than
    ``min_words`` words, or more than ``max_repeat`` of them inside 3-word
    windows that occur twice.  ``kept`` is neither.  A null or empty text has
    0 words, so it fails the base rule and is never depleted.  A null host is
    a host of its own.  Rows sharing an id count as one document; each is
    judged by its own text.  Other input columns are ignored.
    """
    def keys():
        def step(texts):
            return [pa.array([list(line_words(t)) for t in texts], pa.list_(pa.binary()))]
        return step

    base = docs.select(F.col(id_col).alias("_id"), F.col(host_col).alias("_host"), F.col(text_col).alias("_text"))
    held = written(map_texts(base, "_text", [T.StructField("_keys", T.ArrayType(T.BinaryType()))], keys, drop=("_text",)))
    lines = held.select("_id", "_host", F.explode("_keys").alias("k"))
    hosts = held.groupBy("_host").agg(F.count_distinct("_id").alias("_docs"))
    often = (lines.groupBy("_host", "k").agg(F.count_distinct("_id").alias("_n")).filter(F.col("_n") > max_docs))
    hosts = broadcast_if_small(written(hosts))
    over = (often.alias("o").join(hosts.alias("h"), F.expr("o._host <=> h._host"))
            .filter(F.col("_n") > max_share * F.col("_docs")).select("o._host", "o.k"))
    over = broadcast_if_small(written(over), 200_000)
    # the limits hold for a whole host, so rows sharing id and host can share their list
    lost = (lines.alias("l").join(over.alias("o"), F.expr("l.k = o.k and l._host <=> o._host"))
            .groupBy("l._id", "l._host").agg(F.collect_set("l.k").alias("_lost")))
    cleaned = base.alias("d").join(lost.alias("x"), F.expr("d._id <=> x._id and d._host <=> x._host"), "left").select(
        "d._id", "d._host", "d._text", "x._lost")
    out = _judged(cleaned)
    failed = ((F.col("n_words") < min_words)
              | (F.col("n_repeat_words") > max_repeat * F.col("n_words")))
    depleted = (F.col("n_words") - F.col("removed_words")) < min_share * F.col("n_words")
    return out.select(
        F.col("_id").alias(id_col), F.col("_host").alias(host_col),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "removed_words", failed.alias("base_failed"), depleted.alias("depleted"),
        (~failed & ~depleted).alias("kept"), "clean_text")


def _judged(df: DataFrame) -> DataFrame:
    """(_id, _host, word statistics, removed_words, clean_text) of every row
    of (_id, _host, _text, _lost)."""
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "removed_words")
    schema = T.StructType([df.schema["_id"], df.schema["_host"], *(T.StructField(n, T.LongType()) for n in counts),
                           T.StructField("clean_text", T.StringType())])

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "_text"):
                rows, texts = [], []
                for text, lost in zip(part.column("_text").to_pylist(), part.column("_lost").to_pylist()):
                    *stats, words = text_stats(text)
                    lost = set(lost or ())
                    rows.append((*stats, sum(w for k, w in words.items() if k in lost)))
                    texts.append(without_lines(text, lost) if lost else text)
                cols = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(counts))]
                yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("_host"), *cols, pa.array(texts, pa.string())],
                                                 names=schema.fieldNames())

    return df.mapInArrow(run, schema)
