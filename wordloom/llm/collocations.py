"""Phrase collocations: frequent phrases of up to ``max_words`` words, scored
by the weakest of their cuts.

In a task, numpy holds the words of about 2 MB of text as one buffer with
single blanks; prefix polynomials (modulo 2^64) over its bytes give every
word's fingerprint, and prefix polynomials over these give the fingerprint of
every n-gram.  The texts are read in a few scans:

1. Scans count the fingerprints of words, then of phrases of two words, of
   three, and of all greater lengths at once, where all parts of the length
   counted before are frequent.  Distinct fingerprints leave a task with
   their number and an occurrence pointer (the smallest document id), a
   shuffle adds them up, and only those with ``min_count`` occurrences stay.
2. The next scan makes texts of phrases whose fingerprint is frequent, and
   of no others.  All occurrences of a fingerprint in a step are compared
   byte by byte with one of them; the shuffle groups by fingerprint *and*
   text, so counts are those of texts and a collision is never merged.

A scan knows the frequent fingerprints by a bit map of at most
``2 ** filter_bits`` bits (16 MB by default, whatever the corpus holds); a
false positive only costs a row that the count then drops.  Scores come from
joins of the frequent phrases, whose hot parts are broadcast (``lookup``).
"""

from __future__ import annotations

import math
import re
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from wordloom.functions.columns import explode_rows
from wordloom.llm.common import give_back, lookup, pieces, small_batches, written

MARKS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
_MARK = re.compile(b"[" + re.escape(MARKS) + b"]")
#: Kind of every byte: 0 in a word, 1 blank, 2 mark.
_KIND = np.array([2 if c in MARKS else 1 if c in BLANKS else 0 for c in range(256)], np.uint8)

#: Bytes of text that one step holds as arrays.
STEP_BYTES = 2 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
#: A fingerprint's bits (collisions only cost rows that the count then drops).
_BITS = 48
#: ``text`` is null in counts of fingerprints, else a language, a line end and a phrase (none: the language's words).
_ROWS = T.StructType([T.StructField("print", T.LongType()), T.StructField("text", T.StringType()),
                      T.StructField("n", T.LongType()), T.StructField("first_id", T.LongType())])


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of a fingerprint depends on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Polynomials:
    """Prefix polynomials over a sequence of 64-bit values, and the hash of
    any stretch of it, the same wherever the stretch lies."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        if n > len(self.up):
            size = 1 << int(n - 1).bit_length()
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            for name, base in (("up", _BASE), ("down", inverse)):
                powers = np.full(size, base, np.uint64)
                powers[0] = 1
                setattr(self, name, np.cumprod(powers, dtype=np.uint64))

    def stretches(self, values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        self._reach(len(values) + 1)
        prefix = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[:len(values)], dtype=np.uint64, out=prefix[1:])
        return (prefix[stop] - prefix[start]) * self.down[start]


class Words:
    """The words of some texts: a canonical buffer with one blank before
    every word, and per word its place, piece, text and fingerprint."""

    def __init__(self, texts: list[bytes], polynomials: Polynomials):
        raw = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8).copy()
        kind = _KIND[raw]
        inside = kind == 0
        edge = np.diff(inside.view(np.int8))
        start, stop = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[start]
        self.text = np.searchsorted(np.cumsum([1, *[len(t) + 1 for t in texts[:-1]]]), start, "right") - 1
        raw[start - 1] = 32
        inside[start - 1] = True
        flat = raw[inside]
        self.stop = np.cumsum(stop - start + 1)
        self.start = self.stop - (stop - start)
        self.buffer, self._flat = flat.tobytes() + bytes(8), flat
        self._polynomials = polynomials
        value = mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)[flat]
        self.word = mixed(polynomials.stretches(value, self.start, self.stop))

    def __len__(self):
        return len(self.start)

    def whole(self, m: int) -> np.ndarray:
        """Whether the m words from each word on lie in one piece."""
        out = np.zeros(len(self), bool)
        n = max(0, len(self) - m + 1)
        out[:n] = self.piece[:n] == self.piece[m - 1:]
        return out

    def prints(self, m: int, at: np.ndarray, lang: np.ndarray) -> np.ndarray:
        """Fingerprints of the m-word phrases at these words; ``lang`` is one
        number per word."""
        return mixed(self._polynomials.stretches(self.word, at, at + m) ^ lang[at]) >> np.uint64(64 - _BITS)

    def same(self, m: int, at: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Whether the m-word phrases at ``at`` and ``other`` are the same
        bytes, compared eight at a time."""
        a, b = self.start[at], self.start[other]
        size = self.stop[at + m - 1] - a
        out = size == self.stop[other + m - 1] - b
        eight = np.ndarray(len(self.buffer) - 7, "<u8", self.buffer, strides=(1,))
        open_ = np.flatnonzero(out)
        done = 0
        while len(open_):
            left = np.minimum(size[open_] - done, 8).astype(np.uint64)
            differ = (eight[a[open_] + done] ^ eight[b[open_] + done]) << (np.uint64(64) - np.uint64(8) * left)
            out[open_[differ != 0]] = False
            done += 8
            open_ = open_[(differ == 0) & (size[open_] > done)]
        return out

    def names(self, m: int, at: np.ndarray, langs: list[str]) -> pa.Array:
        """The m-word phrases at these words, each after its language and a line end."""
        start, size = self.start[at], self.stop[at + m - 1] - self.start[at]
        stops = np.cumsum(size)
        data = self._flat[np.arange(stops[-1] if len(at) else 0) + np.repeat(start - (stops - size), size)]
        offsets = np.concatenate([[0], stops]).astype(np.int64)
        phrases = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data)).cast(pa.string())
        return pc.binary_join_element_wise(pa.array(langs, pa.string()).take(pa.array(self.text[at])), phrases, "\n")


class PrintFilter:
    """A bit per leading bits of a fingerprint."""

    def __init__(self, bits: int, words: np.ndarray):
        self.bits, self.words = bits, words

    def has(self, prints: np.ndarray) -> np.ndarray:
        at = prints >> np.uint64(_BITS - self.bits)
        return (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def print_filter(prints: DataFrame, max_bits: int) -> PrintFilter:
    """The filter of a table with a column ``print``: 64 bits an entry, at
    most ``2 ** max_bits``; only its non-zero words reach the driver."""
    bits = min(max_bits, max(16, (64 * prints.count()).bit_length()))
    rows = (prints.select(F.shiftrightunsigned("print", _BITS - bits).alias("at"))
            .selectExpr("shiftrightunsigned(at, 6) AS word", "shiftleft(1L, cast(at % 64 AS int)) AS mask")
            .groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow())
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[rows["word"].to_numpy()] = rows["mask"].to_numpy().view(np.uint64)
    return PrintFilter(bits, words)


def steps(batch: pa.RecordBatch, step_bytes: int):
    """Lists of (text, lang, id) of about ``step_bytes``; a longer text is
    cut after marks, where no phrase can cross."""
    out, size = [], 0
    for text, lang, i in zip(*[batch.column(c).to_pylist() for c in ("_text", "_lang", "_id")]):
        data, at = (text or "").encode().lower(), 0
        while at < len(data):
            cut = _MARK.search(data, at + step_bytes) if len(data) - at > step_bytes else None
            end = cut.end() if cut else len(data)
            out.append((data[at:end], lang, i))
            size, at = size + end - at, end
            if size >= step_bytes:
                yield out
                out, size = [], 0
    if out:
        yield out


def _grouped(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts ``prints``, and where each run of equal ones starts."""
    order = np.argsort(prints)
    ranked = prints[order]
    return order, np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))


_NO_ID = np.iinfo(np.int64).max


def _rows(prints, texts, n, first) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array(prints.astype(np.int64)), pa.nulls(len(n), pa.string()) if texts is None else texts,
        pa.array(n, pa.int64()), pa.array(first, pa.int64(), mask=first == _NO_ID)], schema=to_arrow_schema(_ROWS))


#: Rows that a task holds to add up equal ones.
HELD_ROWS = 1 << 19


def _added_up(batches, limit: int = HELD_ROWS):
    """The rows with those of one fingerprint and text added up, as far as
    ``limit`` rows reach."""
    held, size = [], 0

    def flush():
        table = pa.Table.from_batches(held).group_by(["print", "text"], use_threads=False).aggregate([("n", "sum"), ("first_id", "min")])
        table = table.select(["print", "text", "n_sum", "first_id_min"]).rename_columns([f.name for f in _ROWS.fields])
        yield from table.to_batches(max_chunksize=1 << 17)

    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= limit:
            yield from flush()
            held, size = [], 0
    if held:
        yield from flush()


def _texts_of(w: Words, m: int, at, prints, number, langs, ids):
    """Rows of the m-word phrases at ``at``, by fingerprint and text."""
    order, starts = _grouped(prints)
    at, sizes = at[order], np.diff([*starts, len(order)])
    head = np.repeat(at[starts], sizes)
    same = (number[at] == number[head]) & w.same(m, at, head)
    doc = ids[w.text[at]]
    yield _rows(prints[order[starts]], w.names(m, at[starts], langs), np.add.reduceat(same.astype(np.int64), starts),
                np.minimum.reduceat(np.where(same, doc, _NO_ID), starts))
    other = np.flatnonzero(~same)
    if len(other):  # occurrences under the fingerprint of another text
        yield _rows(prints[order[other]], w.names(m, at[other], langs), np.ones(len(other), np.int64), doc[other])


def _scan(before: list[int], now: list[int], known, step_bytes: int):
    """Rows of one scan over batches of (_text, _lang, _id): texts of the
    phrases of the lengths ``before`` whose fingerprint is ``known``, and
    fingerprint counts of the lengths ``now`` (word totals with the first)."""

    def rows(batches):
        import xxhash

        polynomials, seen = Polynomials(), known.value if known is not None else None
        for batch in batches:
            for part in pieces(batch, "_text", step_bytes):
                for step in steps(part, step_bytes):
                    w = Words([t for t, _, _ in step], polynomials)
                    if not len(w):
                        continue
                    langs = [lang for _, lang, _ in step]
                    number = np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in langs], np.uint64)[w.text]
                    ids = np.array([_NO_ID if i is None else i for _, _, i in step], np.int64)
                    frequent = np.ones(len(w), bool)
                    for m in before:
                        at = np.flatnonzero(w.whole(m))
                        prints = w.prints(m, at, number)
                        hit = seen.has(prints)
                        at, prints = at[hit], prints[hit]
                        frequent = np.zeros(len(w), bool)
                        frequent[at] = True
                        if len(at):
                            yield from _texts_of(w, m, at, prints, number, langs, ids)
                    if not before:
                        total = {}
                        for lang, n in zip(langs, np.bincount(w.text, minlength=len(langs)).tolist()):
                            total[lang] = total.get(lang, 0) + n
                        yield _rows(np.zeros(len(total)), pa.array([lang + "\n" for lang in total], pa.string()), list(total.values()), np.full(len(total), _NO_ID))
                    part_size = before[-1] if before else 1
                    for m in now:
                        wanted = w.whole(m)
                        for i in range(m - part_size + 1):  # every part of the length counted before
                            wanted[:len(w) - i] &= frequent[i:]
                        at = np.flatnonzero(wanted)
                        if len(at):
                            prints = w.prints(m, at, number)
                            order, starts = _grouped(prints)
                            yield _rows(prints[order[starts]], None, np.diff([*starts, len(order)]),
                                        np.minimum.reduceat(ids[w.text[at[order]]], starts))

    def run(batches):
        yield from _added_up(rows(batches))
        give_back()

    return run


def scans(max_words: int) -> list[tuple[list[int], list[int]]]:
    """(lengths that get texts, lengths counted) of every scan."""
    counted = [m for m in ([1], [2], [3], list(range(4, max_words + 1))) if m and m[0] <= max_words]
    return list(zip([[], *counted], [*counted, []]))


def frequent_phrases(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     max_words: int = 5, min_count: int = 100, filter_bits: int = 27,
                     step_bytes: int = STEP_BYTES) -> tuple[DataFrame, DataFrame]:
    """Tables ``(words, lang, phrase, n, first_id)`` of the phrases of 1 to
    ``max_words`` words with at least ``min_count`` occurrences in a language,
    and ``(lang, n)`` of all word occurrences.

    A-Z are lowered, texts are split at ``.,;:!?`` and the line ends
    0x0A-0x0D into pieces, pieces at blanks and tabs into words.  Overlapping
    occurrences all count.  Null texts are empty, a null language is ``und``.
    ``first_id`` is the smallest id with the phrase (null if all ids are)."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"),
                        F.coalesce(F.col(lang_col), F.lit("und")).alias("_lang"))
    cut = F.length("text") - F.length(F.substring_index("text", "\n", -1))  # a language may hold line ends, a phrase none
    found, totals, known = [], None, None
    for before, now in scans(max_words):
        rows = texts.mapInArrow(_scan(before, now, known, step_bytes), _ROWS)
        counts = written(rows.groupBy("print", "text").agg(F.sum("n").alias("n"), F.min("first_id").alias("first_id"))
                         .filter((F.col("n") >= min_count) | F.col("text").endswith("\n")))
        named = counts.filter("text is not null").select(
            F.col("text").substr(F.lit(1), cut - 1).alias("lang"), F.substring_index("text", "\n", -1).alias("phrase"), "n", "first_id")
        if not before:
            totals = named.select("lang", "n")
        else:
            found.append(named.select(F.size(F.split("phrase", " ")).alias("words"), "lang", "phrase", "n", "first_id"))
        if now:
            held = print_filter(counts.filter("text is null"), filter_bits)
            if not held.words.any():
                break
            known = spark.sparkContext.broadcast(held)
    return written(reduce(DataFrame.unionByName, found)) if found else _none(spark), totals


def _none(spark) -> DataFrame:
    return spark.createDataFrame([], "words int, lang string, phrase string, n long, first_id long")


def collocations(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                 max_words: int = 5, min_count: int = 100, cover: int = 100, top: int = 2000,
                 filter_bits: int = 27, step_bytes: int = STEP_BYTES) -> DataFrame:
    """The ``top`` phrases of every language: ``(lang, rank, phrase, a, l, r,
    n, score, first_id)``.

    Candidates are the phrases of 2 to ``max_words`` words of
    :func:`frequent_phrases`, a their number.  A cut after the first k words
    has l and r, the numbers of its two parts, and the score
    floor(1000 * a * n / (l * r)), n being all words of the language, in
    exact integers; the lowest score counts, of equal ones the smallest k.
    A candidate contained in a longer one with at least ``cover`` percent of
    its occurrences is left out.  Order: score and a descending, phrase
    ascending by UTF-8 bytes.  Repeated rows count as often as they occur;
    an empty table, or one without frequent phrases, gives no row; further
    columns are not read."""
    phrases, totals = frequent_phrases(docs, id_col, text_col, lang_col, max_words, min_count, filter_bits, step_bytes)
    chosen = phrases.filter("words >= 2").withColumn("w", F.split("phrase", " "))
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda size: F.transform(
        F.sequence(F.lit(1), F.col("words") - size + 1), lambda i: F.array_join(F.slice(F.col("w"), i, size), " "))))
    covers = (explode_rows(chosen.filter("words >= 3"), ["lang", "n"], inner, "phrase")
              .groupBy("lang", "phrase").agg(F.max("n").alias("_cover")))
    kept = (chosen.join(covers, ["lang", "phrase"], "left")
            .filter(F.col("_cover").isNull() | (100 * F.col("_cover") < cover * F.col("n"))))
    cut = F.transform(F.sequence(F.lit(1), F.col("words") - 1), lambda k: F.struct(
        k.alias("k"), F.array_join(F.slice(F.col("w"), F.lit(1), k), " ").alias("left"),
        F.array_join(F.slice(F.col("w"), k + 1, F.col("words") - k), " ").alias("right")))
    cuts = written(explode_rows(kept, ["lang", "phrase", F.col("n").alias("a"), "first_id"], cut, "_cut")
                   .select("lang", "phrase", "a", "first_id", "_cut.*"))
    total = cuts.count()
    for side, name in (("left", "l"), ("right", "r")):
        uses = cuts.groupBy("lang", side).agg(F.count("*").alias("_uses"))
        part = written(uses.join(phrases.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", side]))
        cuts = lookup(cuts, part, ["lang", side], "_uses", total)
    per_lang = cuts.groupBy("lang").agg(F.count("*").alias("_uses")).join(totals, "lang")
    cuts = lookup(cuts, per_lang, ["lang"], "_uses", total)
    exact = "cast({} as decimal(19, 0))".format
    score = F.expr(f"({exact('a')} * 1000 * {exact('n')}) div ({exact('l')} * {exact('r')})")
    worst = cuts.groupBy("lang", "phrase", "a", "n", "first_id").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("_cut"))
    ranked = worst.select("lang", "phrase", "a", "_cut.l", "_cut.r", "n", "_cut.score", "first_id")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # a language is ranked in parts first, as many as make parts and their union equally large
    parts = max(1, math.isqrt(total // top))
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(parts))).orderBy(*order)
    ranked = ranked.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= top)
    return (ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "first_id"))
