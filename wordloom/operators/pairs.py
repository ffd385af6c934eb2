"""Pairs of terms made and added up in a task: a helper of the co-occurrence
operators, applied by Spark to the Arrow batches of a partition."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Terms of the rows whose pairs are added up together, and most pairs held at once (a term's partners in one row may be more).
BATCH_TERMS, STRIP_PAIRS = 2_000_000, 2_000_000
STRIPES = "t1 string, t2 string, n array<long>"
CODED_STRIPES = "t1 string, t2 string, c array<short>, n array<long>"
#: Most words that travel as a number of two bytes, which is their place less ``SHORT``.
COMMON, SHORT = 65_536, 32_768
GRAMS = "t1 string, n1 long, t2 string, n array<long>"
#: Rows that a task hands over at once.
ROWS_OUT = 50_000
#: Stands between the partners of a term; in a term it is escaped.
SEPARATOR, ESCAPE = "\x00", "\x01"


def unescaped(c: str) -> Column:
    """A term as it was before it travelled."""
    back = F.replace(F.replace(c, F.lit(ESCAPE + "0"), F.lit(SEPARATOR)), F.lit(ESCAPE + "1"), F.lit(ESCAPE))
    return F.when(F.contains(F.col(c), F.lit(ESCAPE)), back).otherwise(F.col(c))


def stripes(batches: Iterator[pa.RecordBatch], window: int | None = None, common: Sequence[str] | None = None) -> Iterator[pa.RecordBatch]:
    """From rows ``(t, n, cut)``, lists of terms with their counts (null: 1
    each, repeats are added), rows ``(t1, t2, n)``: a term, its later
    partners joined by ``SEPARATOR`` and the sums of the products.  With a
    ``window`` rows are ``(t)``, and a term meets the different ones of the
    next ``window`` places.

    With ``common`` (at most ``COMMON`` words, the most frequent first) rows
    are ``(t1, t2, c, n)``.  Of a pair the rarer term is ``t1``, so nearly all
    partners are common: these are in ``c``, as their place less
    ``SHORT``, in a row without ``t2``; the others in one without ``c``."""
    known = None if common is None else _escaped_words(pa.array(common, pa.string()))
    for held in _pieces(batches, ["t"]):
        yield from _added(held, window, known)


def grams(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """From rows ``(t)``, lists of terms, rows ``(t1, n1, t2, n)``: n - 1
    terms in a row (joined by blanks) with how often they are there, and the
    terms that follow, joined by ``SEPARATOR``, with how often each does."""
    for held in _pieces(batches, ["t"]):
        for made in _added_grams(held, n):
            yield from (made.slice(i, ROWS_OUT) for i in range(0, len(made), ROWS_OUT))


class Arm(NamedTuple):
    """Terms of n - 1 and of n tokens of a column and what they are called
    (n = 1: the tokens alone, called ``shorter``)."""
    column: str
    n: int
    shorter: str
    longer: str | None = None


def grams_by(batches: Iterator[pa.RecordBatch], by: str, arms: Sequence[Arm]) -> Iterator[pa.RecordBatch]:
    """:func:`grams` per value of the column ``by`` (null is one) and arm:
    rows ``(by, v1, v2, t1, n1, t2, n)`` with the arm's names."""
    for held in _pieces(batches, [a.column for a in arms]):
        for a in arms:
            named = [pa.RecordBatch.from_arrays([b.column(a.column), b.column(by)], ["t", "by"]) for b in held]
            for made in _added_grams(named, max(a.n, 2), by, a.n > 1):
                for i, name in enumerate((a.shorter, a.longer)):
                    made = made.add_column(1 + i, f"v{1 + i}", pa.array([name] * len(made), pa.string()))
                yield from (made.slice(i, ROWS_OUT) for i in range(0, len(made), ROWS_OUT))


def _pieces(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[list[pa.RecordBatch]]:
    """The rows in pieces that hold ``BATCH_TERMS`` terms in one of the
    columns (one row may hold more), however the batches are cut."""
    held, terms = [], 0
    for batch in batches:
        sizes = [pc.fill_null(pc.list_value_length(batch.column(c)), 0).to_numpy(zero_copy_only=False) for c in columns]
        ends, begin = np.cumsum(np.maximum.reduce(sizes), dtype=np.int64), 0
        while begin < len(batch):
            done = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, done + BATCH_TERMS - terms, "right")))
            held.append(batch.slice(begin, end - begin))
            terms, begin = terms + int(ends[end - 1] - done), end
            if begin < len(batch) or terms >= BATCH_TERMS:
                yield held
                held, terms = [], 0
    if terms:
        yield held


def _added_grams(batches: list[pa.RecordBatch], n: int, by: str | None = None, followed: bool = True) -> Iterator[pa.RecordBatch]:
    table, _, row, code, words = _coded(batches)
    at = np.arange(max(0, len(row) - n + 2))
    at = at[row[at] == row[at + n - 2]]
    if not len(at):
        return
    head = code[at]
    for j in range(1, n - 1):  # numbered anew each time, so that the products stay small
        head = np.unique(head * len(words) + code[at + j], return_inverse=True)[1]
    if by:
        group = table.column("by").combine_chunks().dictionary_encode(null_encoding="encode")
        of_row = group.indices.to_numpy()
        head = head * len(group.dictionary) + of_row[row[at]]
    if followed:
        last = np.minimum(at + n - 1, len(row) - 1)
        follows = np.where((last == at + n - 1) & (row[last] == row[at]), code[last] + 1, 0)  # 0: the row ends
    else:
        follows = 0
    key, k, first = _summed(head * (len(words) + 1) + follows, None)
    head, follows = key // (len(words) + 1), key % (len(words) + 1)
    starts = np.flatnonzero(np.concatenate([[True], head[1:] != head[:-1]]))
    some = follows > 0
    offsets = pa.array(np.append(0, np.cumsum(np.add.reduceat(some, starts, dtype=np.int64))).astype(np.int32))
    heads = pc.binary_join_element_wise(*[words.take(pa.array(code[at[first[starts]] + j])) for j in range(n - 1)], " ")
    tails = pc.binary_join(pa.ListArray.from_arrays(offsets, words.take(pa.array(follows[some] - 1))), SEPARATOR)
    made = pa.RecordBatch.from_arrays([heads, pa.array(np.add.reduceat(k, starts)), tails, pa.ListArray.from_arrays(offsets, pa.array(k[some]))],
                                      ["t1", "n1", "t2", "n"])
    yield made.add_column(0, by, group.dictionary.take(pa.array(head[starts] % len(group.dictionary)))) if by else made


def _coded(batches: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """The rows as a table, their sizes, each term's row and code, and the words by code (escaped)."""
    table = pa.Table.from_batches(batches)
    t = table.column("t")
    sizes = pc.fill_null(pc.list_value_length(t), 0).to_numpy()
    words = pa.chunked_array([c.flatten() for c in t.chunks]).combine_chunks().dictionary_encode()
    # codes in the order of the words' bytes, which is Spark's; a null is -1
    order = pc.sort_indices(words.dictionary).to_numpy()
    rank = np.full(len(order) + 1, -1, np.int64)
    rank[order] = np.arange(len(order))
    code = rank[pc.fill_null(words.indices, len(order)).to_numpy()]
    escaped = _escaped_words(words.dictionary.take(pa.array(order)))
    row = np.repeat(np.arange(len(sizes)), sizes)
    return table, sizes, row, code, escaped


def _escaped_words(words: pa.Array) -> pa.Array:
    return pc.replace_substring(pc.replace_substring(words, ESCAPE, ESCAPE + "1"), SEPARATOR, ESCAPE + "0")


def _added(batches: list[pa.RecordBatch], window: int | None, common: pa.Array | None = None) -> Iterator[pa.RecordBatch]:
    table, sizes, row, code, escaped = _coded(batches)
    n_words = len(escaped)
    if common is not None:
        # numbered anew: the rare words first, by their bytes, then the common ones up to the most frequent
        place = pc.fill_null(pc.index_in(escaped, value_set=common), -1).to_numpy()
        anew = np.lexsort((np.arange(n_words), -place, place >= 0))
        number = np.full(n_words + 1, -1, np.int64)
        number[anew] = np.arange(n_words)
        code, escaped, place = number[code], escaped.take(pa.array(anew)), place[anew]
    if window:
        n = cut = side = None
    else:
        row, code, n, cut, side = _terms_of_rows(table, row, code, sizes, n_words)
    later = np.searchsorted(row, row, "right") - np.arange(len(row)) - 1
    if window:
        later = np.minimum(later, window)
    lefts = np.argsort(code, kind="stable")  # by term, so that a strip has a term's rows together
    ends = np.cumsum(later[lefts])
    begin = 0
    while begin < len(lefts):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + STRIP_PAIRS, "right")))
        left, begin = lefts[begin:end], end
        k = later[left]
        step = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        left = np.repeat(left, k)
        right = left + 1 + step
        if window:
            keep = (code[left] != code[right]) & (code[left] >= 0) & (code[right] >= 0)
            left, right = left[keep], right[keep]
        elif cut.any():
            keep = (cut[row[left]] == 0) | (side[left] != side[right])
            left, right = left[keep], right[keep]
        if len(left):
            t1, t2 = np.minimum(code[left], code[right]), np.maximum(code[left], code[right])
            key, total, _ = _summed(t1 * n_words + t2, None if window else n[left] * n[right])
            t1, t2 = key // n_words, key % n_words
            if common is None:
                yield _joined(escaped, t1, t2, total)
                continue
            often = place[t2] >= 0
            for some, codes in ((often, place), (~often, None)):
                if some.any():
                    yield _joined(escaped, t1[some], t2[some], total[some], codes, True)


def _terms_of_rows(table: pa.Table, row: np.ndarray, code: np.ndarray, sizes: np.ndarray, n_words: int):
    """Each row's different terms in order with their counts; the rows' cuts and the side of its row's cut that a term is on."""
    counts = [c.flatten().to_numpy() if not c.null_count else np.ones(len(x.flatten()), np.int64)
              for c, x in zip(table.column("n").chunks, table.column("t").chunks)]
    cut = table.column("cut").to_numpy()
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at, n, first = _summed(row * n_words + code, np.concatenate(counts))
    row, code = at // n_words, at % n_words
    return row, code, n, cut, place[first] < cut[row]


def _summed(key: np.ndarray, n: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each key once, in order, with the sum of its ``n`` (or how often it
    is there) and its first place."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))[:len(key)]
    total = np.diff(np.append(starts, len(key))) if n is None else np.add.reduceat(n[order], starts) if len(key) else n
    return key[starts], total, order[starts]


def _joined(words: pa.Array, t1: np.ndarray, t2: np.ndarray, n: np.ndarray, place: np.ndarray | None = None, coded=False) -> pa.RecordBatch:
    starts = np.flatnonzero(np.concatenate([[True], t1[1:] != t1[:-1]]))
    offsets = pa.array(np.append(starts, len(t1)).astype(np.int32))
    of = lambda values: pa.ListArray.from_arrays(offsets, values)
    first, sums = words.take(pa.array(t1[starts])), of(pa.array(n))
    if place is not None:
        columns = [pa.nulls(len(starts), pa.string()), of(pa.array((place[t2] - SHORT).astype(np.int16)))]
    else:
        columns = [pc.binary_join(of(words.take(pa.array(t2))), SEPARATOR)] + [pa.nulls(len(starts), pa.list_(pa.int16()))] * coded
    return pa.RecordBatch.from_arrays([first, *columns, sums], ["t1", "t2", "c", "n"] if coded else ["t1", "t2", "n"])
