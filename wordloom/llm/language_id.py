"""Language ID with language-bitmask n-gram filters.

For every language the character n-grams that make up at least a given share
of its training text are inserted into one bit-sliced Bloom filter: row r of
the filter is a bitmask over languages, and an n-gram's rows ANDed together
give all languages that contain it.  A text is scored by the number of its
n-grams per language (a popcount per bit), corrected for the filter's false
positives, and the largest corrected share decides.

Plan: the n-gram counts are aggregated in the tasks, batch after batch, and
summed in Spark by (language, n-gram).  A share of at least ``min_share``
bounds the n-grams of a language by 1 / min_share at any corpus size, so the
filter has a proven size; it is built in Spark (one bit_or per row) and only
its rows come to the driver.  Prediction is one pass over the texts without
a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm.common import map_texts, pieces, written

UNKNOWN = "und"
N = 4
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_LETTER = None


def letters() -> np.ndarray:
    """Whether each code point is a letter (made once per process)."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTER


def gram_hashes(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each n-gram, first n-gram of each text with the end last,
    whether a text has a letter).

    Texts are lower-cased, every run of other characters becomes one space,
    two spaces are added at both ends, and n-grams are ``N`` code points.
    """
    joined = "\x00".join(("  " + t.lower() + "  ").replace("\x00", " ") if t else "" for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters()[codes]
    end = codes == 0
    doc = np.cumsum(end) - end  # a separator belongs to the text before it
    has = np.bincount(doc[is_letter], minlength=len(texts))[:len(texts)] > 0
    # keep letters, separators, and the first two characters of a gap only at a text's ends
    space = ~is_letter & ~end
    first = space.copy()
    first[1:] &= ~space[:-1]
    edge = np.zeros(len(codes), bool)
    if len(codes):
        cuts = np.flatnonzero(end)
        lead = np.concatenate([[0], cuts + 1])
        tail = np.concatenate([cuts, [len(codes)]]) - 1
        full = lead < tail
        edge[lead[full]], edge[lead[full] + 1] = True, True
        edge[tail[full]], edge[tail[full] - 1] = True, True
    keep = is_letter | end | first | edge
    codes = np.where(space, np.uint32(32), codes)[keep].astype(np.uint64)
    doc = doc[keep]
    m = len(codes) - N + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64), has
    h = codes[:m].copy()
    for i in range(1, N):
        h = (h << np.uint64(16)) ^ (h >> np.uint64(48)) ^ (codes[i:m + i] * _MIX[0])
    h = (h ^ (h >> np.uint64(30))) * _MIX[1]
    h = (h ^ (h >> np.uint64(27))) * _MIX[2]
    h ^= h >> np.uint64(31)
    inside = (doc[:m] == doc[N - 1:]) & (codes[N - 1:] != 0) & (codes[:m] != 0)
    starts = np.searchsorted(doc[:m][inside], np.arange(len(texts) + 1))
    return h[inside], starts, has


def row_indexes(h: np.ndarray, n_hashes: int, n_rows: int) -> list[np.ndarray]:
    """The filter rows of each n-gram by double hashing; n_rows is a power of two."""
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [((h + np.uint64(i) * step) & np.uint64(n_rows - 1)).astype(np.int64) for i in range(n_hashes)]


class BitSlicedFilter:
    """Bloom filters of all languages, sliced by row: ``rows[r, w]`` holds
    the bits of languages 64 * w to 64 * w + 63."""

    def __init__(self, languages: list[str], rows: np.ndarray, n_hashes: int):
        self.languages, self.rows, self.n_hashes = languages, rows, n_hashes
        bits = np.array([((rows[:, j // 64] >> np.uint64(j % 64)) & np.uint64(1)).mean() if len(rows) else 0.0
                         for j in range(len(languages))])
        self.false_positive = bits ** n_hashes

    def masks(self, h: np.ndarray) -> np.ndarray:
        """The language bitmask of each n-gram."""
        at = row_indexes(h, self.n_hashes, len(self.rows))
        out = self.rows[at[0]]
        for a in at[1:]:
            out &= self.rows[a]
        return out

    def shares(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(text x language) corrected shares in 0..1, and whether each text has a letter."""
        h, starts, has = gram_hashes(texts)
        n = np.diff(starts)
        masks = self.masks(h)
        out = np.zeros((len(texts), len(self.languages)))
        for j, p in enumerate(self.false_positive):
            hit = np.concatenate([[0], np.cumsum((masks[:, j // 64] >> np.uint64(j % 64)) & np.uint64(1))])
            count = (hit[starts[1:]] - hit[starts[:-1]]).astype(float)
            out[:, j] = (count - n * p) / np.maximum(n * (1 - p), 1e-9)
        return np.clip(out, 0, 1), has


def fit_languages(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                  min_share: float = 2e-5, n_hashes: int = 4, max_languages: int = 4096) -> BitSlicedFilter:
    """Learn the filter from all rows with a text and a language.

    The languages' names come to the driver: more than ``max_languages`` is
    an error.  No rows give a filter without languages."""
    train = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter(
        "lang is not null and text is not null")

    def count(batches):
        held: dict[str, list] = {}
        size = 0

        def flush():
            for lang, parts in held.items():
                g, c = _merge(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(g), pa.string()), pa.array(g.view(np.int64)), pa.array(c)],
                    names=["lang", "gram", "n"])

        for batch in batches:
            for part in pieces(batch, "text"):
                langs = np.array(part.column("lang").to_pylist(), object)
                texts = part.column("text").to_pylist()
                for lang in dict.fromkeys(langs.tolist()):
                    h, _, _ = gram_hashes([t for t, l in zip(texts, langs) if l == lang])
                    g, c = np.unique(h, return_counts=True)
                    held.setdefault(lang, []).append((g, c.astype(np.int64)))
                    size += len(g)
                if size > 1_000_000:
                    held = {lang: [_merge(parts)] for lang, parts in held.items()}
                    size = sum(len(p[0][0]) for p in held.values())
                    if size > 500_000:
                        yield from flush()
                        held, size = {}, 0
        yield from flush()

    counts = train.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = written(counts)
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    names = sorted(r["lang"] for r in totals.select("lang").limit(max_languages + 1).collect())
    if len(names) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    words = max(1, -(-len(names) // 64))
    if not names:
        return BitSlicedFilter([], np.zeros((1, 1), np.uint64), n_hashes)
    # totals has one row per language, at most max_languages of them
    kept = written(counts.join(F.broadcast(totals), "lang").filter(F.col("n") >= min_share * F.col("total"))
                   .select("lang", "gram"))
    largest = kept.groupBy("lang").count().agg(F.max("count")).first()[0] or 1
    n_rows = 1 << int(np.ceil(np.log2(max(1024, 16 * largest))))
    number = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i))])
    place = kept.select(number[F.col("lang")].alias("j"), "gram")

    def rows_of(batches):
        for batch in batches:
            j = batch.column("j").to_numpy()
            h = batch.column("gram").to_numpy().view(np.uint64)
            for at in row_indexes(h, n_hashes, n_rows):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at), pa.array((j // 64).astype(np.int32)),
                     pa.array((np.uint64(1) << (j % 64).astype(np.uint64)).view(np.int64))], names=["r", "w", "bits"])

    slices = (place.mapInArrow(rows_of, "r long, w int, bits long").groupBy("r", "w")
              .agg(F.bit_or("bits").alias("bits")).toArrow())  # at most n_rows rows per word of languages
    rows = np.zeros((n_rows, words), np.uint64)
    rows[slices.column("r").to_numpy(), slices.column("w").to_numpy()] = slices.column("bits").to_numpy().view(np.uint64)
    return BitSlicedFilter(names, rows, n_hashes)


def _merge(parts: list) -> tuple[np.ndarray, np.ndarray]:
    g, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return g, np.bincount(inverse, np.concatenate([p[1] for p in parts])).astype(np.int64)


def predict_language(docs: DataFrame, model: BitSlicedFilter, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the corrected share of the
    chosen language's n-grams, 0 to 1) added; input columns of these names
    are replaced.

    Null texts and texts without a letter are ``und`` with score 0, and so is
    every text if the model has no language.  Ties, also among texts whose
    n-grams no language contains, go to the smallest language name.  A row's
    result depends on its text alone, so repeated rows agree.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded, see fit_languages

    def make():
        model = shared.value

        def step(texts):
            if not model.languages:
                return [[UNKNOWN] * len(texts), np.zeros(len(texts))]
            share, has = model.shares(texts)
            best = share.argmax(1)
            return [[model.languages[b] if ok else UNKNOWN for b, ok in zip(best, has)],
                    np.where(has, share[np.arange(len(texts)), best], 0.0)]
        return step

    return map_texts(docs, text_col, [T.StructField("lang_pred", T.StringType()),
                                      T.StructField("score", T.DoubleType())], make)
