"""Toxicity by a classifier chain.

The categories are predicted one after another: the model of a category is a
linear one (logistic regression) over word features and the log-odds of all
earlier categories.  In training those come from out-of-fold predictions, so
that a later model sees earlier probabilities as unreliable as they will be
on new texts.

Plan: training uses a bounded sample of the labelled rows (``max_train``, the
smallest seeded hashes of the id).  Feature statistics of the sample are
aggregated in Spark and the features most associated with a category are
kept (chi-squared, ``max_features`` each); the small training matrix comes
to the driver and is fitted with numpy.  Prediction is one pass over all
texts without a shuffle; a word's features are looked up once per task.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm.common import map_texts, written

PREFIXES = (4, 5, 6)
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
#: Words a task remembers.
CACHE = 200_000


def _hash(name: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(name.encode("utf-8", "surrogatepass")) - (1 << 63)


def word_features(word: str) -> list[int]:
    """64-bit hashes of a word in lower case without punctuation at its ends,
    of its first 4, 5 and 6 characters where it is longer, and of its shape:
    the marks at its end, and whether it is all capitals."""
    core = _EDGE.sub("", word)
    low = core.lower()
    names = [f"w:{low}"] + [f"p:{low[:n]}" for n in PREFIXES if len(low) > n] if core else ["w:"]
    end = word[len(word.rstrip("".join({c for c in word if not (c.isalnum() or c == "_")}))):] if word != core else ""
    if end not in ("", ".", ","):
        names.append(f"e:{end[:8]}")
    if len(core) > 1 and core.isupper():
        names.append("caps")
    return [_hash(n) for n in names]


def text_features(words: list[str]) -> list[int]:
    """Hashes of what a text's words look like together: their number (by
    powers of two) and the share of different ones (in tenths)."""
    if not words:
        return [_hash("empty")]
    return [_hash(f"n:{len(words).bit_length()}"), _hash(f"u:{10 * len(set(words)) // len(words)}")]


class Lookup(dict):
    """Word -> number of its set of selected features; 0 for none."""

    def __init__(self, selected: np.ndarray):
        self.place = {int(k): i for i, k in enumerate(selected)}
        self.sets: list[tuple] = [()]
        self.known: dict[tuple, int] = {(): 0}

    def __missing__(self, word: str) -> int:
        found = tuple(sorted({self.place[f] for f in word_features(word) if f in self.place}))
        code = self.known.setdefault(found, len(self.sets))
        if code == len(self.sets):
            self.sets.append(found)
        if len(self) < CACHE or code:
            self[word] = code
        return code

    def of(self, text: str | None) -> list[int]:
        """The selected features of a whole text, each once."""
        if not text:
            return []
        words = text.split()
        codes = set(map(self.__getitem__, words))
        whole = (self.place[f] for f in text_features(words) if f in self.place)
        return sorted({*whole, *(i for c in codes for i in self.sets[c])})


class Linear:
    """Logistic regression on sparse binary features and a few dense ones."""

    def __init__(self, weights: np.ndarray, dense: np.ndarray, bias: float):
        self.weights, self.dense, self.bias = weights, dense, bias

    def margin(self, rows: np.ndarray, cols: np.ndarray, n: int, extra: np.ndarray) -> np.ndarray:
        return np.bincount(rows, self.weights[cols], minlength=n) + extra @ self.dense + self.bias

    @staticmethod
    def fit(rows, cols, n, n_features, extra, y, l2: float, steps: int = 60) -> "Linear":
        """L-BFGS on the penalised log-loss; the bias is not penalised."""
        d = n_features + extra.shape[1]
        prior = (y.sum() + 0.5) / (n + 1)

        def value(w):
            m = np.bincount(rows, w[cols], minlength=n) + extra @ w[n_features:d] + w[d]
            p = 1 / (1 + np.exp(-np.clip(m, -40, 40)))
            r = p - y
            grad = np.concatenate([np.bincount(cols, r[rows], minlength=n_features), extra.T @ r, [r.sum()]])
            grad[:d] += l2 * w[:d]
            return np.logaddexp(0, m).sum() - (y * m).sum() + l2 / 2 * (w[:d] ** 2).sum(), grad

        w = np.zeros(d + 1)
        w[d] = np.log(prior / (1 - prior))
        f, g = value(w)
        pairs: list = []
        for _ in range(steps):
            q, alphas = g.copy(), []
            for s, t, rho in reversed(pairs):
                alphas.append(rho * (s @ q))
                q -= alphas[-1] * t
            if pairs:
                s, t, _ = pairs[-1]
                q *= (s @ t) / (t @ t)
            else:
                q /= max(1.0, np.linalg.norm(q))
            for (s, t, rho), a in zip(pairs, reversed(alphas)):
                q += s * (a - rho * (t @ q))
            step, slope = 1.0, g @ q
            while step > 1e-8:
                f2, g2 = value(w - step * q)
                if f2 <= f - 1e-4 * step * slope:
                    break
                step /= 2
            else:
                break
            s, t = -step * q, g2 - g
            if s @ t > 1e-12:
                pairs = [*pairs[-7:], (s, t, 1 / (s @ t))]
            done = abs(f - f2) < 1e-7 * max(1.0, abs(f))
            w, f, g = w + s, f2, g2
            if done:
                break
        return Linear(w[:n_features], w[n_features:d], w[d])


class Chain:
    """Selected features, one linear model per category, in order, and the
    probability from which a category is predicted."""

    def __init__(self, categories: list[str], selected: np.ndarray, models: list[Linear], thresholds: list[float]):
        self.categories, self.selected, self.models, self.thresholds = categories, selected, models, thresholds

    def margins(self, rows, cols, n) -> np.ndarray:
        extra = np.zeros((n, 0))
        for model in self.models:
            extra = np.column_stack([extra, model.margin(rows, cols, n, extra)])
        return extra


def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = [len(x) for x in lists]
    return (np.repeat(np.arange(len(lists)), sizes),
            np.fromiter((i for x in lists for i in x), np.int64, sum(sizes)))


def fit_chain(docs: DataFrame, labels: DataFrame, categories: dict[str, str], id_col: str = "doc_id",
              text_col: str = "text", max_train: int = 20_000, max_features: int = 2048,
              folds: int = 5, l2: float = 0.1, min_docs: int = 3) -> Chain:
    """Fit the chain on at most ``max_train`` labelled rows.

    ``categories`` maps each category, in chain order, to a SQL condition on
    a row of ``labels``; a condition that is null counts as false.  Labels
    without a document, documents without a label or text, and null ids take
    no part.  A category with one class only gets a model without features,
    i.e. the smoothed prior.
    """
    names = list(categories)
    marks = [F.coalesce(F.expr(sql).cast("int"), F.lit(0)).alias(f"y{i}") for i, sql in enumerate(categories.values())]
    sample = (labels.select(F.col(id_col).alias("id"), *marks).filter("id is not null")
              .orderBy(F.xxhash64("id"), "id").limit(max_train).groupBy("id").agg(
                  *[F.max(f"y{i}").alias(f"y{i}") for i in range(len(names))]))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text is not null")

    def make():
        def step(texts):
            split = [t.split() for t in texts]
            return [[sorted({*text_features(w), *(f for x in set(w) for f in word_features(x))}) for w in split]]
        return step

    # at most max_train rows: broadcast by that bound, the texts are not shuffled
    train = map_texts(texts.join(F.broadcast(sample), "id"), "text",
                      [T.StructField("features", T.ArrayType(T.LongType()))], make, drop=("text",))
    train = written(train)
    sums = [F.sum(f"y{i}").alias(f"p{i}") for i in range(len(names))]
    total = train.agg(F.count("*").alias("n"), *sums).first()
    n = total["n"] or 0
    counts = train.withColumn("f", F.explode("features")).groupBy("f").agg(F.count("*").alias("n"), *sums)
    counts = written(counts.filter(F.col("n") >= min_docs))
    keys: set[int] = set()
    for i in range(len(names)):
        pos = total[f"p{i}"] or 0
        if 0 < pos < n:
            lift = F.col(f"p{i}") * float(n) - F.col("n") * float(pos)
            score = lift * lift * float(n) / (F.col("n") * (float(n) - F.col("n")) * float(pos) * float(n - pos))
            best = (counts.filter(F.col("n") < n).select("f", score.alias("s")).filter("s > 10.83")  # p < 0.001
                    .orderBy(F.desc("s"), "f").limit(max_features))
            keys |= {r["f"] for r in best.collect()}
    selected = np.array(sorted(keys), np.int64)
    shared = train.sparkSession.sparkContext.broadcast(selected)

    def pick(batches):
        keep = shared.value
        for batch in batches:
            column = batch.column("features")
            flat_ = column.flatten().to_numpy()
            at = np.minimum(np.searchsorted(keep, flat_), max(0, len(keep) - 1))
            hit = keep[at] == flat_ if len(keep) else np.zeros(len(flat_), bool)
            ends = np.concatenate([[0], np.cumsum(hit)])[column.offsets.to_numpy() - column.offsets[0].as_py()]
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(at[hit].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), lists, *(batch.column(f"y{i}") for i in range(len(names)))],
                                             names=["id", "features", *(f"y{i}" for i in range(len(names)))])

    schema = T.StructType([train.schema["id"], T.StructField("features", T.ArrayType(T.IntegerType())),
                           *(train.schema[f"y{i}"] for i in range(len(names)))])
    matrix = train.mapInArrow(pick, schema).orderBy("id").toArrow()  # at most max_train rows of selected features
    rows, cols = flat(matrix.column("features").to_pylist())
    n = matrix.num_rows
    fold = np.array([_fold(i, folds) for i in matrix.column("id").to_pylist()], np.int64)
    extra, models, thresholds = np.zeros((n, 0)), [], []
    for i in range(len(names)):
        y = matrix.column(f"y{i}").to_numpy().astype(float)
        held = np.zeros(n)
        for k in range(folds):
            inside = fold != k
            take = inside[rows]
            number = np.cumsum(inside) - 1
            part = Linear.fit(number[rows[take]], cols[take], int(inside.sum()), len(selected), extra[inside], y[inside], l2)
            out = ~inside
            take, number = out[rows], np.cumsum(out) - 1
            held[out] = part.margin(number[rows[take]], cols[take], int(out.sum()), extra[out])
        models.append(Linear.fit(rows, cols, n, len(selected), extra, y, l2))
        extra = np.column_stack([extra, held])
        thresholds.append(best_threshold(1 / (1 + np.exp(-np.clip(held, -700, 700))), y))
    return Chain(names, selected, models, thresholds)


def best_threshold(prob: np.ndarray, y: np.ndarray) -> float:
    """The probability between two out-of-fold predictions that gives the
    best F1; 0.5 without both classes."""
    if not 0 < y.sum() < len(y):
        return 0.5
    order = np.argsort(-prob, kind="stable")
    p, hits = prob[order], np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    f1[:-1][p[:-1] == p[1:]] = -1  # equal predictions can't be told apart
    i = int(f1.argmax())
    return float((p[i] + (p[i + 1] if i + 1 < len(p) else 0.0)) / 2)


def _fold(value, folds: int) -> int:
    import zlib

    return zlib.crc32(str(value).encode()) % folds


def predict_chain(docs: DataFrame, chain: Chain, text_col: str = "text") -> DataFrame:
    """``docs`` with ``<category>_prob`` (double) and ``<category>``
    (boolean: at least the chain's threshold) added per category; input columns of
    these names are replaced.  A null or empty text has no features and gets
    the chain's prior; a row's result depends on its whole text alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # at most max_features per category
    fields = [f for c in chain.categories for f in
              (T.StructField(f"{c}_prob", T.DoubleType()), T.StructField(c, T.BooleanType()))]

    def make():
        chain = shared.value
        lookup = Lookup(chain.selected)

        def step(texts):
            rows, cols = flat([lookup.of(t) for t in texts])
            margins = chain.margins(rows, cols, len(texts))
            prob = 1 / (1 + np.exp(-np.clip(margins, -700, 700)))
            return [x for j in range(prob.shape[1]) for x in (prob[:, j], prob[:, j] >= chain.thresholds[j])]
        return step

    return map_texts(docs, text_col, fields, make)
