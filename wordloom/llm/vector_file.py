"""Exact top-k inner-product search with a vector-approximation file.

Each dimension is cut into 2**bits cells; a vector's cells (one byte per
dimension) bound its inner product with a query from below and above.  All
queries scan the cells, and only vectors whose upper bound reaches the
(k + 1)th lower bound stay.  The exact vectors are then read in the order of
the bound: first the best k + 1 per query, whose exact scores give a firmer
limit, then only those whose upper bound still reaches it.  After that the
kth result is certain.

Plan: equal vectors are one class with its k + 1 smallest ids (more can never
be among k results) and the number of rows of each, so a vector that a third
of the rows share is scanned once.  Blocks of queries meet blocks of cells as
groups of a cogroup; a group's size does not grow with the data, and each
returns only its few candidates per query.  Exact vectors move only for
candidates.  Equal queries share one list, which comes back to their rows by
``lookup``, so a vector that a third of the queries share is no hot key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.common import broadcast_if_small, lookup, written

#: Scaled components from here on are not exact as doubles.
LIMIT = 1 << 53
#: Stands for no id (the two smallest values are not ids).
NO_ID = -(1 << 63)


def scaled(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, v): floor(scale * x) of every component of the valid vectors; a
    component that is not exact as a double is an error."""
    whole = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ints = F.transform(vec_col, lambda x: F.when(
        F.abs(x.cast("double") * scale) < LIMIT, F.floor(x.cast("double") * scale)).otherwise(
        F.raise_error(F.lit("a scaled component is not exactly representable"))).cast("long"))
    return (df.select(F.col(id_col).cast("long").alias("id"), F.when(whole, ints).alias("v"))
            .filter("id is not null and v is not null"))


def matrix(column, dims: int) -> np.ndarray:
    """Rows of a list column as float64, shorter rows filled with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), dims))
    out[np.repeat(np.arange(len(column)), lengths),
        np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = column.flatten().to_numpy()
    return out


def quantiser(classes: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Per dimension: the lowest value and the cell width.  Only one row per
    dimension comes to the driver."""
    dims = classes.agg(F.max(F.size("v"))).first()[0] or 0

    def ends(batches):
        lo = hi = None
        for batch in batches:
            m = matrix(batch.column(0), dims)
            if len(m):
                lo = m.min(0) if lo is None else np.minimum(lo, m.min(0))
                hi = m.max(0) if hi is None else np.maximum(hi, m.max(0))
        if lo is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(lo), pa.array(hi)], names=["d", "lo", "hi"])

    rows = (classes.select("v").mapInArrow(ends, "d long, lo double, hi double").groupBy("d")
            .agg(F.min("lo"), F.max("hi")).orderBy("d").collect())
    lo, hi = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    return lo, np.maximum(1, np.ceil((hi - lo + 1) / (1 << bits)))


def largest(asked: DataFrame, dims: int) -> np.ndarray:
    """The largest absolute component of each dimension (one row each)."""
    rows = (asked.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(F.max(F.abs("x"))).collect())
    out = np.zeros(dims)
    for d, x in rows:
        if d < dims:
            out[d] = x
    return out


def exact_top_k(base: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id",
                vec_col: str = "embedding", scale: int = 1024, bits: int = 8,
                block: int = 16384, query_block: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row the ``k`` rows of
    ``base`` with other ids and the highest integer inner products, ties to
    the smaller id; all of them if there are fewer.

    Components become floor(scale * x); components from 2**53 on, and
    vectors whose products could pass 64 bits, are an error.  Vectors that
    are null or hold a null or non-finite component take no part, nor do
    rows with a null id.  Shorter vectors count as filled up with zeros.
    Every row counts: rows sharing an id, equal or not, are candidates of
    their own and queries of their own (each with ranks from 1), and all of
    them are left out for a query with their id.  Other columns are ignored.
    An empty side gives no rows.
    """
    spark = base.sparkSession
    rows = scaled(base, id_col, vec_col, scale)
    first = Window.partitionBy("v").orderBy("id")
    classes = (rows.groupBy("v", "id").agg(F.count("*").alias("rows"))
               .withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k + 1)
               .groupBy("v").agg(F.sort_array(F.collect_list(F.struct("id", F.least("rows", F.lit(k)).alias("rows")))).alias("ids")))
    classes = written(classes.withColumn("c", F.monotonically_increasing_id()))
    asked = scaled(queries, id_col, vec_col, scale)
    # ids with several vectors: their queries are told apart by id, and meet no class that only they hold
    several = broadcast_if_small(written(rows.join(asked.select("id").distinct(), "id", "left_semi").groupBy("id")
                                         .agg((F.min("v") < F.max("v")).alias("_s")).filter("_s").select("id", F.col("id").alias("own"))))
    asked = written(asked.join(several, "id", "left").withColumn("own", F.coalesce("own", F.lit(NO_ID)))
                    .withColumn("row", F.monotonically_increasing_id()))
    wanted = written(asked.groupBy("v", "own").agg(F.count("*").alias("n")).withColumn("q", F.monotonically_increasing_id()))
    n, nq = classes.count(), wanted.count()
    if not n or not nq:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    lo, width = quantiser(classes, bits)
    if int((np.maximum(np.abs(lo), np.abs(lo + width * (1 << bits))) * largest(asked, len(lo))).sum()) >= 1 << 62:
        raise ValueError("inner products could pass 64 bits")
    dims, n_blocks, n_queries = len(lo), -(-n // block), -(-nq // query_block)

    def to_cells(batches):
        for batch in batches:
            cells = ((matrix(batch.column("v"), dims) - lo) // width).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column("c"), batch.column("only"), pa.array([r.tobytes() for r in cells], pa.binary())],
                                             names=["c", "only", "cells"])

    only = F.when(F.size("ids") == 1, F.col("ids")[0]["id"]).otherwise(NO_ID + 1).alias("only")
    cells = written(classes.select("c", only, "v").mapInArrow(to_cells, "c long, only long, cells binary"))
    left = (cells.withColumn("vb", F.pmod(F.hash("c"), F.lit(n_blocks)))
            .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1)))))
    right = (wanted.select("q", "v", "own").withColumn("qb", F.pmod(F.hash("q"), F.lit(n_queries)))
             .withColumn("vb", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))))

    def scan(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        if len(left) and len(right):
            c = left.column("c").to_numpy()
            at = np.frombuffer(b"".join(left.column("cells").to_pylist()), np.uint8).reshape(len(c), dims)
            middle = lo + at * width + (width - 1) / 2
            ids, vectors = right.column("q").to_numpy(), matrix(right.column("v"), dims)
            holder, own = left.column("only").to_numpy(), right.column("own").to_numpy()
            error = np.abs(vectors) @ ((width - 1) / 2) + 1e-9 * (np.abs(vectors) @ np.abs(middle).max(0))
            for a in range(0, len(ids), 64):
                near = vectors[a:a + 64] @ middle.T
                near[own[a:a + 64, None] == holder] = -np.inf
                kth = np.partition(near, -min(k + 1, len(c)), axis=1)[:, -min(k + 1, len(c))]
                r, x = np.nonzero((near >= (kth - 2 * error[a:a + 64])[:, None]) & (near > -np.inf))
                for column, values in zip(out, (ids[a + r], c[x], near[r, x], error[a + r])):
                    column.append(values)
        kinds = (np.int64, np.int64, np.float64, np.float64)
        return pa.table([pa.array(np.concatenate([np.zeros(0, t), *v]).astype(t)) for v, t in zip(out, kinds)],
                        names=["q", "c", "near", "error"])

    found = written(left.groupBy("vb", "qb").cogroup(right.groupBy("vb", "qb"))
                    .applyInArrow(scan, "q long, c long, near double, error double"))
    best = Window.partitionBy("q").orderBy(F.desc("near"), "c")
    first_wave = found.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1).drop("n")

    def exact(pairs: DataFrame) -> DataFrame:
        score = F.aggregate(F.zip_with("qv", "v", lambda a, b: F.coalesce(a, F.lit(0)) * F.coalesce(b, F.lit(0))),
                            F.lit(0).cast("long"), lambda s, x: s + x)
        return (pairs.join(classes, "c").join(wanted.select("q", "own", F.col("v").alias("qv")), "q")
                .select("q", "own", "c", "ids", score.alias("score")))

    wave1 = written(exact(first_wave))
    limit = wave1.groupBy("q").agg(F.when(F.count("*") > k, F.min("score")).alias("limit"))
    rest = (found.join(limit, "q").filter("limit is null or near + error >= limit")
            .join(wave1.select("q", "c"), ["q", "c"], "left_anti"))
    scored = wave1.unionByName(exact(rest)).select("q", "own", "score", F.explode("ids").alias("one")).filter("one.id <> own")
    top = Window.partitionBy("q").orderBy(F.desc("score"), "one.id")
    lists = (scored.withColumn("n", F.row_number().over(top)).filter(F.col("n") <= k + 1)
             .groupBy("q").agg(F.collect_list(F.struct("score", "one.id", "one.rows")).alias("list")))
    mine = lookup(asked, written(wanted.join(lists, "q")), ["v", "own"], "n", asked.count())
    one = mine.select("row", F.col("id").alias("query_id"), F.explode("list").alias("x")).filter("query_id <> x.id")
    each = one.select("row", "query_id", F.col("x.id").alias("vec_id"), F.col("x.score").alias("score"),
                      F.explode(F.sequence(F.lit(1), F.col("x.rows").cast("int"))))
    final = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return (each.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
