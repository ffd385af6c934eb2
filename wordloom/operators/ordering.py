"""Global order without a single-task window.

``row_number()`` with no partition key runs in one task.  These helpers
range-partition by the sort key, number rows inside each partition, and add
each partition's offset from a table with one row per partition (bounded by
the partition count, so broadcasting it is safe).  The partition tags are
checkpointed into the shared checkpoint folder so both uses see the same tags.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_checked, cut_lineage


def _tagged(df: DataFrame, order_cols: Sequence) -> DataFrame:
    return cut_lineage(df.orderBy(*order_cols).withColumn("_pid", F.spark_partition_id()))


def _offsets(tagged: DataFrame, weight: str | None) -> DataFrame:
    amount = F.sum(weight) if weight else F.count("*")
    per_part = tagged.groupBy("_pid").agg(amount.cast("long").alias("_w"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select("_pid", F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_off"))


def dense_index(df: DataFrame, order_cols: Sequence, out: str = "idx") -> DataFrame:
    """0-based dense position of each row in the total order ``order_cols``."""
    tagged = _tagged(df, order_cols)
    offs = _offsets(tagged, None)
    local = Window.partitionBy("_pid").orderBy(*order_cols)
    return (tagged.join(F.broadcast(offs), "_pid")
                  .withColumn(out, (F.col("_off") + F.row_number().over(local) - 1).cast("long"))
                  .drop("_pid", "_off"))


def exclusive_prefix_sum(df: DataFrame, order_cols: Sequence, weight: str,
                         out: str = "before") -> DataFrame:
    """Sum of ``weight`` over all rows strictly before each row."""
    tagged = _tagged(df, order_cols)
    offs = _offsets(tagged, weight)
    local = (Window.partitionBy("_pid").orderBy(*order_cols)
             .rowsBetween(Window.unboundedPreceding, -1))
    return (tagged.join(F.broadcast(offs), "_pid")
                  .withColumn(out, (F.col("_off") + F.coalesce(F.sum(weight).over(local), F.lit(0)))
                              .cast("long"))
                  .drop("_pid", "_off"))


def average_rank(df: DataFrame, value: str, out: str) -> DataFrame:
    """Adds the 1-based average rank of ``value`` (ties share the mean rank),
    as used by Spearman's coefficient.  Distinct values are ranked, then
    joined back on the value (broadcast if they are few, so that a value that
    many rows share never deals them)."""
    counts = df.groupBy(value).agg(F.count("*").alias("_c"))
    ranked = exclusive_prefix_sum(counts, [value], "_c", "_b")
    ranks = ranked.select(value, (F.col("_b") + (F.col("_c") + 1) / 2.0).alias(out))
    return df.join(broadcast_checked(cut_lineage(ranks)), value, "left")


def group_quantiles(df: DataFrame, by: Sequence[str], columns: dict, probs: Sequence[float],
                    extra: dict | None = None, accuracy: int = 10_000, small: int = 100_000) -> DataFrame:
    """Exact linear percentiles (numpy's default) per group: ``(by...,
    name_prob...)`` with one column ``f"{name}_{prob}"`` per entry of
    ``columns`` (name to column) and probability; nulls are left out.
    ``extra`` (name to aggregate) adds columns from the first pass.

    Where no group has more than ``small`` rows, one aggregate holds their
    values.  Else two passes, no sort of the values.  The first takes a quantile sketch of
    bounded size per group, which gives a bracket of a few thousandths of a
    percent of the group around each percentile.  The second counts the rows
    below a bracket and, per different value, those inside it; the percentile
    is read from these few rows.  The counts show whether a bracket holds its
    percentile; if one does not, all are widened."""
    by, names, probs, extra = list(by), list(columns), [float(p) for p in probs], extra or {}
    group = F.struct(*by) if by else F.lit(0)
    rows = df.select("*", group.alias("_g"), *[c.cast("double").alias(f"_v{i}") for i, c in enumerate(columns.values())])
    if (rows.groupBy("_g").count().agg(F.max("count")).first()[0] or 0) <= small:
        exact = [F.percentile(f"_v{i}", F.lit(p)).alias(f"{n}_{p}") for i, n in enumerate(names) for p in probs]
        out = rows.groupBy(*[F.col(c) for c in by]).agg(*exact, *[v.alias(k) for k, v in extra.items()])
        return out.select(*by, *extra, *[F.col(f"`{n}_{p}`") for n in names for p in probs])
    # brackets of several widths come with the sketch; a group takes the
    # narrowest that its size and the sketch's error allow
    widths = [2.0 / accuracy]
    while widths[-1] < 1:
        widths.append(min(1.0, widths[-1] * 8))
    at = [min(1.0, max(0.0, p + d * w)) for p in probs for d in (-1, 1) for w in widths]
    skip = 0
    while True:
        first = rows.groupBy("_g").agg(
            *[F.percentile_approx(f"_v{i}", F.array(*[F.lit(x) for x in at]), accuracy).alias(f"_b{i}") for i in range(len(names))],
            *[F.count(f"_v{i}").alias(f"_n{i}") for i in range(len(names))], *[v.alias(k) for k, v in extra.items()])
        first = cut_lineage(first)
        brackets = F.array(*[F.struct(
            F.lit(i).cast("int").alias("m"), F.lit(j).cast("int").alias("p"), F.col(f"_v{i}").alias("v"),
            F.get(f"_b{i}", F.col(f"_w{i}") + 2 * j * len(widths)).alias("lo"),
            F.get(f"_b{i}", F.col(f"_w{i}") + (2 * j + 1) * len(widths)).alias("hi")) for i in range(len(names)) for j in range(len(probs))])
        width = lambda n: F.least(F.lit(len(widths) - 1), F.lit(skip) + sum(
            (F.try_divide(F.lit(1.0), n) + 1.0 / accuracy > w).cast("int") for w in widths[:-1]))
        near = rows.join(broadcast_checked(first.select("_g", *[f"_b{i}" for i in range(len(names))], *[
            F.coalesce(width(F.col(f"_n{i}")), F.lit(0)).alias(f"_w{i}") for i in range(len(names))])), "_g")
        near = near.select("_g", F.explode(F.filter(brackets, lambda b: b["v"] <= b["hi"])).alias("b"))
        counts = near.groupBy("_g", "b.m", "b.p", F.when(F.col("b.v") >= F.col("b.lo"), F.col("b.v")).alias("x")).agg(F.count("*").alias("c"))
        sizes = first.select("_g", F.posexplode(F.array(*[F.col(f"_n{i}") for i in range(len(names))])).alias("m", "n"))
        inside = Window.partitionBy("_g", "m", "p").orderBy(F.asc_nulls_first("x")).rowsBetween(Window.unboundedPreceding, 0)
        placed = counts.withColumn("upto", F.sum("c").over(inside)).join(broadcast_checked(sizes.filter("n > 0")), ["_g", "m"])
        place = F.element_at(F.array(*[F.lit(p) for p in probs]), F.col("p") + 1) * (F.col("n") - 1)
        value = lambda i: F.min(F.when(F.col("upto") > i, F.col("x")))
        known = F.coalesce(F.max(F.when(F.col("x").isNull(), F.col("upto"))), F.lit(0)) <= F.max(F.floor("place"))  # the bracket starts at or before it
        read = placed.withColumn("place", place).groupBy("_g", "m", "p").agg(
            value(F.floor("place")).alias("lo"), value(F.ceil("place")).alias("hi"), F.max(F.col("place") - F.floor("place")).alias("part"),
            known.alias("known"))
        read = cut_lineage(read)
        if read.filter("not known or lo is null or hi is null").limit(1).count() == 0:
            break
        skip += 1
    q = F.when(F.col("part") == 0, F.col("lo")).otherwise(F.col("lo") * (1 - F.col("part")) + F.col("hi") * F.col("part"))
    wide = read.groupBy("_g").agg(*[F.max(F.when((F.col("m") == i) & (F.col("p") == j), q)).alias(f"{n}_{p}")
                                    for i, n in enumerate(names) for j, p in enumerate(probs)])
    out = first.join(broadcast_checked(wide), "_g", "left")
    if not by:  # one row, also of an empty table
        out = df.sparkSession.range(1).select(F.lit(0).alias("_g")).join(F.broadcast(out), "_g", "left")
    return out.select(*[F.col("_g")[c].alias(c) for c in by], *extra, *[F.col(f"`{n}_{p}`") for n in names for p in probs])
