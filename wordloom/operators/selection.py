"""Selection without sorting: the first n rows of a table, in a stable order.

The n-th smallest key is found by histograms: a round counts the rows of at
most ``CELLS`` cells between the lowest and the highest value still possible
and keeps the cell that holds the n-th.  A round reads one column (the order
column; the row hash only for rows whose order ties), returns one row per cell
and moves no rows; the result is one filter of the table.  A key is a list of
numbers, compared one after another: a string's are its bytes, seven at a
time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

#: Cells of one histogram, each one row on the driver.
CELLS = 4096


def nth_smallest(df: DataFrame, x: Column, n: int) -> tuple:
    """(value, rows below it, rows equal to it) of the n-th smallest value
    (from 1) of a column of numbers without null, NaN or infinity."""
    values = df.select(x.alias("x"))
    lo, hi, equal = values.agg(F.min("x"), F.max("x"), F.count("*")).first()
    below = 0
    while lo != hi:
        near = isinstance(lo, int) and hi - lo < 1 << 53
        at = (F.col("x") - F.lit(lo)).cast("double") if near else F.col("x").cast("double") / 2 - F.lit(float(lo) / 2)
        width = (hi - lo if near else float(hi) / 2 - float(lo) / 2) / CELLS
        cell = F.least(F.floor(at / F.lit(float(width))), F.lit(CELLS - 1))
        rows = (values.filter(F.col("x").between(lo, hi)).groupBy(cell.alias("cell"))
                .agg(F.count("*"), F.min("x"), F.max("x")).collect())
        for _, equal, lo, hi in sorted(rows):
            if below + equal >= n:
                break
            below += equal
    return lo, below, equal


def _chunk(data: Column, i: int) -> Column:
    """Seven bytes and how many there are, as one number in byte order."""
    part = data.substr(F.lit(7 * i + 1), F.lit(7))
    return F.conv(F.rpad(F.hex(part), 14, "0"), 16, 10).cast("long") * 8 + F.octet_length(part)


def _numbers(kind: T.DataType, c: Column) -> list[Callable[[int], Column | None]]:
    """The numbers of a key; each entry gives its i-th number."""
    one = lambda x: (lambda i: x if i == 0 else None)
    if isinstance(kind, T.BooleanType):
        return [one(c.cast("int"))]
    if isinstance(kind, T.IntegralType):
        return [one(c)]
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        kept = F.when(F.isnan(c) | (F.abs(c) == float("inf")), 0.0).otherwise(c)
        return [one(F.when(F.isnan(c), 2).when(c == float("inf"), 1).when(c == float("-inf"), -1).otherwise(0)), one(kept)]
    if isinstance(kind, T.DecimalType):
        whole = (c.cast("decimal(38, %d)" % kind.scale) * F.lit(10 ** kind.scale)).cast("decimal(38, 0)")
        high = F.floor(whole / F.lit(10 ** 18)).cast("long")
        return [one(high), one((whole - high.cast("decimal(20, 0)") * F.lit(10 ** 18)).cast("long"))]
    if isinstance(kind, T.DateType):
        return [one(F.unix_date(c))]
    if isinstance(kind, T.TimestampType):
        return [one(F.unix_micros(c))]
    if isinstance(kind, T.TimestampNTZType):
        return [one(F.unix_date(c.cast("date"))), one(F.date_format(c, "HHmmssSSSSSS").cast("long"))]
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return [lambda i: _chunk(c.cast("binary"), i)]
    raise TypeError(f"rows can't be ordered by a column of type {kind.simpleString()}")


def _key(df: DataFrame, order: str, nulls: bool) -> Iterator[Callable[[int], Column | None]]:
    kind, c = df.schema[order].dataType, F.col(f"`{order}`")
    if nulls:  # first, as in a sort
        yield lambda i: c.isNotNull().cast("int") if i == 0 else None
    for number in _numbers(kind, c):
        yield (lambda i, f=number: None if f(i) is None else F.coalesce(f(i), F.lit(0))) if nulls else number
    row = F.xxhash64(*[F.col(f"`{x}`") for x in df.columns])
    yield lambda i: row if i == 0 else None


def mark_first(df: DataFrame, n: int, order: str, flag: str) -> DataFrame:
    """``df`` with a boolean ``flag``: whether the row is among the first
    ``n`` by ``order`` (nulls first), ties by a hash of the whole row.  Of
    rows that are equal in every column as many are marked as fit."""
    total, present = df.agg(F.count("*"), F.count(F.col(f"`{order}`"))).first()
    if n >= total or n <= 0:
        return df.withColumn(flag, F.lit(n > 0))
    below, at, need = F.lit(False), F.lit(True), n
    for number in _key(df, order, present < total):
        i = 0
        while (x := number(i)) is not None:
            value, less, equal = nth_smallest(df.filter(at), x, need)
            below, at, need = below | (at & (x < value)), at & (x == value), need - less
            if need == equal:
                return df.withColumn(flag, below | at)
            if isinstance(df.schema[order].dataType, (T.StringType, T.BinaryType)) and value % 8 < 7:
                break  # the text ends here
            i += 1
    # the rows left are equal: any of them, by their place in a written table
    tied = cut_lineage(df.filter(at).withColumn("__place", F.monotonically_increasing_id()))
    last = nth_smallest(tied, F.col("__place"), need)[0]
    return (df.filter(~at).withColumn(flag, below)
            .unionByName(tied.withColumn(flag, F.col("__place") <= last).drop("__place")))


def first_rows(df: DataFrame, n: int, order: str) -> DataFrame:
    """The first ``n`` rows by ``order``; see :func:`mark_first`."""
    return mark_first(df, n, order, "__first").filter("__first").drop("__first")
