"""Helpers shared by the training-data operators.

Words are maximal runs of characters other than the six ASCII white-space
characters, everywhere in this subpackage.  ``bytes.split`` and
``bytes.strip`` without arguments use exactly that set, and ``bytes.lower``
lowers A-Z only, so texts are handled as UTF-8 bytes inside tasks.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from wordloom.session import cut_lineage

WHITE = " \t\n\x0b\f\r"
WORD = "[^\\x20\\x09-\\x0D]+"

#: Bytes of text that one step inside a Python task works on at once.
STEP_BYTES = 1 << 20


#: Bytes of one Arrow batch between the JVM and a Python worker.
BATCH_BYTES = 8 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Lower the session's limit on the bytes of an Arrow batch to
    ``BATCH_BYTES`` (a lower setting stays): with long texts or arrays the
    buffers of a batch, outside the heap, are what a task's memory is made
    of."""
    now = (spark.conf.get(_BATCH_KEY, None) or "").lower().rstrip("b")
    if now.isdigit() and int(now) > BATCH_BYTES:
        spark.conf.set(_BATCH_KEY, str(BATCH_BYTES))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read through Spark only (the path may be a store)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def written(df: DataFrame) -> DataFrame:
    """``df`` as a parquet table in the shared checkpoint folder: computed
    once, safe against lost executors, lineage cut."""
    small_batches(df.sparkSession)
    return cut_lineage(df)


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Hint a broadcast only after counting that ``df`` has at most
    ``max_rows`` rows; a larger side is left to a shuffle join (with AQE's
    skew splitting).  ``df`` should be cheap to scan (a written table)."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], count: str, total: int, share: int = 1000) -> DataFrame:
    """``rows`` with the columns of their row of ``table`` (inner join).

    ``table`` has one row per key, with the number of ``rows`` that hold the
    key as ``count`` (dropped); ``total`` is the sum of these.  Keys with
    more than ``total / share`` rows are fewer than ``share`` by that rule,
    so their part of the table is broadcast; all others meet in a shuffle
    join, where no key has more rows than that.  Both inputs are read twice
    and should be written tables.  Keys are not null."""
    hot = F.broadcast(table.filter(F.col(count) * share > total).drop(count))
    cold = table.filter(F.col(count) * share <= total).drop(count)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return rows.join(hot, keys).unionByName(rest.join(cold, keys))


def text_keys(col, salt: int) -> list:
    """Two 64-bit hashes of a column, different for every ``salt``.  Users
    check that they tell all values apart and take the next salt if not."""
    return [F.xxhash64(F.lit(2 * salt + i), col) for i in (0, 1)]


def pieces(batch: pa.RecordBatch, column: str, step_bytes: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` of at least one row whose texts add up to about
    ``step_bytes``, so that a task's working memory follows the longest
    text and not the batch."""
    import numpy as np
    import pyarrow.compute as pc

    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes) // step_bytes
    starts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(starts, starts[1:]):
        yield batch.slice(a, b - a)


def give_back() -> None:
    """Return freed memory to the system at the end of a task: Spark keeps a
    Python worker for later tasks, and an idle one should be small."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def map_texts(df: DataFrame, text_col: str, fields: list[T.StructField],
              make: Callable[[], Callable[[list], list]], drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with ``fields`` added, computed from one text column.

    ``make()`` runs once per task and returns a function from a list of
    texts (str or None) to one list or array per field.  Columns of ``df``
    named like a new field (any case) are replaced; ``drop`` leaves columns
    out of the result.
    """
    small_batches(df.sparkSession)
    new = {f.name.lower() for f in fields} | {d.lower() for d in drop}
    keep = [f for f in df.schema.fields if f.name.lower() not in new]
    schema = T.StructType([*keep, *fields])
    arrow = to_arrow_schema(schema)
    names = [f.name for f in keep]

    def run(batches):
        step = make()
        for batch in batches:
            for part in pieces(batch, text_col):
                out = step(part.column(text_col).to_pylist())
                cols = [part.column(n) for n in names]
                cols += [c if isinstance(c, pa.Array) else pa.array(c, type=arrow.field(f.name).type)
                         for c, f in zip(out, fields)]
                yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in schema.fields])
        step = out = cols = part = batch = None
        give_back()

    return df.mapInArrow(run, schema)


def list_array(values, lengths, kind) -> pa.Array:
    """A list column from flat values and one length per row."""
    import numpy as np

    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
