"""A folder of rows with unique keys, appended to batch by batch.

Beside the data files lies a key index: per data file a Bloom filter of its
keys (16 bits a key, four probes).  A batch reads the keys of those files only
whose filter may hold one of its own; all others are never opened.  Files
without an index row (left by a failure between data and index) are indexed
before the next batch, so the index can't miss a stored key.  When many small
files have gathered they are merged into few.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys of a batch that are sent to the index's tasks; a larger batch reads all files.
MAX_PROBES = 1_000_000
PROBES = 4


def _plain(path: str) -> str:
    return re.sub(r"^([a-zA-Z][\w+.-]*):/+", r"\1:/", path)


def _positions(hashes, bits: int):
    """The places of keys in a filter of ``bits`` (a power of two): an array
    of PROBES rows."""
    import numpy as np

    h = hashes.view(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([(h + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(PROBES)])


class KeyedFolder:
    """``path`` holds rows of unique ``keys`` (null is a value like others),
    stored as ``fmt``, partitioned by ``partition`` if given."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], fmt: str = "parquet",
                 partition: str | None = None, rows_per_file: int = 1_000_000, merge_files: int = 64):
        self.spark, self.path, self.keys, self.fmt = spark, path.rstrip("/"), list(keys), fmt
        self.partition, self.rows_per_file, self.merge_files = partition, rows_per_file, merge_files
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # ------------------------------------------------------------ folders
    def _list(self, folder: str, deep: bool = False) -> list[str]:
        at = self._Path(folder)
        if not self._fs.exists(at):
            return []
        if not deep:
            return [str(s.getPath().toString()) for s in self._fs.listStatus(at)]
        out, walk = [], self._fs.listFiles(at, True)
        while walk.hasNext():
            out.append(walk.next().getPath().toString())
        return out

    def files(self) -> list[str]:
        """Data files: nothing under a name that starts with ``_`` or ``.``."""
        root = len(self._fs.makeQualified(self._Path(self.path)).toString())
        return [_plain(f) for f in self._list(self.path, deep=True)
                if not re.search(r"/[_.]", f[root:]) and not f.endswith(".crc")]

    def _index_dir(self) -> str:
        """The newest complete version of the index."""
        done = [int(d.rsplit("/", 1)[1]) for d in self._list(f"{self.path}/_keys")
                if self._fs.exists(self._Path(f"{d}/_SUCCESS"))]
        return f"{self.path}/_keys/{max(done, default=0)}"

    def index(self) -> DataFrame:
        """``(file, n, words)``; empty before the first batch."""
        at = self._index_dir()
        schema = "file string, n long, words binary"
        if not self._fs.exists(self._Path(at)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(at)

    def read(self, files: list[str] | None = None) -> DataFrame:
        """The rows of the folder, or of some of its files."""
        return self.spark.read.format(self.fmt).option("basePath", self.path).load(self.path if files is None else files)

    # -------------------------------------------------------------- index
    def _hash(self) -> Column:
        return F.xxhash64(*[F.coalesce(F.col(k).cast("string"), F.lit("\x00null")) for k in self.keys])

    def _filters(self, files: list[str]) -> DataFrame:
        def build(table):
            import numpy as np
            import pyarrow as pa

            hashes = table.column("h").to_numpy()
            bits = max(1024, 1 << (16 * len(hashes) - 1).bit_length())
            words = np.zeros(bits // 64, np.uint64)
            for at in _positions(hashes, bits):
                np.bitwise_or.at(words, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
            return pa.table({"file": [table.column("file")[0].as_py()], "n": [len(hashes)], "words": [words.tobytes()]})

        held = self.read(files).select(F.regexp_replace("_metadata.file_path", r"^([a-zA-Z][\w+.-]*):/+", "$1:/").alias("file"),
                                       self._hash().alias("h"))
        return held.groupBy("file").applyInArrow(build, "file string, n long, words binary")

    def heal(self) -> None:
        """Finish a merge that was cut off, and index files that are not yet."""
        for d in self._list(self.path):
            if "/_merge-" in d:
                self._finish(d)
        known = {r.file for r in self.index().select("file").collect()}
        new = [f for f in self.files() if f not in known]
        if new:
            self._filters(new).write.mode("append").parquet(self._index_dir())

    def candidates(self, batch: DataFrame) -> list[str]:
        """The files that may hold a key of the batch."""
        now = set(self.files())
        probes = batch.select(self._hash().alias("h")).limit(MAX_PROBES + 1).toArrow().column("h").to_numpy()
        if len(probes) > MAX_PROBES:
            return sorted(now)
        sent = self.spark.sparkContext.broadcast(probes)

        def check(batches):
            import numpy as np
            import pyarrow as pa

            for part in batches:
                hit = []
                for file, raw in zip(part.column("file").to_pylist(), part.column("words").to_pylist()):
                    words = np.frombuffer(raw, np.uint64)
                    held = np.ones(len(sent.value), bool)
                    for at in _positions(sent.value, 64 * len(words)):
                        held &= (words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
                    if held.any():
                        hit.append(file)
                yield pa.RecordBatch.from_arrays([pa.array(hit, pa.string())], names=["file"])

        return sorted({r.file for r in self.index().select("file", "words").mapInArrow(check, "file string").collect()} & now)

    # ------------------------------------------------------------- append
    def append(self, batch: DataFrame) -> int:
        """Store the rows of the batch whose key is not there yet; of rows of
        one key the smallest.  Returns the number of rows stored."""
        self.heal()
        rest = [c for c in batch.columns if c not in self.keys]
        if rest:
            one = batch.groupBy(*self.keys).agg(F.min(F.struct(*rest)).alias("_rest")).select(*self.keys, "_rest.*")
        else:
            one = batch.distinct()
        one = one.select(*batch.columns).persist()
        try:
            files = self.candidates(one)
            out = one
            if files:
                stored = self.read(files).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)])
                same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(self.keys)))
                out = one.join(stored, same, "left_anti")
            out = out.persist()
            n = out.count()
            if n:
                self._write(out, n, self.path, "append")
                self.heal()
            out.unpersist()
        finally:
            one.unpersist()
        small = self.index().filter(F.col("n") < self.rows_per_file // 2).select("file", "n").collect()
        small = [(r.file, r.n) for r in small if r.file in set(self.files())]
        if len(small) >= self.merge_files:
            self.merge([f for f, _ in small], sum(n for _, n in small))
        return n

    def _write(self, df: DataFrame, n: int, path: str, mode: str) -> None:
        w = df.coalesce(max(1, -(-n // self.rows_per_file))).write.mode(mode).format(self.fmt)
        (w.partitionBy(self.partition) if self.partition is not None else w).save(path)

    # -------------------------------------------------------------- merge
    def merge(self, files: list[str], n: int) -> None:
        """Write the rows of these files as few files.  The list of the old
        files is stored with the new ones before any of them goes, so a merge
        that is cut off is finished by the next batch."""
        work = f"{self.path}/_merge-{uuid.uuid4().hex}"
        self._write(self.read(files), n, f"{work}/rows", "overwrite")
        self.spark.createDataFrame([(f,) for f in files], "file string").coalesce(1).write.parquet(f"{work}/old")
        self._finish(work)
        self.heal()
        now = set(self.files())
        kept = self.index().filter(F.col("file").isin(sorted(now))).dropDuplicates(["file"])
        at = self._index_dir()
        kept.coalesce(1).write.parquet(f"{self.path}/_keys/{int(at.rsplit('/', 1)[1]) + 1}")
        self._fs.delete(self._Path(at), True)

    def _finish(self, work: str) -> None:
        if self._fs.exists(self._Path(f"{work}/old/_SUCCESS")):
            rows = self._fs.makeQualified(self._Path(f"{work}/rows")).toString()
            for f in self.spark.read.parquet(f"{work}/old").collect():
                self._fs.delete(self._Path(f.file), False)
            for f in self._list(f"{work}/rows", deep=True):
                part = f[len(rows):]
                if not re.search(r"/[_.]", part) and not f.endswith(".crc"):
                    to = self._Path(self.path + part)
                    self._fs.mkdirs(to.getParent())
                    self._fs.rename(self._Path(f), to)
        self._fs.delete(self._Path(work), True)
