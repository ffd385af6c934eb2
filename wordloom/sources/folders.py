"""Folders of very many small files on a file system that driver and
executors share: listed and read by tasks, by the rules of Spark's readers."""

from __future__ import annotations

import bz2
import gzip
import os
import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from fnmatch import fnmatchcase
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names, and bytes of text, that a task hands over at once.
NAMES, TEXT_BYTES = 10_000, 4 << 20
#: Endings that Hadoop reads through a codec; only some are known here.
CODECS = {".gz": gzip.decompress, ".bz2": bz2.decompress, ".deflate": zlib.decompress}
OTHER_CODECS = (".snappy", ".lz4", ".zst", ".zstd")


def on_file_system(spark: SparkSession, path: str) -> str | None:
    """The folder that ``path`` names if it is one of ``file:``."""
    sc = spark.sparkContext
    if re.match(r"(?!file:)[A-Za-z][A-Za-z0-9+.-]*:", path):
        return None
    root = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(sc._jsc.hadoopConfiguration())
    return fs.makeQualified(root).toUri().getPath().rstrip("/") if fs.getUri().getScheme() == "file" else None


def _hidden(name: str) -> bool:
    return name.startswith("_") and "=" not in name or name.startswith(".") or name.endswith("._COPYING_")


def large(spark: SparkSession, folder: str, glob: str | None, most: int) -> int | None:
    """The number of its entries, if these are more than ``most`` and either
    files alone or folders ``name=value`` of one name alone; of any other
    folder, codec or pattern Spark's own reader is left to tell the rows."""
    if glob and re.search(r"[^\w.*?=-]", glob):
        return None

    def looked_at(_: Iterable) -> Iterator[tuple]:
        n, kinds = 0, set()
        if os.path.isdir(folder):
            with os.scandir(folder) as found:
                for e in found:
                    if _hidden(e.name):
                        continue
                    n += 1
                    if len(kinds) < 2:
                        odd = e.name.endswith(OTHER_CODECS)
                        kinds.add("file" if not e.is_dir() and not odd else f"={e.name.split('=')[0]}" if "=" in e.name and not odd else "other")
        yield n, kinds

    n, kinds = spark.sparkContext.parallelize([0], 1).mapPartitions(looked_at).first()
    return n if n > most and len(kinds) == 1 and kinds != {"other"} else None


def texts(spark: SparkSession, folder: str, glob: str | None, tasks: int) -> DataFrame:
    """``(path, file, text)`` of the files in ``folder`` or in its folders
    ``name=value``; one task lists, names travel, ``tasks`` read."""
    # the folder is a literal, so that a plan shows what it reads
    root = spark.range(0, 1, 1, 1).select(F.lit(f"{folder}/").alias(READ_FROM))
    names = root.mapInArrow(lambda batches: _names(batches), "name string").repartition(tasks, "name")
    read = names.mapInArrow(lambda batches: _read(batches, folder, glob), "path string, file string, text binary")
    return read.select("path", "file", F.col("text").cast("string").alias("text"))


#: The column that names the folder.
READ_FROM = "corpus_folder"


def read_from(df: DataFrame, folder: str) -> bool:
    """Whether the plan of ``df`` reads ``folder`` through :func:`texts`."""
    return f"{folder}/ AS {READ_FROM}" in df._jdf.queryExecution().analyzed().toString()


def _names(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            held = []
            with os.scandir(folder) as found:
                for e in found:
                    if not _hidden(e.name):
                        held.append(e.name)
                    if len(held) >= NAMES:
                        yield pa.record_batch([pa.array(held, pa.string())], ["name"])
                        held = []
            if held:
                yield pa.record_batch([pa.array(held, pa.string())], ["name"])


def _files(at: str, name: str) -> Iterator[tuple[str, str]]:
    if not os.path.isdir(at):
        yield at, name
        return
    with os.scandir(at) as found:
        for e in found:
            if not _hidden(e.name):
                if e.is_dir():
                    raise ValueError(f"{e.path}: folders of one level are read")
                yield e.path, e.name


def _read(batches: Iterable[pa.RecordBatch], folder: str, glob: str | None) -> Iterator[pa.RecordBatch]:
    rows, held = ([], [], []), 0

    def full() -> pa.RecordBatch:
        return pa.record_batch([pa.array(rows[0], pa.string()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.binary())], ["path", "file", "text"])

    for batch in batches:
        for entry in batch.column(0).to_pylist():
            for path, name in _files(f"{folder}/{entry}", entry):
                if glob and not fnmatchcase(name, glob):
                    continue
                if name.endswith(OTHER_CODECS):
                    raise ValueError(f"{path}: no reader for this codec")
                with open(path, "rb") as f:
                    text = f.read()
                if not text:  # an empty file is no row
                    continue
                if unpack := CODECS.get(os.path.splitext(name)[1]):
                    text = unpack(text)
                for column, value in zip(rows, (f"file:{shown(path)}", shown(name), text)):
                    column.append(value)
                held += len(text)
                if held >= TEXT_BYTES or len(rows[0]) >= NAMES:
                    yield full()
                    rows, held = ([], [], []), 0
    if rows[0]:
        yield full()


def shown(path: str) -> str:
    """A path or name as Spark's file metadata has it: other characters than
    a URI's path may hold, and blanks and controls of any script, as %XX."""
    return re.sub(r"[^A-Za-z0-9_\-!.~'()*,;:$&+=@/]", lambda c: _escaped(c[0]), path)


def _escaped(c: str) -> str:
    return c if ord(c) > 127 and unicodedata.category(c) not in ("Zs", "Zl", "Zp", "Cc") else quote(c, safe="")
