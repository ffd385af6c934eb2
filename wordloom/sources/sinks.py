"""Writers: result logs, per-run result documents, transformed corpora and
lexicon files.  Writes go through Spark's commit protocol, which replaces the
reference's temp-file-and-rename (for one file per document on a file system
see :func:`write_corpus`)."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Mapping, Sequence
from urllib.parse import unquote, urlsplit

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from .folders import read_from

# ---- fixed values: result log header of the reference, in order ----
RESULT_HEADER = [
    "timestamp", "model_id", "adapter_id", "task_type", "n_shot", "decoding_strategy",
    "temperature", "top_p", "top_k", "do_sample", "num_beams", "max_gen_toks",
    "p50_ttft_seconds", "p90_ttft_seconds", "p50_tpot_seconds", "p90_tpot_seconds",
    "p50_tgt_seconds", "p90_tgt_seconds", "p50_e2elatency_seconds", "p90_e2elatency_seconds",
    "p50_decode_tps", "p90_decode_tps", "max_gpu_memory_mb", "p90_gpu_memory_mb",
    "max_gpu_utilization", "p90_gpu_utilization",
]


def flatten_results(df: DataFrame, header: Sequence[str] = RESULT_HEADER) -> DataFrame:
    """``meta`` and ``metrics`` structs flattened into the fixed header;
    absent fields are null, a missing timestamp is now."""
    flat = df.select("meta.*", "metrics.*") if {"meta", "metrics"} <= set(df.columns) else df
    cols = []
    for h in header:
        if h in flat.columns:
            cols.append(F.col(h).cast("string").alias(h))
        elif h == "timestamp":
            cols.append(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias(h))
        else:
            cols.append(F.lit(None).cast("string").alias(h))
    return flat.select(*cols)


def append_results(df: DataFrame, path: str, fmt: str = "csv",
                   header: Sequence[str] = RESULT_HEADER) -> None:
    """Append rows under the fixed header."""
    out = flatten_results(df, header)
    w = out.write.mode("append")
    (w.option("header", True).csv(path) if fmt == "csv" else w.format(fmt).save(path))


def save_result_docs(df: DataFrame, path: str,
                     keys=("model_id", "task", "n_shot", "strategy")) -> None:
    """One JSON document per (model, task, k, strategy), partitioned by those
    keys with a path-safe model key (``/`` to ``_``); the model is part of
    the path (Q20)."""
    out = df.withColumn(keys[0], C.result_key(keys[0]))
    # dynamic: only the partitions that are written now are replaced, the
    # documents of earlier runs stay
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys).json(path))


def write_corpus(df: DataFrame, path: str, file="file", text="text") -> None:
    """Transformed text, one folder per source file; what ``path`` held
    before is replaced.

    In a store this is Spark's partitioned text writer.  On a file system
    (``file:``, shared between driver and executors) Hadoop starts a shell
    for the rights of each file and folder, some 20 ms a document, so there
    the tasks write the same layout themselves, and a task's files get their
    names only when all of them are complete."""
    df = df.select(F.col(file).cast("string").alias(file), text)
    spark = df.sparkSession
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getUri().getScheme() != "file":
        df.write.mode("overwrite").partitionBy(file).text(path)
        return
    if df.schema[text].dataType.simpleString() != "string":
        raise ValueError(f"{text} is {df.schema[text].dataType.simpleString()}, not string")
    folder = root.toUri().getPath().rstrip("/")
    if any(f.startswith("file:") and unquote(urlsplit(f).path).startswith(f"{folder}/") for f in df.inputFiles()) or read_from(df, folder):
        raise ValueError(f"{path} is also read from")
    staging = root.suffix("/_temporary")
    fs.delete(root, True)
    fs.mkdirs(staging)
    staged = staging.toUri().getPath()
    df.foreachPartition(lambda rows: _write_files(rows, folder, staged, file))
    fs.delete(staging, True)
    fs.create(root.suffix("/_SUCCESS")).close()


def partition_folder(name: str, value: str | None) -> str:
    """The folder that Spark gives a partition value."""
    def escaped(x: str) -> str:
        return re.sub(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""", lambda c: f"%{ord(c[0]):02X}", x)
    return f"{escaped(name)}={escaped(value) if value else '__HIVE_DEFAULT_PARTITION__'}"


def _write_files(rows: Iterable, folder: str, staging: str, name: str) -> None:
    """One task's documents: written under a name of this attempt, and put
    in place at the end (an attempt that comes again replaces its files)."""
    task = TaskContext.get()
    own = os.path.join(staging, f"{task.stageId()}-{task.partitionId()}-{task.taskAttemptId()}")
    os.makedirs(own)
    written: dict[str, str] = {}
    for value, text in rows:
        to = partition_folder(name, value)
        with open(written.setdefault(to, os.path.join(own, str(len(written)))), "ab") as out:
            out.write((text or "").encode() + b"\n")
    for to, made in written.items():
        os.makedirs(os.path.join(folder, to), exist_ok=True)
        os.replace(made, os.path.join(folder, to, f"part-{task.partitionId():05d}.txt"))


def match_report(df: DataFrame, patterns: Mapping[str, str], file="file", text="text") -> DataFrame:
    """``(file, report)``: per file, under each pattern's name, its matches
    one per line in text order; sections are two blank lines apart.  Written
    with :func:`write_corpus` it is one report per file."""
    parts = []
    for name, pattern in patterns.items():
        found = F.array_join(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)), "\n")
        parts.append(F.concat(F.lit(f"{name}\n"), F.coalesce(found, F.lit(""))))
    return df.select(F.col(file), F.concat_ws("\n\n\n", *parts).alias("report"))


def write_lexicon(lexicon: DataFrame, path: str, word="word", cat="cat") -> None:
    """Sorted distinct words per category as ``\\w`` / ``\\c`` records.
    Range-partitioned and sorted: the part files, read in name order, are
    the sorted lexicon (no single writer task)."""
    recs = (lexicon.select(word, cat).distinct()
                   .repartitionByRange(cat, word).sortWithinPartitions(cat, word)
                   .select(F.concat(F.lit("\\w "), F.col(word), F.lit("\n\\c "), F.col(cat),
                                    F.lit("\n")).alias("value")))
    recs.write.mode("overwrite").text(path)
