"""Readers for the reference's file conventions: one document per file,
line corpora, tab-separated gold pairs, sectioned analogy files, grammar and
lexicon files, and stored result logs."""

from __future__ import annotations

import math
import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import ordering
from ..operators.counts import counted
from ..session import broadcast_checked, cut_lineage, path_missing
from . import folders


#: Bytes of small files that one task reads, files and folders that the driver lists, and how many of more one task reads.
READ_BYTES, LISTED, READ_ENTRIES = 16 << 20, 20_000, 4_000


def read_corpus(spark: SparkSession, path: str, glob: str | None = None, observation=None) -> DataFrame:
    """One row per file: ``(path, file, text)`` with the whole text.  A
    missing folder is an empty corpus and a warning; any other failure is an
    error.  An ``observation`` counts ``files`` (empty ones are no rows).

    Spark plans a task for a few small files (each counts as 4 MB); as many
    of them are read by one task as hold ``READ_BYTES``, so that a corpus of
    many documents is not more tasks than its size needs.  Its driver holds
    several objects a file, so on a file system (``file:``) a folder of more
    than ``LISTED`` files, or of folders ``name=value`` with files, is listed
    and read by tasks."""
    folder = folders.on_file_system(spark, path)
    if folder and (entries := folders.large(spark, folder, glob, LISTED)):
        tasks = max(4 * spark.sparkContext.defaultParallelism, math.ceil(entries / READ_ENTRIES))
        return counted(folders.texts(spark, folder, glob, tasks), observation, files=None)
    try:
        # the keyword matters: text() has its own wholetext=False default
        df = spark.read.text(path, wholetext=True, pathGlobFilter=glob)
    except AnalysisException as e:
        if not path_missing(e):
            raise
        warnings.warn(f"no files read from {path}: {e}")
        return counted(spark.createDataFrame([], "path string, file string, text string"), observation, files=None)
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    df = df.select("value", "_metadata").coalesce(max(4 * spark.sparkContext.defaultParallelism, math.ceil(size / READ_BYTES)))
    found = df.select(F.col("_metadata.file_path").alias("path"),
                      F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))
    return counted(found, observation, files=None)


def read_lines(spark: SparkSession, path: str, skip_header: bool = False) -> DataFrame:
    """One row per line, ``(path, line_no, text)``, with a stable 0-based
    ``line_no`` within each file.  Lines end with ``\\n`` or ``\\r\\n``.

    Files are read in splits, however large: a row's place in its split comes
    from the row ids of its task, the lines before the split from the line
    counts of the file's earlier splits (one row per split)."""
    raw = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_row"), F.regexp_replace("value", r"\r$", "").alias("text"))
    raw = cut_lineage(raw)  # the row ids must not change between the two uses
    splits = raw.groupBy("path", "_split").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("path").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("path", "_split", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    lines = (raw.join(broadcast_checked(cut_lineage(splits)), ["path", "_split"])
                .select("path", (F.col("_row") + F.col("_shift")).alias("line_no"), "text"))
    if skip_header:
        lines = lines.filter(F.col("line_no") > 0).withColumn("line_no", F.col("line_no") - 1)
    return lines


PAIR_SCHEMA = "w1 string, w2 string, score double"


def read_word_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated gold similarity pairs; ``#`` lines are comments."""
    return spark.read.csv(path, sep="\t", comment="#", schema=PAIR_SCHEMA)


#: Lines of a file that one window looks at together.
CHUNK = 100_000


def carry_down(lines: DataFrame, value: str, out: str) -> DataFrame:
    """``out``: the last non-null ``value`` at or before each line of its
    file.  Windows see chunks of a file, and one row per chunk carries over."""
    x = lines.withColumn("_chunk", F.floor(F.col("line_no") / CHUNK))
    inside = Window.partitionBy("path", "_chunk").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    ends = x.groupBy("path", "_chunk").agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col("line_no"))).alias("_end"))
    earlier = Window.partitionBy("path").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("path", "_chunk", F.last("_end", ignorenulls=True).over(earlier).alias("_before"))
    return (x.withColumn("_own", F.last(value, ignorenulls=True).over(inside))
             .join(ends, ["path", "_chunk"])
             .withColumn(out, F.coalesce("_own", "_before")).drop("_chunk", "_own", "_before"))


def read_analogies(spark: SparkSession, path: str) -> DataFrame:
    """``: section`` headers followed by four-word lines; the header is
    carried down to its questions.  ``(qid, section, a, b, c, d)``; ``qid``
    numbers the questions over all files, in path and line order."""
    lines = read_lines(spark, path)
    hdr = F.when(F.col("text").startswith(":"), F.trim(F.expr("substring(text, 2)")))
    x = carry_down(lines.withColumn("_hdr", hdr), "_hdr", "section")
    q = x.filter(~F.col("text").startswith(":") & (F.trim("text") != ""))
    parts = F.split(F.trim("text"), r"\s+")
    return ordering.dense_index(q, ["path", "line_no"], "qid").select(
        "qid", "section", *[F.get(parts, i).alias(c) for i, c in enumerate("abcd")])


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """``\\w word`` / ``\\c category`` record pairs into ``(word, cat)``;
    ``;`` comment lines skipped.  A category belongs to the word record just
    before it; records are numbered over all files without a one-task
    window, then joined with their successor."""
    lines = read_lines(spark, path).filter(~F.trim("text").startswith(";"))
    rec = lines.select("path", "line_no",
                       F.regexp_extract("text", r"^\\([wc])\s+(.*)$", 1).alias("kind"),
                       F.trim(F.regexp_extract("text", r"^\\([wc])\s+(.*)$", 2)).alias("val"))
    rec = cut_lineage(ordering.dense_index(rec.filter(F.col("kind") != ""), ["path", "line_no"], "no"))
    words = rec.filter(F.col("kind") == "w").select("path", (F.col("no") + 1).alias("no"), F.col("val").alias("word"))
    cats = rec.filter(F.col("kind") == "c").select("path", "no", F.col("val").alias("cat"))
    return words.join(cats, ["path", "no"]).select("word", "cat")


def read_grammar(spark: SparkSession, path: str) -> DataFrame:
    """``A -> B C`` rule lines into ``(lhs, rhs array)``; ``Rule`` markers
    and ``;`` comments skipped."""
    lines = read_lines(spark, path)
    body = F.trim(F.regexp_replace("text", ";.*$", ""))
    r = lines.select(body.alias("t")).filter(F.col("t").contains("->"))
    return r.select(F.trim(F.split("t", "->")[0]).alias("lhs"),
                    F.split(F.trim(F.split("t", "->")[1]), r"\s+").alias("rhs"))


def read_results(spark: SparkSession, path: str, schema: str | None = None,
                 keys=("model_id", "adapter_id", "task_type", "n_shot", "decoding_strategy")) -> DataFrame:
    """Stored result log (CSV with header) with blank-trimmed string keys; a
    missing file is an empty table, any other failure an error."""
    r = spark.read.option("header", True)
    try:
        df = r.schema(schema).csv(path) if schema else r.csv(path)
    except AnalysisException as e:
        if not path_missing(e):
            raise
        return spark.createDataFrame([], ", ".join(f"{k} string" for k in keys))
    for k in keys:
        if k in df.columns:
            df = df.withColumn(k, F.trim(F.col(k).cast("string")))
    return df


def valid_results(docs: DataFrame, keys, json="json") -> DataFrame:
    """A result document is valid only if it parses as a JSON object and
    holds one of the metric keys; ``metrics`` is the parsed map."""
    m = F.from_json(F.col(json), T.MapType(T.StringType(), T.StringType()))
    return (docs.withColumn("metrics", m)
                .withColumn("valid", F.coalesce(
                    F.arrays_overlap(F.map_keys("metrics"), F.array(*[F.lit(k) for k in keys])),
                    F.lit(False))))
