"""One file per document, written by the tasks themselves (finding F4)."""

import os

import pytest
from pyspark.sql import functions as F

from wordloom.sources import files as SRC
from wordloom.sources import sinks as SNK


def test_layout_is_that_of_the_partitioned_writer(spark, tmp_path):
    names = ["a.txt", "x/y", "a:b=c%", "q?*'\"#", "[z]{^}\\", "é\x7f\x01", "", None, "a.txt", "b c"]
    rows = [(n, None if i == 2 else f"text {i}\nü") for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, "file string, text string").coalesce(1)
    own, plain = str(tmp_path / "own"), str(tmp_path / "plain")
    df.write.partitionBy("file").text(plain)
    os.makedirs(f"{own}/file=old")  # what was there before is replaced
    SNK.write_corpus(df, own)

    def held(root):
        return {d: sorted(b for f in os.listdir(f"{root}/{d}") if not f.startswith(".") for b in open(f"{root}/{d}/{f}", "rb").read().split(b"\n"))
                for d in os.listdir(root) if d.startswith("file=")}
    assert held(own) == held(plain) and len(held(own)) == 8
    assert not [f for _, _, fs in os.walk(own) for f in fs if f.endswith(".crc") and "_SUCCESS" not in f]  # no second file, no shell per document
    assert "_temporary" not in os.listdir(own) and "_SUCCESS" in os.listdir(own)
    key = F.regexp_extract("path", "file=([^/]+)", 1).alias("key")
    assert sorted(SRC.read_corpus(spark, own).select(key, "text").collect()) == sorted(SRC.read_corpus(spark, plain).select(key, "text").collect())
    with pytest.raises(ValueError):
        SNK.write_corpus(SRC.read_corpus(spark, own).select("file", "text"), own)
    with pytest.raises(ValueError):
        SNK.write_corpus(spark.range(1).select(F.lit("f").alias("file"), F.lit(1).alias("text")), own)
    assert held(own) == held(plain)


def test_many_small_files_are_few_tasks(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    n = 40 * cores
    SNK.write_corpus(spark.range(n).select(F.col("id").alias("file"), F.lit("word").alias("text")), str(tmp_path / "c"))
    back = SRC.read_corpus(spark, str(tmp_path / "c"))
    assert back.rdd.getNumPartitions() <= 4 * cores
    assert back.count() == n and {r.text for r in back.select("text").distinct().collect()} == {"word\n"}
