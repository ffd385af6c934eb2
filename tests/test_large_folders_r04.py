"""Folders of many files are listed and read by tasks (finding F2)."""

import bz2
import gzip

import pytest
from pyspark.sql import Observation

from wordloom.sources import files as SRC
from wordloom.sources import folders
from wordloom.sources import sinks as SNK

NAMES = ["a.txt", "x/y", "a:b=c%", "q?*'\"#", "[z]{^}\\", "é\x7f\x01", "b c\u00a0", "d+e&f;g,@$~!()|<>`", "\U0001F600"]


def both(spark, monkeypatch, path, glob=None):
    """Rows by Spark's reader, and by tasks without a listing in the driver."""
    rows = []
    for listed in (10**9, 0):
        monkeypatch.setattr(SRC, "LISTED", listed)
        seen = Observation()
        df = SRC.read_corpus(spark, path, glob, observation=seen)
        rows.append((sorted(map(tuple, df.collect())), seen.get["files"]))
    assert not df.inputFiles()
    return rows


def test_same_rows_as_sparks_reader(spark, monkeypatch, tmp_path):
    path = str(tmp_path / "c")
    SNK.write_corpus(spark.createDataFrame([(n, f"text {i}\nü") for i, n in enumerate(NAMES)], "file string, text string"), path)
    odd = tmp_path / "c" / "file=a.txt"
    for name, data in [("é u%20.txt", b"more"), ("bad.txt", b"\xff\xfe no text"), ("empty.txt", b""), ("_hidden.txt", b"x"), (".dot.txt", b"x"),
                       ("z.txt.gz", gzip.compress(b"packed")), ("z.txt.bz2", bz2.compress(b"packed too"))]:
        (odd / name).write_bytes(data)
    spark_rows, task_rows = both(spark, monkeypatch, path)
    assert spark_rows == task_rows and len(task_rows[0]) == len(NAMES) + 4
    spark_rows, task_rows = both(spark, monkeypatch, path, "*.txt")
    assert spark_rows == task_rows and len(task_rows[0]) == len(NAMES) + 2
    with pytest.raises(ValueError):  # what is read is not replaced
        SNK.write_corpus(SRC.read_corpus(spark, path).select("file", "text"), path)


def test_files_without_folders(spark, monkeypatch, tmp_path):
    for i in range(5):
        (tmp_path / f"f{i}.txt").write_text(f"text {i}")
    spark_rows, task_rows = both(spark, monkeypatch, f"file:{tmp_path}")
    assert spark_rows == task_rows and len(task_rows[0]) == 5


def test_other_layouts_are_left_to_spark(spark, tmp_path):
    (tmp_path / "file=1").mkdir()
    (tmp_path / "file=1" / "a.txt").write_text("a")
    assert folders.large(spark, str(tmp_path), None, 0) == 1
    assert folders.large(spark, str(tmp_path), None, 1) is None
    assert folders.large(spark, str(tmp_path), "{a,b}.txt", 0) is None
    (tmp_path / "plain.txt").write_text("b")
    assert folders.large(spark, str(tmp_path), None, 0) is None
    assert folders.large(spark, str(tmp_path / "missing"), None, 0) is None
    assert folders.on_file_system(spark, "viewfs://store/x") is None
