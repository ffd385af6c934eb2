"""Counts from observations and a stream listener against plain counts."""

import time

from pyspark.sql import Observation
from pyspark.sql import functions as F

from wordloom.operators import evaluate as EV
from wordloom.operators import text as T
from wordloom.operators.counts import StreamCounts, counted
from wordloom.sources import files as SRC
from wordloom.streaming import jobs as SJ


def test_files_and_labels(spark, tmp_path):
    """One action gives the result and the counts of two steps before it."""
    for name, text in (("f1.txt", "a"), ("m2.txt", "b"), ("m5.txt", ""), ("x3.txt", "c"), ("m4.txt", "d"), ("y5.log", "e")):
        (tmp_path / name).write_text(text)
    found, labelled = Observation("found"), Observation("labelled")
    docs = SRC.read_corpus(spark, str(tmp_path), "*.txt", observation=found)
    rows = T.label_from_filename(docs, [("^f", "female"), ("^m", "male")], observation=labelled).collect()
    assert sorted(r.label for r in rows) == ["female", "male", "male"]
    assert found.get == {"files": 4} and labelled.get == {"rows": 4, "unmatched": 1}
    none = Observation("none")
    assert SRC.read_corpus(spark, str(tmp_path / "nowhere"), observation=none).collect() == [] and none.get["files"] == 0
    kept = Observation("kept")
    assert T.label_from_filename(docs, [("^f", "female")], keep_unmatched=True, observation=kept).count() == 4
    assert kept.get == {"rows": 4, "unmatched": 3}


def test_rejected_conversations(spark):
    df = spark.createDataFrame([("t", 1), (None, 2), ("u", None), ("v", 3)], "text string, label int")
    seen = Observation("rejects")
    out = EV.to_conversation(df, observation=seen)
    plain = EV.to_conversation(df).filter("reject").count()
    assert len(out.collect()) == 4 and seen.get == {"rows": 4, "rejected": plain} and plain == 2


def test_observed_tables_need_no_job_of_their_own(spark):
    """The counts are there after the action, in the jobs of that action."""
    df = spark.range(100)
    seen = Observation("o")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("observed", "observed")
    assert counted(df, seen, rows=None, odd=F.col("id") % 2 == 1).filter("id < 10").count() == 10
    with_counts = len(tracker.getJobIdsForGroup("observed"))
    assert seen.get == {"rows": 100, "odd": 50} and len(tracker.getJobIdsForGroup("observed")) == with_counts
    spark.sparkContext.setJobGroup("plain", "plain")
    df.filter("id < 10").count()
    assert with_counts == len(tracker.getJobIdsForGroup("plain"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counted(df, None, rows=None) is df


def test_late_rows_of_a_stream(spark, tmp_path):
    rows = [[("2024-01-01 00:00:00", "a", 1.0), ("2024-01-01 05:00:00", "b", 2.0), (None, "a", 5.0)],
            [("2024-01-01 00:10:00", "a", 9.0), ("2024-01-01 06:00:00", "a", 3.0)], [("2024-01-02 00:00:00", "a", 1.0)]]
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    counts = StreamCounts()
    spark.streams.addListener(counts)
    try:
        for batch in rows:
            df = spark.createDataFrame(batch, "ts string, device string, reading double").withColumn("event_time", F.to_timestamp("ts"))
            df.coalesce(1).write.mode("append").parquet(src)
            stream = counted(spark.readStream.schema(df.schema).parquet(src), "input", rows=None, untimed=F.col("event_time").isNull())
            q = (SJ.stream_telemetry(stream, "1 hour", "0 seconds").writeStream.outputMode("append").format("parquet")
                 .option("path", out + "/d").option("checkpointLocation", out + "/c").trigger(availableNow=True).start())
            q.awaitTermination()
        for _ in range(100):
            if counts.totals.get(str(q.id), {}).get("input.rows") == 6:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(counts)
    total = counts.totals[str(q.id)]
    assert total["rows"] == 6 and total["input.rows"] == 6 and total["input.untimed"] == 1
    assert total["late"] >= 1  # the second batch's row of 00:10 came after 05:00
    peaks = {r.peak for r in spark.read.parquet(out + "/d").collect()}
    assert 9.0 not in peaks and {1.0, 2.0, 3.0} >= peaks
