"""Registered queries: request latency, percentiles and device telemetry on
``events`` (request = (user_id, day); tick = hour; device = event_type;
reading = value; prompt length = props.k of the first event), plus the
streaming jobs run to completion on the same table."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..operators import telemetry as TL
from ..session import checkpoint_dir, table
from ..streaming import jobs as SJ
from .registry import query

_REQ_SQL = """
e AS (SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, ts,
             CAST(props->>'$.k' AS BIGINT) AS k FROM events),
f AS (SELECT user_id, day, min(ts) AS s, max(ts) AS e, count(*) AS n, arg_min(k, ts) AS inp
      FROM e GROUP BY ALL HAVING count(*) >= 2),
sec AS (SELECT e.user_id, e.day, min(e.ts) AS ft FROM e JOIN f USING (user_id, day)
        WHERE e.ts > f.s GROUP BY ALL),
m AS (SELECT f.user_id, f.day, f.n - 1 AS out_tokens, f.inp,
        (epoch_us(f.e) - epoch_us(f.s)) / 1e6 AS total,
        coalesce((epoch_us(sec.ft) - epoch_us(f.s)) / 1e6, 0.001) AS ttft,
        coalesce((epoch_us(f.e) - epoch_us(sec.ft)) / 1e6, 0.0) AS dec0
      FROM f LEFT JOIN sec USING (user_id, day)),
m2 AS (SELECT *, CASE WHEN dec0 <= 0 THEN 0.001 ELSE dec0 END AS decode FROM m),
req AS (SELECT user_id, day, total AS total_generation_time, ttft AS time_to_first_token_seconds,
  decode AS token_generation_time,
  CASE WHEN out_tokens / decode > 0 THEN 1.0 / (out_tokens / decode) ELSE 0.0 END AS time_per_output_token,
  CAST(inp AS BIGINT) AS input_tokens, CAST(out_tokens AS BIGINT) AS output_tokens,
  CAST(inp + out_tokens AS BIGINT) AS total_tokens,
  CASE WHEN total > 0 THEN (inp + out_tokens) / total ELSE 0.0 END AS tokens_per_second,
  out_tokens / decode AS output_decode_tokens_per_second, ttft + total AS e2e_latency,
  total AS total_latency FROM m2)"""


def _events(spark, sf):
    return table(spark, sf, "events")


def requests(spark, sf):
    ev = _events(spark, sf).withColumn("day", F.to_date("ts").cast("string"))
    r = TL.request_latency(ev, ["user_id", "day"],
                           input_tokens=F.get_json_object("props", "$.k").cast("long"))
    return r.drop("start_ts")


@query("request_latency", f"WITH {_REQ_SQL} SELECT * FROM req")
def q_request_latency(spark, sf):
    return requests(spark, sf)


_PCT = ", ".join(
    f"quantile_cont({c}, 0.5) AS p50_{s}{'' if s == 'decode_tps' else '_seconds'}, "
    f"quantile_cont({c}, 0.9) AS p90_{s}{'' if s == 'decode_tps' else '_seconds'}"
    for s, c in TL.LATENCY_METRICS.items())


@query("latency_percentiles", f"WITH {_REQ_SQL} SELECT day, {_PCT} FROM req GROUP BY day")
def q_latency_percentiles(spark, sf):
    return TL.latency_percentiles(requests(spark, sf), ["day"], decimals=None)


@query("telemetry_summary", """
WITH s AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, date_trunc('hour', ts) AS tick, value
           FROM events WHERE event_type IN ('click', 'view')),
t AS (SELECT day, tick, max(value) AS m FROM s GROUP BY ALL)
SELECT day, coalesce(max(m), 0.0) AS peak, coalesce(quantile_cont(m, 0.9), 0.0) AS p90,
       count(*) AS n_ticks FROM t GROUP BY day""")
def q_telemetry_summary(spark, sf):
    ev = _events(spark, sf)
    s = ev.select(F.to_date("ts").cast("string").alias("day"),
                  F.date_trunc("hour", "ts").alias("tick"),
                  F.col("event_type").alias("device"), F.col("value").alias("reading"))
    return TL.telemetry_summary(s, ["click", "view"], "tick", ["day"])


# ------------------------------------------------------------------ streams
def _scratch(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _event_stream(spark, sf):
    schema = spark.read.parquet(os.path.join(sf, "events.parquet")).schema
    return SJ.with_event_time(spark.readStream.schema(schema).parquet(
        os.path.join(sf, "events*.parquet")))


def _drain(spark, stream_df, name):
    """Run a streaming query to completion on what is available (append
    mode) and return its output as a table."""
    out = _scratch(spark, name)
    q = (stream_df.writeStream.outputMode("append").format("parquet")
         .option("path", out + "/data").option("checkpointLocation", out + "/ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(stream_df.schema).parquet(out + "/data")


@query("stream_telemetry", """
WITH t AS (SELECT ts, max(value) AS m FROM events WHERE event_type IN ('click', 'view') GROUP BY ts),
w AS (SELECT date_trunc('day', ts) AS d, m FROM t)
SELECT strftime(d, '%Y-%m-%d %H:%M:%S') AS window_start, max(m) AS peak, quantile_disc(m, 0.9) AS p90,
       count(*) AS n_ticks FROM w
WHERE d + INTERVAL 1 DAY <= (SELECT max(ts) FROM events WHERE event_type IN ('click', 'view')) GROUP BY d""")
def q_stream_telemetry(spark, sf):
    """All days that have closed, i.e. all but the last."""
    s = _event_stream(spark, sf).select("event_time", F.col("event_type").alias("device"),
                                        F.col("value").alias("reading"))
    out = _drain(spark, SJ.stream_telemetry(s, "1 day", "0 seconds", ["click", "view"]),
                 "telemetry")
    return out.select(F.col("w.start").cast("string").alias("window_start"), "peak", "p90", "n_ticks")


@query("regroup_telemetry", """
WITH t AS (SELECT ts, max(value) AS m FROM events WHERE event_type IN ('click', 'view') GROUP BY ts),
w AS (SELECT date_trunc('day', ts) AS d, m FROM t)
SELECT strftime(date_trunc('week', d), '%Y-%m-%d') AS week, max(m) AS peak, quantile_disc(m, 0.9) AS p90, count(*) AS n_ticks FROM w
WHERE d + INTERVAL 1 DAY <= (SELECT max(ts) FROM events WHERE event_type IN ('click', 'view')) GROUP BY ALL""")
def q_regroup_telemetry(spark, sf):
    """Weeks from the stored sketches of the days that have closed."""
    s = _event_stream(spark, sf).select("event_time", F.col("event_type").alias("device"), F.col("value").alias("reading"))
    days = _drain(spark, SJ.stream_telemetry(s, "1 day", "0 seconds", ["click", "view"], sketch_k=16384), "sketches")
    weeks = SJ.regroup_telemetry(days.withColumn("week", F.date_format(F.date_trunc("week", "w.start"), "yyyy-MM-dd")), ["week"])
    return weeks.drop("sketch")


@query("stream_request_latency", """
WITH e AS (SELECT user_id, ts, CAST(props->>'$.k' AS BIGINT) AS k FROM events),
g AS (SELECT *, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 30 MINUTE, true) AS new FROM e),
s AS (SELECT *, sum(CAST(new AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g),
f AS (SELECT user_id, sid, min(ts) AS s, max(ts) AS e, count(*) AS n, arg_min(k, ts) AS inp FROM s
      GROUP BY ALL HAVING count(*) >= 2 AND max(ts) + INTERVAL 30 MINUTE < (SELECT max(ts) FROM events)),
sec AS (SELECT s.user_id, s.sid, min(s.ts) AS ft FROM s JOIN f USING (user_id, sid) WHERE s.ts > f.s GROUP BY ALL),
m AS (SELECT f.user_id, f.n - 1 AS out_tokens, f.inp, (epoch_us(f.e) - epoch_us(f.s)) / 1e6 AS total,
        coalesce((epoch_us(sec.ft) - epoch_us(f.s)) / 1e6, 0.001) AS ttft,
        coalesce((epoch_us(f.e) - epoch_us(sec.ft)) / 1e6, 0.0) AS dec0 FROM f LEFT JOIN sec USING (user_id, sid)),
m2 AS (SELECT *, CASE WHEN dec0 <= 0 THEN 0.001 ELSE dec0 END AS decode FROM m)
SELECT user_id, total AS total_generation_time, ttft AS time_to_first_token_seconds,
  decode AS token_generation_time,
  CASE WHEN out_tokens / decode > 0 THEN 1.0 / (out_tokens / decode) ELSE 0.0 END AS time_per_output_token,
  CAST(inp AS BIGINT) AS input_tokens, CAST(out_tokens AS BIGINT) AS output_tokens,
  CAST(inp + out_tokens AS BIGINT) AS total_tokens,
  CASE WHEN total > 0 THEN (inp + out_tokens) / total ELSE 0.0 END AS tokens_per_second,
  out_tokens / decode AS output_decode_tokens_per_second, ttft + total AS e2e_latency,
  total AS total_latency FROM m2""")
def q_stream_request_latency(spark, sf):
    s = _event_stream(spark, sf)
    r = SJ.stream_request_latency(s, "30 minutes", "0 seconds", ["user_id"],
                                  input_tokens=F.get_json_object("props", "$.k").cast("long"))
    return _drain(spark, r, "sessions").drop("start_ts")


@query("stream_append_results", "SELECT DISTINCT event_id, user_id, event_type, value FROM events")
def q_stream_append_results(spark, sf):
    """Idempotent append: the same input appended twice (a restart on a new
    checkpoint) stores each key once."""
    s = _event_stream(spark, sf).select("event_id", "user_id", "event_type", "value")
    target = _scratch(spark, "results")
    for i in range(2):
        q = SJ.stream_append_results(s, target, f"{target}-ckpt{i}", ["event_id"], partition="event_type")
        q.awaitTermination()
    return spark.read.parquet(target).select("event_id", "user_id", "event_type", "value")
