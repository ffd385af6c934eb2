"""Structured Streaming jobs on the same column expressions as the batch
operators: tumbling-window telemetry, session-window request latency, and
an idempotent append of result rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.telemetry import approx_quantile, latency_columns
from .keyed import KeyedFolder


def with_event_time(stream: DataFrame, ts="ts", out="event_time") -> DataFrame:
    """Watermarks need a zoned timestamp; a timestamp without zone is read
    in the session zone."""
    return stream.withColumn(out, F.col(ts).cast("timestamp"))


def stream_telemetry(stream: DataFrame, width: str, lateness: str,
                     devices: Sequence[str] | None = None, ts="event_time",
                     device="device", reading="reading", accuracy: int = 10000,
                     sketch_k: int | None = None) -> DataFrame:
    """Peak and p90 of device readings per tumbling window, continuously.

    The maximum over devices is taken per sample time first (a tick), then
    peak and p90 over the ticks in the window.  The p90 is a value of the
    window from a sketch of bounded size (exact up to ``accuracy`` ticks), so
    the state doesn't grow with the stream.  Append mode: a window is emitted
    once the watermark passes its end; later rows are dropped.

    With ``sketch_k`` a column ``sketch`` holds the window's mergeable
    quantile sketch; :func:`regroup_telemetry` makes days, weeks or any other
    grouping from stored windows."""
    s = stream if devices is None else stream.filter(F.col(device).isin(list(devices)))
    ticks = (s.withWatermark(ts, lateness)
              .groupBy(F.col(ts).alias("tick"))
              .agg(F.max(reading).alias("_m")))
    more = [] if sketch_k is None else [F.kll_sketch_agg_double(F.col("_m").cast("double"), sketch_k).alias("sketch")]
    return ticks.groupBy(F.window("tick", width).alias("w")).agg(F.max("_m").alias("peak"),
                                  approx_quantile("_m", 0.9, accuracy).alias("p90"),
                                  F.count("*").alias("n_ticks"), *more)


def regroup_telemetry(windows: DataFrame, by: Sequence[str] = (), prob: float = 0.9) -> DataFrame:
    """``(by..., peak, p90, n_ticks, sketch)`` of groups of stored windows
    (rows of :func:`stream_telemetry` with their sketches) without their
    readings.  The percentile is a reading whose rank is off by about
    ``2.3 / sketch_k`` of the group's ticks at most (99 % of the time; exact
    up to ``sketch_k`` ticks); the result has a sketch again, so that it can
    be grouped further."""
    both = windows.filter("sketch is not null").groupBy(*by).agg(
        F.max("peak").alias("peak"), F.sum("n_ticks").alias("n_ticks"), F.kll_merge_agg_double("sketch").alias("sketch"))
    name = f"p{round(100 * prob)}"
    return both.select(*by, "peak", F.when(F.col("n_ticks") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(prob))).alias(name),
                       "n_ticks", "sketch")


_REQ_STATE = "t1 array<long>, t2 array<long>, tmax array<long>, n array<long>, inp array<long>"


def merge_sessions(parts: list, gap: int) -> list:
    """Sessions ``(first, second, last, count, prompt)`` in micros, merged
    where the next starts within ``gap`` of the last end.  ``second`` is the
    second distinct time (None for one); the prompt is the smallest of the
    earliest time."""
    out: list = []
    for s in sorted(parts, key=lambda s: (s[0], s[2])):
        if out and s[0] - out[-1][2] <= gap:
            a = out[-1]
            times = sorted({t for t in (a[0], a[1], s[0], s[1]) if t is not None})
            out[-1] = (a[0], times[1] if len(times) > 1 else None, max(a[2], s[2]), a[3] + s[3],
                       min(a[4], s[4]) if a[0] == s[0] else a[4])
        else:
            out.append(s)
    return out


def batch_sessions(times, prompts, gap: int) -> list:
    """The sessions among the events of one micro-batch (vectorised)."""
    import numpy as np

    order = np.lexsort((prompts, times))
    t, p = times[order], prompts[order]
    starts = np.flatnonzero(np.concatenate([[True], np.diff(t) > gap]))
    ends = np.concatenate([starts[1:], [len(t)]])
    later = np.where(np.concatenate([[False], np.diff(t) > 0]), t, np.iinfo(np.int64).max)
    later[starts] = np.iinfo(np.int64).max  # a session's first time is not its second
    second = np.minimum.reduceat(later, starts)
    return [(int(t[a]), None if s == np.iinfo(np.int64).max else int(s), int(t[z - 1]), int(z - a), int(p[a]))
            for a, z, s in zip(starts, ends, second)]


def _closes(session, gap: int) -> int:
    """The watermark (ms) from which no event can join a session any more."""
    return (session[2] + gap) // 1000 + 1


#: Gaps of closing time that share one state entry.
ENTRY_GAPS = 1024


def _entries(sessions: list, gap: int, span: int) -> dict:
    """Sessions by the stretch of time they close in."""
    out: dict = {}
    for s in sessions:
        out.setdefault(_closes(s, gap) // span, []).append(s)
    return out


def _session_processor(gap: int, req: list, ts: str, inp_col: str | None):
    from pyspark.sql.streaming import StatefulProcessor

    span = max(1, ENTRY_GAPS * gap // 1000)

    class Sessions(StatefulProcessor):
        """State per request: a map from stretches of time to the sessions
        that close in them, five numbers each, and one timer per stretch, for
        the first that closes.  A batch writes only the entries its events
        change: an event that is late but not too late joins, or bridges, the
        sessions it belongs to.  A timer emits what has closed."""

        def init(self, handle) -> None:
            self.handle = handle
            self.open = handle.getMapState("open", "stretch long", _REQ_STATE)

        def _store(self, at: int, sessions: list) -> None:
            self.open.updateValue((at,), tuple([-1 if s[i] is None else s[i] for s in sessions] for i in range(5)))

        @staticmethod
        def _sessions(value) -> list:
            return [(int(a), None if b < 0 else int(b), int(c), int(d), int(e)) for a, b, c, d, e in zip(*value)]

        def handleInputRows(self, key, rows, timerValues):
            import numpy as np

            parts = []
            for batch in rows:
                if len(batch):
                    times = batch[ts].to_numpy().astype("datetime64[us]").astype(np.int64)
                    prompts = batch[inp_col].fillna(0).to_numpy().astype(np.int64) if inp_col else np.zeros(len(batch), np.int64)
                    parts += batch_sessions(times, prompts, gap)
            old = {int(k[0]): self._sessions(v) for k, v in self.open.iterator()}
            new = _entries(merge_sessions([s for x in old.values() for s in x] + parts, gap), gap, span)
            for at in old.keys() | new.keys():
                if old.get(at) == new.get(at):
                    continue
                first, now = (min((_closes(s, gap) for s in x.get(at, ())), default=None) for x in (old, new))
                if first is not None and first != now:
                    self.handle.deleteTimer(first)
                if now is None:
                    self.open.removeKey((at,))
                    continue
                self._store(at, new[at])
                if first != now:
                    self.handle.registerTimer(now)
            return iter(())  # rows come from the timers

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            import pandas as pd

            passed = timerValues.getCurrentWatermarkInMs()
            at = expiredTimerInfo.getExpiryTimeInMs() // span
            held = self._sessions(self.open.getValue((at,)))
            done = [s for s in held if _closes(s, gap) <= passed]
            left = [s for s in held if _closes(s, gap) > passed]
            if left:
                self._store(at, left)
                self.handle.registerTimer(min(_closes(s, gap) for s in left))
            else:
                self.open.removeKey((at,))
            rows = pd.DataFrame(done, columns=["_start", "_first_tok", "_end", "_n", "_inp"])
            rows["_first_tok"] = rows["_first_tok"].astype("Int64")
            for c, v in zip(req, key):
                rows[c] = v
            yield rows[[*req, "_start", "_first_tok", "_end", "_n", "_inp"]]

        def close(self) -> None:
            pass

    return Sessions()


#: The state store that state variables and timers need.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_request_latency(stream: DataFrame, gap: str, lateness: str,
                           request: Sequence[str] = ("user_id",), ts="event_time",
                           input_tokens=None) -> DataFrame:
    """First-token and total time per request as tokens arrive.  A request
    is a burst of events closed after ``gap`` of silence, tracked by a
    stateful processor with five numbers of state per open session (no event
    list is ever gathered) and a timer for its end.  Its state variables need
    the RocksDB state store, which is set for the session.  Events may come out of order by up to
    ``lateness``; the result is that of the batch on the same events.  The
    latency columns are the batch operator's expressions."""
    req = list(request)
    gap_us = _interval_micros(stream, gap)
    src = stream.withWatermark(ts, lateness)
    inp_col = None
    if input_tokens is not None:
        src = src.withColumn("prompt__", input_tokens.cast("long"))
        inp_col = "prompt__"
    keys = ", ".join(f"{k} {src.schema[k].dataType.simpleString()}" for k in req)
    out_schema = f"{keys}, _start long, _first_tok long, _end long, _n long, _inp long"
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    sessions = src.select(*req, ts, *([inp_col] if inp_col else [])).groupBy(*req).transformWithStateInPandas(
        _session_processor(gap_us, req, ts, inp_col), out_schema, "append", "eventtime")
    as_ts = lambda c: F.timestamp_micros(F.col(c))
    return sessions.filter(F.col("_n") >= 2).select(
        *req, as_ts("_start").alias("start_ts"),
        *latency_columns(as_ts("_start"), as_ts("_first_tok"), as_ts("_end"),
                         F.col("_n"), F.col("_inp")))


def _interval_micros(df: DataFrame, gap: str) -> int:
    """Microseconds of an interval literal such as ``30 minutes``."""
    units = {"microsecond": 1, "millisecond": 1000, "second": 10**6, "minute": 60 * 10**6,
             "hour": 3600 * 10**6, "day": 86400 * 10**6}
    num, unit = gap.split()
    return int(float(num) * units[unit.rstrip("s").lower()])


def stream_append_results(stream: DataFrame, path: str, checkpoint: str,
                          keys: Sequence[str], fmt: str = "parquet",
                          trigger_once: bool = True, partition: str | None = None,
                          rows_per_file: int = 1_000_000, merge_files: int = 64) -> StreamingQuery:
    """Append only rows whose keys are not stored yet (null is a key value
    like others; of rows of one key in a batch the smallest is stored); safe
    to restart: the checkpoint records processed input, and stored keys are
    found through the key index of :class:`~.keyed.KeyedFolder`, so a batch
    opens only the files that may hold one of its keys.

    With ``partition`` the result is stored partitioned by that column.
    ``rows_per_file`` and ``merge_files`` say when small files are merged."""
    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        KeyedFolder(batch.sparkSession, path, keys, fmt, partition, rows_per_file, merge_files).append(batch)

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
