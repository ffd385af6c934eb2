"""Counts that come with the main action: what a reader found, what a filter
dropped, what a stream left out.

Batch counts are observations of a table as its rows pass by; they cost no
job of their own and are there when the first action over the table is done.
Streams report theirs with every micro-batch to a listener.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener


def counted(df: DataFrame, observation: Observation | str | None, **conditions: Column | None) -> DataFrame:
    """``df`` observed: per name the number of rows that fulfil the condition
    (all rows for None).  Without an observation, ``df`` itself.  In a stream
    the observation is a name, under which :class:`StreamCounts` adds up."""
    if observation is None:
        return df
    return df.observe(observation, *[(F.count(F.lit(1)) if c is None else F.count_if(c)).alias(n) for n, c in conditions.items()])


class StreamCounts(StreamingQueryListener):
    """Totals over the micro-batches of each query (by its id): ``rows`` read,
    ``late`` rows that came after their watermark and were dropped, and all
    observed counts as ``name.count``.  Register it with
    ``spark.streams.addListener`` before the query starts."""

    def __init__(self):
        self.totals: dict[str, Counter] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        total = self.totals.setdefault(str(p.id), Counter())
        total["rows"] += p.numInputRows
        total["late"] += sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        for name, row in p.observedMetrics.items():
            for field, value in row.asDict().items():
                total[f"{name}.{field}"] += value or 0

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.id))
