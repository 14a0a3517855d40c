"""Counts per micro-batch, taken from the query progress."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidemark.operators.events import is_late


def counted(events: DataFrame, name: str = "batch") -> DataFrame:
    """Adds counters that come with each progress report; no extra job."""
    malformed = F.col("malformed") if "malformed" in events.columns else F.lit(False)
    return events.observe(
        name,
        F.count(F.lit(1)).alias("processed"),
        F.count_if(is_late()).alias("late_arrivals"),
        F.count_if(malformed).alias("errors"),
    )


class BatchCounters(StreamingQueryListener):
    """Adds up the counters of all micro-batches, a few numbers per batch."""

    def __init__(self, name: str = "batch"):
        self.name = name
        self.totals: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            for key, value in row.asDict().items():
                self.totals[key] = self.totals.get(key, 0) + (value or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
