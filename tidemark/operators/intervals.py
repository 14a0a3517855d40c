"""Sessions as mergeable intervals, so that events of any age find their session.

An interval is a stretch of one user's events without a gap above the timeout,
with sums that can be added. New events become intervals of their own; together
with the stored intervals they can touch they are merged again: two belong together
if the later one starts at most ``timeout`` whole seconds after the end of all
before it. A new interval may join a stored one, extend it at either end, or bridge
two or more; stored intervals it doesn't touch stay as they are.

The intervals an interval can touch start on a day it covers (or up to the timeout
after it), or are listed as open on its first day: the table of open sessions has one
row per session and later day that the session, with the timeout, reaches into.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import plus_seconds, seconds_between, time_cell
from tidemark.operators.stitch import COMBINE, _cells, _numbered_cells, combined_measures
from tidemark.schemas import MONEY_TYPE

_MONEY = T.DecimalType(*map(int, MONEY_TYPE.removeprefix("decimal(").rstrip(")").split(",")))
_KINDS = {"event_count": T.LongType(), "late_count": T.LongType(), "converted": T.BooleanType(), "cart_sum": _MONEY, "purchase_sum": _MONEY}

INTERVAL = T.StructType([T.StructField("user_id", T.StringType())] + [T.StructField(n, _KINDS.get(n, T.TimestampType())) for n in COMBINE])
INTERVAL_ID = T.StructType([
    T.StructField("user_id", T.StringType()), T.StructField("first_time", T.TimestampType()), T.StructField("session_id", T.StringType()),
])
OPEN = T.StructType([
    T.StructField("user_id", T.StringType()), T.StructField("first_time", T.TimestampType()), T.StructField("open_day", T.StringType()),
])


def day_of(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd")


def reach(last: Column, timeout: int) -> Column:
    """Up to when an event may follow ``last`` in the same session; gaps count whole seconds."""
    return plus_seconds(last, F.lit(timeout + 1))


def _days(first: Column, last: Column) -> Column:
    return F.transform(F.sequence(F.to_date(first), F.to_date(last)), lambda d: F.date_format(d, "yyyy-MM-dd"))


def days_touched(intervals: DataFrame, timeout: int) -> DataFrame:
    """Days on which intervals start that these can touch."""
    return intervals.select(F.explode(_days(F.col("first_time"), reach(F.col("last_time"), timeout))).alias("day")).distinct()


def open_rows(intervals: DataFrame, timeout: int) -> DataFrame:
    """One row per interval and day behind its first that it reaches into."""
    later = F.filter(_days(F.col("first_time"), reach(F.col("last_time"), timeout)), lambda d: d > day_of(F.col("first_time")))
    return intervals.select("user_id", "first_time", F.explode(later).alias("open_day"))


def event_intervals(events: DataFrame, timeout: int) -> tuple[DataFrame, DataFrame]:
    """(intervals, ids): the intervals of these events alone, and the source ids of each."""
    cells = _numbered_cells(_cells(events, timeout, count_ids=False), timeout)
    start = F.min("first_time").over(Window.partitionBy("user_id", "user_session_seq"))
    own = events.select("user_id", time_cell(F.col("effective_time"), timeout).alias("cell"), "session_id").where("session_id IS NOT NULL").distinct()
    ids = own.join(cells.select("user_id", "cell", start.alias("first_time")), ["user_id", "cell"])
    intervals = cells.groupBy("user_id", "user_session_seq").agg(*combined_measures())
    return intervals.select(*INTERVAL.names), ids.select(*INTERVAL_ID.names).distinct()


def grouped(stored: DataFrame, fresh: DataFrame, timeout: int) -> DataFrame:
    """Stored and fresh intervals with the start of the session they end up in
    (``start``), for sessions with something fresh; column ``fresh`` tells the two apart."""
    both = stored.withColumn("fresh", F.lit(False)).unionByName(fresh.withColumn("fresh", F.lit(True)))
    line = Window.partitionBy("user_id").orderBy("first_time", "last_time", "fresh")
    before = F.max("last_time").over(line.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(seconds_between(F.col("first_time"), before) <= timeout, 0).otherwise(1)
    numbered = both.withColumn("opens", opens).withColumn("seq", F.sum("opens").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    whole = Window.partitionBy("user_id", "seq")
    marked = numbered.withColumns({"start": F.min("first_time").over(whole), "changed": F.max("fresh").over(whole)})
    return marked.where("changed").drop("opens", "seq", "changed")


def merged(groups: DataFrame) -> DataFrame:
    """One interval per session out of :func:`grouped`."""
    return groups.groupBy("user_id", "start").agg(*combined_measures()).select(*INTERVAL.names)
