"""Windows over keys of any size: range partitions and a scan over their edges.

A window by key puts the busiest key into one task. Here rows are dealt out by
ranges of (key, time, id), so a key, a minute or even a single timestamp that holds
most of the rows is spread over as many partitions as it needs. Inside a
partition a window runs as usual. Only the first and the last key of a partition
can go on in another one, so what a window has to carry over is two small rows
per partition; these are scanned in order and added back.

The ranges come from a sample of ``SAMPLES`` rows per partition, taken by the
smallest hashes of the ordering columns: the same rows give the same ranges, so a
partition computed again holds what it held before. Rows that agree in key, time
and id are not told apart and stay together.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLES = 32
PART = "range_part"


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _place(key: str, time: str, tie: str) -> Column:
    return F.struct(F.col(key).cast("string").alias("k"), F.unix_micros(F.col(time).cast("timestamp")).alias("t"), F.col(tie).cast("string").alias("i"))


def range_bounds(rows: DataFrame, key: str, time: str, tie: str, parts: int) -> list[tuple]:
    """At most ``parts - 1`` rising places that cut ``rows`` into ranges of about one size.
    ``SAMPLES * parts`` short rows come to the driver."""
    place = _place(key, time, tie)
    sample = rows.select(place.alias("p")).orderBy(F.xxhash64("p"), "p").limit(SAMPLES * parts)
    found = [r["p"] for r in sample.orderBy("p").collect()]
    cuts = [tuple(found[len(found) * i // parts]) for i in range(1, parts)] if found else []
    return sorted(set(cuts), key=lambda c: tuple((v is not None, v if v is not None else 0) for v in c))


def _part_number(place: Column, bounds: list[tuple]) -> Column:
    """How many bounds lie at or before ``place``, looked up in two steps: in every
    ``width``-th bound, then in the bounds behind it."""
    width = max(1, int(len(bounds) ** 0.5))
    fields = [dict(zip("kti", b)) for b in bounds]
    blocks = [{"first": fields[i], "all": fields[i:i + width]} for i in range(0, len(fields), width)]
    one = "struct<k: string, t: bigint, i: string>"
    known = F.from_json(F.lit(json.dumps(blocks)), f"array<struct<first: {one}, all: array<{one}>>>")
    block = F.size(F.filter(known, lambda b: b["first"] <= place))
    inside = F.size(F.filter(F.element_at(known, block)["all"], lambda b: b <= place))
    return F.when(block == 0, 0).otherwise((block - 1) * width + inside).cast("int")


def ranged(rows: DataFrame, key: str, time: str, tie: str) -> DataFrame:
    """``rows`` dealt out by range, the number of the range in column PART. One exchange;
    a window by (PART, ...) needs no other."""
    parts = _partitions(rows)
    bounds = range_bounds(rows, key, time, tie, parts)
    number = _part_number(_place(key, time, tie), bounds) if bounds else F.lit(0)
    return rows.withColumn(PART, number).repartitionById(parts, PART)


def inside(key: str, *order: str) -> Window:
    """The window of a key's rows inside one range."""
    return Window.partitionBy(PART, key).orderBy(*order)


def across(key: str) -> Window:
    """The window over a key's ranges, for one row per (key, range)."""
    return Window.partitionBy(key).orderBy(PART)


def edges(summary: DataFrame, key: str) -> DataFrame:
    """Of one row per (PART, key) those of the first and last key of each range: all
    that can have neighbours in other ranges. At most two rows per range."""
    ends = Window.partitionBy(PART)
    text = F.col(key).cast("string")
    marked = summary.withColumns({
        "scan_first": F.min(F.struct(text.alias("k"))).over(ends), "scan_last": F.max(F.struct(text.alias("k"))).over(ends),
    })
    here = F.struct(text.alias("k"))
    return marked.where((here == F.col("scan_first")) | (here == F.col("scan_last"))).drop("scan_first", "scan_last")


def with_carry(rows: DataFrame, carried: DataFrame, key: str) -> DataFrame:
    """Adds the columns of ``carried`` to the rows of its (PART, key); null elsewhere.
    ``carried`` comes from :func:`edges`: two rows per range at most, so it is broadcast."""
    names = [c for c in carried.columns if c not in (PART, key)]
    small = carried.select(F.col(PART).alias("carry_part"), F.col(key).alias("carry_key"), *names)
    same = (F.col(PART) == F.col("carry_part")) & F.col(key).eqNullSafe(F.col("carry_key"))
    return rows.join(F.broadcast(small), same, "left").drop("carry_part", "carry_key")
