"""Amounts of any size, decimals in nested values, repeats by hash, rows behind the watermark, partitions from ranges."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import money, times
from tidemark.operators import events as ev
from tidemark.operators import report
from tidemark.sinks.files import write_events
from tidemark.sources import files as source
from tidemark.sources import tables
from tidemark.streaming import behind


def test_sums_of_amounts_beyond_every_decimal(spark):
    rows = lambda *v: spark.createDataFrame([(x,) for x in v], "v double").agg(money.sum_of_doubles(F.col("v"))).first()[0]
    assert rows(0.1, 0.2, 1e17) == 1e17 + 0.3
    assert rows(1e17, 1e30, -2e40) == -2e40 + 1e30
    assert rows(None, None) is None and rows() is None and rows(0.0) == 0.0
    day = spark.createDataFrame([("d", "a", 1e30, 2e14, True, 1, 5), ("d", "a", 1.25, None, False, 1, 5)],
                                "date_partition string, session_id string, cart_total double, conversion_value double, converted boolean, event_count long, duration_seconds long")
    out = report.speed_summary(day).first()
    assert (out.rt_total_cart_value, out.rt_total_revenue, out.rt_total_sessions) == (1e30 + 1.25, 2e14, 1)


def test_decimals_in_nested_values(spark):
    df = spark.sql("""SELECT 1.5D AS a, array(map('k', struct(CAST(2.25 AS float) AS x, 'text' AS y, array(3.5D, NULL, DOUBLE('NaN'), 1e40D) AS z))) AS b,
                      CAST(NULL AS struct<p: double>) AS c, CAST(NULL AS array<double>) AS d, 7 AS `odd name.e`""")
    row = money.decimals_in(df).first()
    assert row.a == Decimal("1.5") and row.c is None and row.d is None and row["odd name.e"] == 7
    inner = row.b[0]["k"]
    assert (inner.x, inner.y, inner.z) == (Decimal("2.25"), "text", [Decimal("3.5"), None, None, None])


def test_parts_of_a_date_text(spark):
    got = spark.createDataFrame([("2024-10-05",), ("x",), (None,), ("2024",)], "t string").select(*[times.date_part(F.col("t"), i) for i in (1, 2, 3)]).collect()
    assert [tuple(r) for r in got] == [(2024, 10, 5), (None, None, None), (None, None, None), (2024, None, None)]


@pytest.mark.parametrize("collide", [False, True])
def test_repeats_by_hash(make_events, monkeypatch, collide):
    if collide:  # every id has one hash
        monkeypatch.setattr(ev, "id_hash", lambda: F.lit(1).cast("bigint") + F.length("event_id") * 0)
    raw = make_events([
        {"event_id": "a", "arrival_time": "2024-10-15 10:05:00", "price": 2.0}, {"event_id": "a", "arrival_time": "2024-10-15 10:01:00", "price": 9.0},
        {"event_id": "a", "arrival_time": "2024-10-15 10:01:00", "price": 3.0}, {"event_id": "b"}, {"event_id": "c"}, {"event_id": "c"},
    ])
    assert sorted((r.event_id, r.price) for r in ev.dedup_events(raw).collect()) == [("a", 3.0), ("b", 0.0), ("c", 0.0)]


def test_single_deliveries_are_not_sorted(spark, make_events):
    events = make_events([{"event_id": f"e{i}"} for i in range(50)] + [{"event_id": "e1"}])
    out = ev.dedup_events(events)
    assert out.count() == 50
    plan = out._jdf.queryExecution().executedPlan().toString()
    sides = plan.split("Union")[1].split("SortAggregate")[0]
    assert "LeftAnti" in sides and "SortAggregate" not in sides


def test_rows_behind_the_watermark(spark, tmp_path):
    at = lambda *m: spark.createDataFrame([(f"{x}", datetime(2024, 10, 15, 10, x) if x is not None else None) for x in m], "id string, effective_time timestamp")
    write, root = behind.split_batch(str(tmp_path), delay_seconds=300), str(tmp_path)
    batches = [at(0, 30), at(24, 25, 31, None), at(), at(10, 40), at(33, 36)]
    for n, batch in enumerate(batches):
        write(batch, n)
    ids = lambda side: sorted(r.id for r in spark.read.parquet(f"{root}/{side}").collect())
    assert ids("behind") == ["10", "24", "33"] and ids("in-time") == ["0", "25", "30", "31", "36", "40", "None"]
    write(batches[1], 1)  # run again: the same split, in the same place
    assert ids("behind") == ["10", "24", "33"] and ids("in-time") == ["0", "25", "30", "31", "36", "40", "None"]


def test_partitions_of_a_range_are_named_not_looked_for(spark, make_events, tmp_path):
    root = str(tmp_path)
    write_events(make_events([{"arrival_time": "2024-10-15 10:00:00"}, {"arrival_time": "2024-10-17 11:30:00"}]), f"{root}/events")
    spark.sql("CREATE DATABASE IF NOT EXISTS ranged")
    spark.sql("DROP TABLE IF EXISTS ranged.raw_events")
    tables.create_table(spark, "raw_events", root, "ranged", days=("2024-10-14", "2024-10-18"))
    table = spark.table("ranged.raw_events")
    assert spark.sql("SHOW PARTITIONS ranged.raw_events").count() == 5 * 24
    assert table.count() == 2 and table.where(times.on_day(F.lit("2024-10-16"))).count() == 0
    plan = table.where(times.on_day(F.lit("2024-10-17")))._jdf.queryExecution().executedPlan().toString()
    assert "(year#" in plan and "2024" in plan.split("PartitionFilters")[1][:300]
    assert source.events_between(spark, f"{root}/events", "2000-01-01", "2027-05-18").count() == 2
    assert source.events_between(spark, f"{root}/events", "2025-01-01", "2025-01-03").count() == 0
