"""Windows over range partitions: equal to a plain window, and no key in one task."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import scan, speed, stitch

T0 = datetime(2024, 10, 15, 10)


def at(seconds):
    return (T0 + timedelta(seconds=seconds)).strftime("%Y-%m-%d %H:%M:%S.%f")


def rows(seed, n=400):
    rng = random.Random(seed)
    users = ["hot"] * 6 + ["a", "b", "ü", "c d", 'q"\\']
    return [{
        "event_id": f"e{i:04d}", "event_time": at(rng.choice([0, 5, rng.randrange(40000), rng.random() * 40000])),
        "user_id": rng.choice(users), "session_id": rng.choice(["s1", "s1", "s2"]),
        "event_type": rng.choice(["cart", "view", "purchase"]), "price": float(rng.randrange(9)),
    } for i in range(n)]


def plain(df, key, timeout):
    line = Window.partitionBy(key).orderBy("effective_time", "event_id")
    before = F.lag("effective_time").over(line)
    opens = F.when(F.unix_seconds("effective_time") - F.unix_seconds(before) <= timeout, 0).otherwise(1)
    return df.withColumns({"before": before, "opens": opens, "place": F.row_number().over(line)}).withColumn("seq", F.sum("opens").over(line))


@pytest.mark.parametrize("seed,parts", [(1, 4), (2, 16), (3, 1), (4, 60)])
def test_equal_to_a_window_by_key(spark, canonical, seed, parts):
    events = canonical(rows(seed)).cache()
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        for key in ("user_id", "session_id"):
            got = {r.event_id: (r.prev_event_time, r.is_session_start, r.session_seq, r.position) for r in stitch.scanned(events, key, "event_id", 1800).collect()}
            want = {r.event_id: (r.before, r.opens, r.seq, r.place) for r in plain(events, key, 1800).collect()}
            assert got == want
        removed = {r.user_id: r.cart_total for r in speed.cart_totals(events, "user_id", ("purchase",)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        events.unpersist()
    totals: dict = {}
    for r in sorted(rows(seed), key=lambda r: (datetime.strptime(r["event_time"], "%Y-%m-%d %H:%M:%S.%f"), r["event_id"])):
        sign = {"cart": 1, "purchase": -1, "view": 0}[r["event_type"]]
        totals[r["user_id"]] = max(0, totals.get(r["user_id"], 0) + sign * r["price"])
    assert removed == totals


def test_one_key_and_one_timestamp_use_several_tasks(canonical):
    events = canonical([{"event_id": f"e{i:05d}", "event_time": at(0)} for i in range(4000)])
    parts = scan.ranged(events, "user_id", "effective_time", "event_id").groupBy(scan.PART, F.spark_partition_id().alias("task")).count().collect()
    assert len(parts) == 4 and len({r.task for r in parts}) == 4 and max(r["count"] for r in parts) < 2000
    out = stitch.sessionized_events(events)
    assert out.where("batch_session_id != 'u1_1'").count() == 0
    assert stitch.session_event_paths(events).agg(F.sum("position")).first()[0] == 4000 * 4001 // 2


def test_one_exchange_and_two_rows_of_each_range(canonical):
    events = canonical(rows(5))
    plan = stitch.sessionized_events(events)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("direct_shuffle_partition_id") == 2  # rows and their summary
    assert "from_json" not in plan
    summary = scan.ranged(events, "user_id", "effective_time", "event_id").groupBy(scan.PART, "user_id").agg(F.count(F.lit(1)).alias("n"))
    assert max(r["count"] for r in scan.edges(summary, "user_id").groupBy(scan.PART).count().collect()) <= 2


def test_missing_values_and_empty_tables(canonical):
    events = canonical([{"event_time": None, "arrival_time": None}, {"event_time": None, "arrival_time": None, "user_id": None}, {"event_time": at(1)}, {"event_time": at(2), "user_id": None}])
    got = sorted((r.user_id or "", r.position) for r in stitch.scanned(events, "user_id", "event_id", 1800).collect())
    assert got == [("", 1), ("", 2), ("u1", 1), ("u1", 2)]
    assert stitch.event_gaps(events.limit(0)).count() == 0
