import pytest
from pyspark.sql import functions as F

from tidemark.operators import reconcile, stitch
from tidemark.operators.speed import speed_sessions
from tidemark.schemas import SESSION_LINK
from test_stitch import random_rows

SPEED = (
    "session_id string, event_count bigint, cart_total double, conversion_value double, converted boolean,"
    " duration_seconds bigint, date_partition string"
)


@pytest.fixture
def link(spark):
    def make(*rows):
        return spark.createDataFrame([
            (sid, bid, cart, value, count, converted, 600, late, late > 0, None)
            for sid, bid, cart, value, count, converted, late in rows], SESSION_LINK)
    return make


@pytest.fixture
def state(spark):
    def make(*rows):
        return spark.createDataFrame([
            (sid, count, cart, value, converted, 600, "2024-10-15") for sid, cart, value, count, converted in rows], SPEED)
    return make


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_equal_sides(link, state):
    row = only(reconcile.session_deltas(link(("s1", "u1_1", 29.99, 0.0, 3, False, 0)), state(("s1", 29.99, 0.0, 3, False))))
    assert (row.restatement_type, row.cart_total_delta, row.presence) == ("no_restatement", 0.0, "both")


def test_revenue(link, state):
    row = only(reconcile.session_deltas(link(("s1", "u1_1", 79.98, 0.0, 4, False, 1)), state(("s1", 29.99, 0.0, 3, False))))
    assert (row.restatement_type, row.cart_total_delta) == ("revenue_restatement", 49.99)


def test_flip_needs_equal_counts_by_default(link, state):
    batch, fast = link(("s1", "u1_1", 49.99, 49.99, 4, True, 1)), state(("s1", 49.99, 0.0, 3, False))
    assert only(reconcile.session_deltas(batch, fast)).restatement_type == "event_count_restatement"
    assert only(reconcile.session_deltas(batch, fast, flip_first=True)).restatement_type == "conversion_flip"
    same = state(("s1", 49.99, 0.0, 4, False))
    assert only(reconcile.session_deltas(batch, same)).restatement_type == "conversion_flip"


def test_one_sided_rows(link, state):
    batch = link(("b", "u1_1", 0.0, 0.0, 1, False, 0))
    fast = state(("f", 5.0, 0.0, 2, True), ("g", 0.0, 0.0, 0, False))
    rows = {r.session_id: r for r in reconcile.session_deltas(batch, fast).collect()}
    assert rows["b"].restatement_type == "missing_in_realtime" and rows["b"].presence == "batch_only"
    assert rows["f"].restatement_type == "revenue_restatement" and rows["f"].presence == "speed_only"
    assert rows["f"].conversion_flipped is None and rows["f"].event_count_delta == -2
    assert rows["g"].restatement_type == "no_restatement"


def test_null_id_reaches_new_in_batch(link, state):
    row = only(reconcile.session_deltas(link((None, "u1_1", 1.0, 0.0, 1, False, 0)), state()))
    assert row.restatement_type == "new_in_batch"


def test_audit_is_absolute_with_absent_as_zero(link, state):
    batch = link(("s1", "u1_1", 10.0, 0.0, 2, False, 1), ("b", "u2_1", 3.0, 0.0, 1, False, 0))
    fast = state(("s1", 12.5, 0.0, 5, False), ("f", 4.0, 0.0, 1, False))
    rows = {r.session_id: (r.revenue_discrepancy, r.event_count_discrepancy)
            for r in reconcile.restatement_audit(fast, batch).collect()}
    assert rows == {"s1": (2.5, 3), "b": (3.0, 1), "f": (4.0, 1)}


def test_fan_out_both_ways(link, state):
    """One id in two batch sessions, and two ids in one."""
    batch = link(("s1", "u1_1", 1.0, 0.0, 1, False, 0), ("s1", "u1_2", 2.0, 0.0, 1, False, 0),
                 ("s2", "u1_2", 2.0, 0.0, 1, False, 0))
    fast = state(("s1", 1.0, 0.0, 1, False), ("s2", 2.0, 0.0, 1, False))
    assert reconcile.session_deltas(batch, fast).count() == 3


def test_parts_equal_a_full_outer_join(canonical):
    rows = canonical(random_rows(300, seed=9)).persist()
    links, fast = stitch.session_links(rows), reconcile.speed_side(speed_sessions(rows))
    fast = fast.unionByName(fast.orderBy("session_id").limit(3).withColumn("session_id", F.concat(F.lit("x"), F.col("session_id"))))
    whole = links.join(fast, "session_id", "outer")
    for ids in (None, rows):
        parts = reconcile.outer_by_session(links, fast, ids).select(*whole.columns)
        assert parts.exceptAll(whole).count() == 0 and whole.exceptAll(parts).count() == 0
    rows.unpersist()


def test_no_full_outer_join_and_no_product(canonical):
    rows = canonical([{"event_time": "2024-10-15 10:00:00"}])
    links, fast = stitch.session_links(rows), speed_sessions(rows)
    for df in (reconcile.session_deltas(links, fast, rows), reconcile.restatement_detail(links, fast)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FullOuter" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_no_change_without_late_events(canonical):
    """With ids that map one to one and nothing late, both answers agree."""
    rows = [dict(r, is_late_arrival=False, session_id=r["user_id"]) for r in random_rows(60, seed=4)]
    df = canonical([dict(r, event_time=f"2024-10-15 10:{i % 30:02d}:00") for i, r in enumerate(rows)])
    deltas = reconcile.session_deltas(stitch.session_links(df), speed_sessions(df))
    kinds = {r.restatement_type for r in deltas.collect()}
    assert kinds == {"no_restatement"}


def test_stats_breakdown_and_top(link, state):
    batch = link(("s1", "u1_1", 79.98, 0.0, 4, False, 1), ("s2", "u2_1", 5.0, 0.0, 1, True, 0),
                 ("s3", "u3_1", 5.0, 0.0, 1, False, 0))
    fast = state(("s1", 29.99, 0.0, 3, False), ("s2", 5.0, 0.0, 1, False), ("s3", 5.0, 0.0, 1, False))
    deltas = reconcile.session_deltas(batch, fast)
    stats = only(reconcile.restatement_stats(deltas))
    assert (stats.total_sessions_compared, stats.sessions_restated, stats.conversion_flips) == (3, 2, 1)
    assert stats.total_revenue_restated == 49.99 and stats.max_revenue_discrepancy == 49.99
    assert stats.new_sessions_in_batch == 0 and stats.sessions_with_changed_conversion == 1
    kinds = [(r.restatement_type, r.session_count) for r in reconcile.restatement_breakdown(deltas).collect()]
    assert kinds == [("conversion_flip", 1), ("no_restatement", 1), ("revenue_restatement", 1)]
    assert [r.session_id for r in reconcile.top_restated(deltas, 1).collect()] == ["s1"]
    plan = reconcile.top_restated(deltas)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    detail = reconcile.restatement_detail(batch, fast).collect()
    assert [(r.session_id, r.cart_delta) for r in detail] == [("s1", 49.99)]
    assert reconcile.restatement_detail(batch, fast, "2024-10-16").count() == 0


def test_late_event_match(canonical):
    df = canonical([
        {"event_time": "2024-10-15 10:00:00"},
        {"event_time": "2024-10-15 09:55:00", "event_type": "cart", "price": 3.0, "is_late_arrival": True},
        {"event_time": "2024-10-15 09:55:00", "session_id": "s9", "is_late_arrival": True},
    ])
    found = {(r.session_id, r.match, r.revenue_delta) for r in reconcile.late_event_match(df).collect()}
    assert found == {("s1", "existing_session", 3.0), ("s9", "new_session", 0.0)}


def test_a_hot_session_id_is_split(spark, monkeypatch):
    """One id in half of all links: the joins over stored sides are split."""
    from pyspark.sql import functions as F

    from tidemark.session import stored

    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.files.maxPartitionBytes": "256k", "spark.sql.files.openCostInBytes": "1k",
    }
    was = {k: spark.conf.get(k, None) for k in low}
    for k, v in low.items():
        spark.conf.set(k, v)
    try:
        ids = F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("s"), "id"))
        links = stored(spark.range(0, 60000, 1, 6).select(
            ids.alias("session_id"), F.concat(F.lit("b"), "id").alias("batch_session_id"), F.rand(1).alias("batch_cart_total"),
            F.lit(0.0).alias("batch_conversion_value"), F.lit(1).cast("long").alias("batch_event_count"), F.lit(False).alias("batch_converted"),
            F.lit(0).cast("long").alias("batch_duration_seconds"), F.lit(1).cast("long").alias("late_arrival_count"),
            F.lit(True).alias("had_restatement"), F.current_date().alias("batch_session_date")), "links")
        speed = stored(links.select("session_id").distinct().select(
            "session_id", F.lit(1.0).alias("cart_total"), F.lit(0.0).alias("conversion_value"), F.lit(1).cast("long").alias("event_count"),
            F.lit(False).alias("converted"), F.lit(0).cast("long").alias("duration_seconds"), F.lit("2024-10-15").alias("date_partition")), "speed")
        deltas = reconcile.session_deltas(links, speed)
        assert len(deltas.collect()) == 60000
        assert "skew=true" in deltas._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
