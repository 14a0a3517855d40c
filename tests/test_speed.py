import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import speed

T0 = datetime(2024, 10, 15, 10)


def at(minutes=0, seconds=0):
    return (T0 + timedelta(minutes=minutes, seconds=seconds)).strftime("%Y-%m-%d %H:%M:%S.%f")


def test_state_of_a_full_session(canonical):
    row = speed.speed_sessions(canonical([
        {"event_time": at(0)},
        {"event_time": at(5), "event_type": "cart", "price": 49.99},
        {"event_time": at(10), "event_type": "purchase", "price": 49.99},
    ])).collect()[0]
    assert (row.event_count, row.cart_total, row.conversion_value, row.converted) == (3, 49.99, 49.99, True)
    assert row.event_types_seen == ["cart", "purchase", "view"]
    assert row.conversion_time == row.last_event_time and row.duration_seconds == 600
    assert row.user_id == "u1" and row.date_partition == "2024-10-15"


def test_late_events_do_not_reach_the_state(canonical):
    row = speed.speed_sessions(canonical([
        {"event_time": at(0)},
        {"event_time": at(-5), "event_type": "cart", "price": 89.99, "is_late_arrival": True},
    ])).collect()[0]
    assert (row.event_count, row.cart_total) == (1, 0.0)


@pytest.mark.parametrize("seconds, segments", [(1799, 1), (1800, 1), (1800.000001, 2), (2100, 2)])
def test_boundary_is_exact(canonical, seconds, segments):
    for start in (0, 13, 29.5):
        df = canonical([{"event_time": at(start)}, {"event_time": at(start, seconds)}])
        assert speed.speed_segments(df).count() == segments


def test_only_the_part_after_the_last_gap_survives(canonical):
    df = canonical([
        {"event_time": at(0), "event_type": "cart", "price": 5.0},
        {"event_time": at(10), "event_type": "purchase", "price": 5.0},
        {"event_time": at(60)},
        {"event_time": at(120), "event_type": "cart", "price": 7.0},
    ])
    row = speed.speed_sessions(df).collect()[0]
    assert (row.event_count, row.cart_total, row.converted) == (1, 7.0, False)
    closed = speed.closed_speed_sessions(df).orderBy("segment").collect()
    assert [(r.segment, r.event_count, r.converted) for r in closed] == [(0, 2, True), (1, 1, False)]


def test_missing_session_id_is_unknown(canonical):
    row = speed.speed_sessions(canonical([{"event_time": at(0), "session_id": None}])).collect()[0]
    assert row.session_id == "unknown"


def test_cart_totals(canonical):
    df = canonical([
        {"event_type": "cart", "price": 0.1}, {"event_type": "cart", "price": 0.2},
        {"event_type": "view", "price": 50.0}, {"event_type": "purchase", "price": 9.0},
        {"event_type": "cart", "price": None}, {"event_type": "cart", "price": float("nan")},
        {"event_type": "cart", "price": -10.0},
    ])
    assert speed.cart_totals(df).collect()[0].cart_total == 0.3


@pytest.mark.parametrize("seed", range(4))
def test_cart_never_below_zero_with_removals(spark, make_events, seed):
    from tidemark.operators.events import add_effective_time

    rng = random.Random(seed)
    rows = [{
        "event_time": at(rng.randrange(200), rng.choice([0, 1, 30])), "session_id": f"s{rng.randrange(3)}",
        "event_type": rng.choice(["cart", "remove_from_cart", "view"]), "price": float(rng.randrange(1, 9)),
    } for _ in range(150)]
    df = add_effective_time(make_events(rows))
    found = {r.session_id: r.cart_total
             for r in speed.cart_totals(df, removal_types=("remove_from_cart",)).collect()}
    expected = {}
    for _, _, row in sorted((datetime.fromisoformat(r["event_time"]), f"e{i:04d}", r) for i, r in enumerate(rows)):
        total = expected.get(row["session_id"], 0.0)
        if row["event_type"] == "cart":
            total += row["price"]
        elif row["event_type"] == "remove_from_cart":
            total = max(0.0, total - row["price"])
        expected[row["session_id"]] = total
    assert found == expected


def test_live_rows_and_lookups(canonical):
    state = speed.speed_sessions(canonical([
        {"event_time": at(0)}, {"event_time": at(60), "session_id": "s2", "user_id": "u2"},
    ]))
    as_of = F.lit("2024-10-15 12:00:00").cast("timestamp")
    assert [r.session_id for r in speed.live_sessions(state, as_of).collect()] == ["s2"]
    assert speed.session_by_id(state, "s1").count() == 1
    assert [r.session_id for r in speed.sessions_by_user(state, "u2").collect()] == ["s2"]


def test_id_shared_by_many_users_is_one_state(canonical):
    """The per-session window sees one row per cell, however many users."""
    df = canonical([{"event_time": at(i % 3), "session_id": None, "user_id": f"u{i}"} for i in range(40)])
    rows = speed.speed_sessions(df).collect()
    assert [(r.session_id, r.event_count, r.user_id) for r in rows] == [("unknown", 40, "u9")]
    assert "user_id" not in speed.speed_sessions(df, with_user=False).columns


def test_aggregation_of_events_is_hash_based(canonical):
    plan = speed.speed_sessions(canonical([{}]), with_user=False)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
