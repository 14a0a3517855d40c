import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import stitch

T0 = datetime(2024, 10, 15, 10)


def at(minutes=0, seconds=0):
    return (T0 + timedelta(minutes=minutes, seconds=seconds)).strftime("%Y-%m-%d %H:%M:%S.%f")


def sessions(df, **options):
    return {r.batch_session_id: r for r in stitch.batch_sessions(df, **options).collect()}


def test_one_session(canonical):
    rows = sessions(canonical([
        {"event_time": at(0)},
        {"event_time": at(5), "event_type": "cart", "price": 49.99},
        {"event_time": at(10), "event_type": "purchase", "price": 49.99},
    ]))
    assert list(rows) == ["u1_1"]
    row = rows["u1_1"]
    assert (row.event_count, row.converted, row.duration_seconds) == (3, True, 600)
    assert (row.cart_total, row.conversion_value) == (49.99, 49.99)
    assert row.original_session_ids == ["s1"]


@pytest.mark.parametrize("gap, count", [(29 * 60, 1), (30 * 60, 1), (30 * 60 + 1, 2), (35 * 60, 2)])
def test_gap_rule(canonical, gap, count):
    for start in (0, 1, 17, 29):
        df = canonical([{"event_time": at(start)}, {"event_time": at(start, gap), "session_id": "s2"}])
        assert len(sessions(df)) == count
        assert stitch.sessionized_events(df).select("batch_session_id").distinct().count() == count


def test_gap_counts_whole_seconds(canonical):
    df = canonical([{"event_time": at(0, 0.2)}, {"event_time": at(30, 0.9)}])
    assert len(sessions(df)) == 1
    assert stitch.session_window_sessions(df).count() == 2


def test_users_do_not_mix(canonical):
    df = canonical([{"event_time": at(0)}, {"event_time": at(0), "user_id": "u2"}])
    assert set(sessions(df)) == {"u1_1", "u2_1"}


def test_cart_sum(canonical):
    df = canonical([
        {"event_time": at(0), "event_type": "cart", "price": 29.99},
        {"event_time": at(1), "event_type": "cart", "price": 49.99},
    ])
    assert sessions(df)["u1_1"].cart_total == 79.98


def test_late_event_counts(canonical):
    df = canonical([
        {"event_time": at(0)},
        {"event_time": at(-5), "arrival_time": at(8), "event_type": "cart", "price": 29.99, "is_late_arrival": True},
    ])
    row = sessions(df)["u1_1"]
    assert (row.late_arrival_count, row.had_restatement, row.event_count) == (1, True, 2)


def test_late_event_bridges_two_ids(canonical):
    on_time = [{"event_time": at(0)}, {"event_time": at(50), "session_id": "s2"}]
    assert len(sessions(canonical(on_time))) == 2
    bridged = on_time + [{"event_time": at(25), "session_id": "s2", "is_late_arrival": True}]
    rows = sessions(canonical(bridged))
    assert rows["u1_1"].original_session_ids == ["s1", "s2"]


def test_missing_event_time_falls_back_to_arrival(canonical):
    df = canonical([{"event_time": None, "arrival_time": "2024-10-15 10:00:01"}])
    assert df.filter(F.col("effective_time").isNull()).count() == 0
    assert len(sessions(df)) == 1


def test_ids_above_the_limit_stay_in_the_links(canonical):
    df = canonical([{"event_time": at(i), "session_id": f"s{i}"} for i in range(6)])
    row = sessions(df, inline_limit=5)["u1_1"]
    assert row.original_session_ids is None and row.event_count == 6
    assert stitch.session_links(df).count() == 6
    assert sessions(df, inline_limit=6)["u1_1"].original_session_ids == [f"s{i}" for i in range(6)]


def test_links_equal_exploded_ids(canonical):
    df = canonical(random_rows(300, seed=3))
    stored = stitch.exploded_links(stitch.batch_sessions(df))
    links = stitch.session_links(df).select(*stored.columns)
    assert sorted(map(tuple, stored.collect()), key=repr) == sorted(map(tuple, links.collect()), key=repr)


def test_ids_of_sessions_of_any_size_are_in_chunks(canonical):
    df = canonical([{"event_time": at(i // 2), "session_id": f"s{i % 25}"} for i in range(60)] + [{"event_time": at(0), "user_id": "u2", "session_id": None}])
    chunks = stitch.session_id_chunks(df, chunk_ids=5)
    rows = chunks.collect()
    assert {r.n_ids for r in rows} == {25} and len(rows) > 1 and {r.chunk for r in rows} <= set(range(5))
    assert sorted(i for r in rows for i in r.ids) == sorted(f"s{i}" for i in range(25))
    large = stitch.batch_sessions(df, inline_limit=3)
    assert large.where("original_session_ids IS NULL").count() == 1
    stored = stitch.exploded_links(large, chunks)
    links = stitch.session_links(df).select(*stored.columns)
    assert sorted(map(tuple, stored.collect()), key=repr) == sorted(map(tuple, links.collect()), key=repr)
    with pytest.raises(Exception, match="id chunks"):
        stitch.exploded_links(large).collect()


def random_rows(n, seed, users=4):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        user = f"u{min(rng.randrange(users * 2), users - 1) if rng.random() < 0.5 else 0}"
        when = rng.randrange(0, 60 * 24 * 2)
        rows.append({
            "event_time": at(when, rng.choice([0, 0, 0.25, 59.999999])), "user_id": user,
            "session_id": f"{user}-{rng.randrange(6)}", "event_type": rng.choice(["view", "cart", "purchase"]),
            "price": rng.choice([0.1, 0.2, 5.0, None, float("nan"), -3.0]),
            "is_late_arrival": rng.random() < 0.2,
        })
    return rows


def brute_force(rows, timeout):
    """Sessions by a plain walk over each user's sorted events."""
    users = {}
    for i, row in enumerate(rows):
        users.setdefault(row["user_id"], []).append((datetime.fromisoformat(row["event_time"]), f"e{i:04d}", row))
    result = {}
    for user, events in users.items():
        events.sort(key=lambda e: e[:2])
        seq, last = 0, None
        for when, event_id, row in events:
            if last is None or int(when.timestamp()) - int(last.timestamp()) > timeout:
                seq += 1
            last = when
            result.setdefault(f"{user}_{seq}", []).append((when, event_id, row))
    return result


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("timeout", [600, 1800, 21600])
def test_against_brute_force(canonical, seed, timeout):
    rows = random_rows(400, seed)
    df = canonical(rows).persist()
    expected = brute_force(rows, timeout)
    found = sessions(df, timeout=timeout)
    assert set(found) == set(expected)
    for key, events in expected.items():
        row = found[key]
        assert row.event_count == len(events)
        assert row.session_start == min(e[0] for e in events)
        assert row.session_end == max(e[0] for e in events)
        assert row.late_arrival_count == sum(e[2]["is_late_arrival"] for e in events)
        assert row.original_session_ids == sorted({e[2]["session_id"] for e in events})
        carts = [e[2]["price"] for e in events if e[2]["event_type"] == "cart"]
        assert row.cart_total == pytest.approx(sum(p for p in carts if p and p > 0))
    per_event = {r.event_id: r for r in stitch.sessionized_events(df, timeout).collect()}
    assert len(per_event) == len(rows)
    for key, events in expected.items():
        for when, event_id, _ in events:
            assert per_event[event_id].batch_session_id == key
    df.unpersist()


def test_positions_and_previous_times(canonical):
    rows = random_rows(200, seed=5)
    df = canonical(rows)
    paths = stitch.session_event_paths(df).collect()
    groups = {}
    for r in paths:
        groups.setdefault(r.session_id, []).append(r)
    for events in groups.values():
        events.sort(key=lambda r: (r.effective_time, r.event_id))
        assert [r.position for r in events] == list(range(1, len(events) + 1))
    gaps = {}
    for r in stitch.event_gaps(df).collect():
        gaps.setdefault(r.user_id, []).append(r)
    for events in gaps.values():
        events.sort(key=lambda r: (r.effective_time, r.event_id))
        assert events[0].prev_event_time is None
        for before, row in zip(events, events[1:]):
            assert row.prev_event_time == before.effective_time


def test_stable_id_does_not_depend_on_the_range(canonical):
    rows = [{"event_time": at(0)}, {"event_time": at(120)}]
    whole = {r.stable_session_id for r in stitch.with_stable_id(stitch.batch_sessions(canonical(rows))).collect()}
    part = {r.stable_session_id for r in stitch.with_stable_id(stitch.batch_sessions(canonical(rows[1:]))).collect()}
    assert part < whole


def test_busy_user_reaches_the_window_as_cells(spark, canonical):
    """The rows that enter the per-user window are bounded by time, not events."""
    many = canonical([{"event_time": at(0)}]).select("*", F.explode(F.sequence(F.lit(0), F.lit(19999))).alias("i"))
    many = many.withColumn("effective_time", F.timestamp_micros(
        F.unix_micros("effective_time") + F.col("i") * 100_000)).drop("i")
    facts = stitch.batch_session_facts(many)
    assert facts.collect()[0].event_count == 20000
    plan = facts._jdf.queryExecution().optimizedPlan().toString().splitlines()
    order = [line.strip(" +-:").split()[0] for line in plan]
    windows = [i for i, name in enumerate(order) if name == "Window"]
    aggregates = [i for i, name in enumerate(order) if name == "Aggregate"]
    assert len(windows) == 2 and aggregates[0] < windows[0] and windows[-1] < aggregates[-1]
    cells = many.select(F.floor(F.unix_seconds("effective_time") / 1800)).distinct().count()
    assert cells == 2
