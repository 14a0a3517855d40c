import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from test_quarantine import event
from tidemark.operators.events import canonical_events, timed_events, valid_events
from tidemark.operators.speed import closed_speed_sessions, speed_sessions
from tidemark.schemas import RAW_EVENT
from tidemark.sources import files as source
from tidemark.streaming import sessionizer, state_table, windows
from tidemark.streaming.counters import BatchCounters, counted
from tidemark.streaming.routing import route_batch, start_routing
from tidemark.streaming.source import file_events, file_lines

WAIT = 240


def write_batch(folder, n, lines):
    """One file per micro-batch; the file source takes them in time order."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{n:04d}.json")
    with open(path, "w") as f:
        f.write("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines) + "\n")
    stamp = time.time() - 1000 + n
    os.utime(path, (stamp, stamp))


def finish(query):
    assert query.awaitTermination(WAIT), "stream did not end"


def clean(df):
    return timed_events(valid_events(canonical_events(df)))


def at(minute, second=0):
    return f"2024-10-15T{10 + minute // 60:02d}:{minute % 60:02d}:{second:02d}+00:00"


def ev(i, minute, second=0, **more):
    return event(f"e{i}", event_time=at(minute, second), arrival_time=at(minute, second), **more)


def replay(spark, tmp_path, batches, **options):
    folder = str(tmp_path / "in")
    for n, batch in enumerate(batches):
        write_batch(folder, n, batch)
    changes = sessionizer.session_updates(clean(file_events(spark, folder, max_files=1)), **options)
    path = str(tmp_path / "state")
    finish(state_table.start_upserts(changes, path, str(tmp_path / "cp"), available_now=True))
    return state_table.state_changes(spark, path)


def test_state_over_micro_batches(spark, tmp_path):
    history = replay(spark, tmp_path, [
        [ev(1, 0), ev(2, 1, event_type="cart", price=10.0)],
        [ev(3, 5, event_type="cart", price=5.5), ev(4, 2, event_type="cart", price=99.0, is_late_arrival=True)],
        [ev(5, 50, event_type="purchase", price=15.5)],
        [ev(6, 55), ev(7, 56, session_id="other", user_id="user_002")],
    ])
    state = {r.session_id: r for r in state_table.latest_state(history).collect()}
    assert (state["sess_abc"].event_count, state["sess_abc"].cart_total, state["sess_abc"].converted) == (2, 0.0, True)
    assert state["sess_abc"].event_types_seen == ["purchase", "view"]
    assert state["other"].user_id == "user_002"
    closed = state_table.closed_rows(history).collect()
    assert [(r.event_count, r.cart_total, r.converted) for r in closed] == [(3, 15.5, False)]


def test_stream_equals_batch_under_any_cut(spark, tmp_path):
    rng = random.Random(11)
    rows = [ev(i, m, rng.randrange(60), session_id=f"s{rng.randrange(5)}", event_type=rng.choice(["view", "cart", "purchase"]),
               price=rng.choice([0.1, 0.2, 7.25]), is_late_arrival=rng.random() < 0.1)
            for i, m in enumerate(sorted(rng.choices(range(0, 600), k=200)))]
    cuts = sorted(rng.sample(range(1, 200), 5))
    batches = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, 200])]
    history = replay(spark, tmp_path, batches)
    columns = ["session_id", "user_id", "event_count", "cart_total", "conversion_value", "converted", "session_start",
               "last_event_time", "conversion_time", "duration_seconds", "date_partition"]
    batch = clean(spark.createDataFrame([tuple(r[f.name] for f in RAW_EVENT.fields) for r in rows], RAW_EVENT))
    expected = {tuple(r) for r in speed_sessions(batch).select(*columns).collect()}
    found = {tuple(r) for r in state_table.latest_state(history).select(*columns).collect()}
    assert found == expected
    ended = history.filter("status IN ('closed', 'expired')").select("session_id", "session_start", "event_count")
    stretches = closed_speed_sessions(batch).select("session_id", "session_start", "event_count")
    assert stretches.exceptAll(ended).count() == 0


def test_state_expires_after_two_hours(spark, tmp_path):
    history = replay(spark, tmp_path, [
        [ev(1, 0)], [ev(2, 200, session_id="s2")], [ev(3, 201, session_id="s2")], [ev(4, 202)],
    ])
    expired = [r.session_id for r in history.filter("status = 'expired'").collect()]
    assert expired == ["sess_abc"]
    assert history.filter("status = 'closed'").count() == 0
    state = {r.session_id: r for r in state_table.latest_state(history).collect()}
    assert state["sess_abc"].event_count == 1 and state["sess_abc"].status == "active"


def test_summaries_shrink_a_hot_session(spark, canonical):
    rows = canonical([{"event_time": "2024-10-15 10:00:00", "event_type": "cart", "price": 0.01}])
    many = rows.crossJoin(spark.range(0, 30000, 1, 2)).drop("id")
    out = sessionizer.summaries(many).agg(F.count(F.lit(1)).alias("n"), F.sum("event_count").alias("events"),
                                          F.sum("cart_sum").alias("cart")).collect()[0]
    assert out.n <= 8 and out.events == 30000 and out.cart == 300


def test_routing_and_retry(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    write_batch(folder, 0, [ev(1, 0), ev(2, 1, is_late_arrival=True), "NOT VALID JSON {{{"])
    write_batch(folder, 1, [ev(3, 70)])
    finish(start_routing(file_lines(spark, folder, 1), root, str(tmp_path / "cp"), available_now=True))

    def ids(name):
        return sorted(r.event_id for r in source.readable(source.raw_events(spark, f"{root}/{name}")).collect())

    assert ids("events") == ["e1", "e2", "e3"] and ids("late-arrivals") == ["e2"]
    bad = spark.read.json(f"{root}/quarantine").collect()
    assert [(r.raw_line, r.reason, r.batch_id) for r in bad] == [("NOT VALID JSON {{{", "not_json", 0)]
    route_batch(root)(spark.read.text(f"{folder}/0000.json"), 0)
    assert ids("events") == ["e1", "e2", "e3"] and spark.read.json(f"{root}/quarantine").count() == 1


def test_dedup_on_the_stream(spark, tmp_path):
    folder = str(tmp_path / "in")
    write_batch(folder, 0, [ev(1, 0), ev(1, 0), ev(2, 1)])
    write_batch(folder, 1, [ev(1, 0), ev(3, 2)])
    rows = windows.dedup_stream(clean(file_events(spark, folder, max_files=1)))
    query = rows.writeStream.format("memory").queryName("kept").option("checkpointLocation", str(tmp_path / "cp")) \
        .trigger(availableNow=True).start()
    finish(query)
    assert sorted(r.event_id for r in spark.table("kept").collect()) == ["e1", "e2", "e3"]


def test_closed_windows(spark, tmp_path):
    folder = str(tmp_path / "in")
    write_batch(folder, 0, [ev(1, 0), ev(2, 30), ev(3, 70)])
    write_batch(folder, 1, [ev(4, 200)])
    rows = windows.closed_window_sessions(clean(file_events(spark, folder, max_files=1)))
    query = rows.writeStream.format("memory").queryName("closed").option("checkpointLocation", str(tmp_path / "cp")) \
        .outputMode("append").trigger(availableNow=True).start()
    finish(query)
    assert sorted(r.event_count for r in spark.table("closed").collect()) == [1, 2]


def test_cart_counter(spark, tmp_path):
    folder = str(tmp_path / "in")
    write_batch(folder, 0, [ev(1, 0, event_type="cart", price=0.1)])
    write_batch(folder, 1, [ev(2, 1, event_type="cart", price=0.2), ev(3, 1, event_type="view", price=9.0)])
    counters = state_table.cart_counters(clean(file_events(spark, folder, max_files=1)))
    finish(state_table.start_upserts(counters, str(tmp_path / "s"), str(tmp_path / "cp"), available_now=True))
    row = state_table.latest_rows(state_table.state_changes(spark, str(tmp_path / "s")), "session_id", ("batch_id",)).collect()[0]
    assert row.cart_total == 0.3 and row.event_count == 3


def test_counters_per_batch(spark, tmp_path):
    folder = str(tmp_path / "in")
    write_batch(folder, 0, [ev(1, 0), ev(2, 1, is_late_arrival=True)])
    listener = BatchCounters()
    spark.streams.addListener(listener)
    try:
        query = counted(clean(file_events(spark, folder))).writeStream.format("noop") \
            .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        finish(query)
        for _ in range(100):
            if listener.totals:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert listener.totals == {"processed": 2, "late_arrivals": 1, "errors": 0}


def test_compaction_keeps_the_latest(spark, tmp_path):
    history = replay(spark, tmp_path, [[ev(1, 0)], [ev(2, 1)], [ev(3, 2)]])
    assert history.count() == 3
    state_table.compact_state(spark, str(tmp_path / "state"), str(tmp_path / "small"))
    rows = state_table.state_changes(spark, str(tmp_path / "small")).collect()
    assert [r.event_count for r in rows] == [3]


def test_folded_state(spark, tmp_path, monkeypatch):
    """After each batch the current state is that of the whole history, folded or not;
    a folded batch run again, and a fold that is lost, change nothing."""
    folder, path = str(tmp_path / "in"), str(tmp_path / "state")
    rng = random.Random(4)
    rows = [ev(i, m, session_id=f"s{rng.randrange(30)}") for i, m in enumerate(sorted(rng.choices(range(300), k=160)))]
    for n in range(5):
        write_batch(folder, n, rows[32 * n:32 * n + 32])
    changes = sessionizer.session_updates(clean(file_events(spark, folder, max_files=1)))
    finish(state_table.start_upserts(changes, path, str(tmp_path / "cp"), available_now=True))
    history = state_table.state_changes(spark, path)
    facts = lambda df: sorted((r.session_id, r.session_start, r.event_count) for r in df.collect())
    want = facts(state_table.latest_state(history))
    assert facts(state_table.current_state(spark, path)) == want
    for last in (1, 3, None):
        state_table.fold_changes(spark, path, last)
        assert facts(state_table.current_state(spark, path)) == want
    folded = state_table._base(spark, path).number
    state_table.fold_changes(spark, path)
    assert state_table._base(spark, path).number == folded
    write = state_table.upsert_batch(path, compact_every=1)
    schema = history.drop("batch_id").schema
    again, one = history.where("batch_id = 1").drop("batch_id").collect(), history.where("session_id = 's1'").drop("batch_id").collect()
    write(spark.createDataFrame(again, schema), 1)
    assert facts(state_table.current_state(spark, path)) == want and state_table._base(spark, path).number == folded
    with monkeypatch.context() as lost:
        lost.setattr("tidemark.sinks.manifest.Change.commit", lambda self: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            write(spark.createDataFrame(one, schema), 99)
    one = state_table.session_state(spark, path, "s1")
    assert facts(one) == [w for w in want if w[0] == "s1"]
    paths = [f for f in one.inputFiles() if "/_base/" in f]
    assert len({f.split("part=")[1].split("/")[0] for f in paths}) == 1



@pytest.mark.parametrize("seconds, closed", [(1800, 0), (1801, 1)])
def test_boundary(spark, tmp_path, seconds, closed):
    history = replay(spark, tmp_path, [[ev(1, 0)], [ev(2, seconds // 60, seconds % 60)]])
    assert history.filter("status = 'closed'").count() == closed


def test_one_state_row_per_bucket(spark, tmp_path, monkeypatch):
    """Ids of one bucket share a state row and a call; the sessions are the same."""
    monkeypatch.setattr(sessionizer, "STATE_BUCKETS", 1)
    folder, cp = str(tmp_path / "in"), str(tmp_path / "cp")
    write_batch(folder, 0, [ev(i, 0, session_id=f"s{i}") for i in range(40)])
    write_batch(folder, 1, [ev(90, 20, session_id="s1"), ev(91, 50, session_id="s2"), ev(92, 200, session_id="late")])
    write_batch(folder, 2, [ev(93, 330, session_id="late")])
    query = state_table.start_upserts(
        sessionizer.session_updates(clean(file_events(spark, folder, max_files=1))), str(tmp_path / "state"), cp, available_now=True)
    finish(query)
    rows = state_table.state_changes(spark, str(tmp_path / "state")).collect()
    state = [p["stateOperators"][0]["numRowsTotal"] for p in map(lambda p: json.loads(p.json), query.recentProgress) if p["stateOperators"]]
    # The bucket's row, and its timer in two indexes.
    assert max(state) <= 3
    held = {r.session_id: r for r in state_table.latest_state(state_table.state_changes(spark, str(tmp_path / "state"))).collect()}
    assert len(held) == 41 and held["s1"].event_count == 2 and held["s2"].event_count == 1
    assert sorted((r.session_id, r.event_count) for r in rows if r.status == "closed") == [("late", 1), ("s2", 1)]
    expired = sorted(r.session_id for r in rows if r.status == "expired")
    assert expired == sorted(f"s{i}" for i in range(40))


def test_a_fold_in_a_stream_writes_one_file_per_bucket(spark, tmp_path):
    """Spark turns AQE off inside a stream, and with it the hint that gathers each bucket."""
    path, session = str(tmp_path / "state"), spark.newSession()
    session.conf.set("spark.sql.adaptive.enabled", "false")
    facts = "CAST(id % 500 AS string) AS session_id, 'active' AS status, timestamp_seconds(id) AS session_start, id AS event_count"
    state_table.upsert_batch(path, compact_every=1)(session.range(0, 2000, 1, 4).selectExpr(*facts.split(", ")), 0)
    files = [f for _, _, names in os.walk(os.path.join(path, "_base", "state")) for f in names if f.endswith(".parquet")]
    assert 0 < len(files) <= state_table.BUCKETS
    assert state_table.current_state(session, path).count() == 500


def test_steps_can_be_read_by_several_tasks(spark, tmp_path, monkeypatch):
    """One file per micro-batch, but in row groups that tasks can share."""
    import pyarrow.parquet as pq

    from suite import inputs

    monkeypatch.setattr(inputs, "ROW_GROUP_BYTES", 1 << 16, raising=False)
    rows, path = inputs.raw_events(spark, "/root/testdata/sf0.01"), tmp_path / "steps"
    inputs._in_steps(rows, str(path))
    files = [pq.ParquetFile(f) for f in path.glob("*.parquet")]
    assert len(files) == 5 and sum(f.metadata.num_rows for f in files) == rows.count()
    assert min(f.num_row_groups for f in files) > 1
