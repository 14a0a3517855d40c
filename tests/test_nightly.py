"""Incremental stitching: events of any age, lost and repeated runs."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import intervals as iv
from tidemark.operators import stitch
from tidemark.plans import nightly
from tidemark.plans import stitch as job
from tidemark.sinks.files import write_events
from tidemark.sinks.manifest import RunStore
from tidemark.sources import files as source

T0 = datetime(2024, 10, 14)


def raw(i, user, happened, arrived, **more):
    return {"event_id": f"e{i}", "user_id": user, "session_id": f"{user}-{happened:%d%H}", "event_time": f"{happened:%Y-%m-%d %H:%M:%S.%f}",
            "arrival_time": f"{arrived:%Y-%m-%d %H:%M:%S}", "event_type": "cart", "price": 1.0, **more}


def facts(rows):
    return sorted((r.user_id, r.session_start, r.session_end, r.event_count, r.cart_total, tuple(r.original_session_ids)) for r in rows)


def test_random_arrivals_equal_all_time_sessions(spark, canonical, tmp_path):
    """Four batches in random order of event time, some events twice: joins at both
    ends, bridges, and sessions over several midnights."""
    rng = random.Random(3)
    rows = [raw(i, rng.choice("aab"), T0 + timedelta(minutes=rng.choice([rng.randrange(4000), 1430 + rng.randrange(20)])), T0) for i in range(160)]
    rows += [raw(1000 + i, "long", T0 + timedelta(minutes=25 * i), T0) for i in range(130)]
    rng.shuffle(rows)
    state = RunStore(spark, str(tmp_path / "state"))
    for k in range(4):
        again = [r for r in rows[:40 * k] if rng.random() < 0.2]
        state = nightly.take_in(spark, state, stitch_ready(canonical(rows[k::4] + again)), 1800)
    got = stitch.sessions_of(nightly.session_rows(state)).collect()
    want = stitch.batch_sessions(stitch_ready(canonical(rows)), 1800).collect()
    assert facts(got) == facts(want)
    assert len({r.batch_session_id for r in got}) == len(got)
    opened = {(r.user_id, r.first_time, r.open_day) for r in state.read("open", iv.OPEN).collect()}
    reach = timedelta(seconds=1801)
    assert opened == {(r.user_id, r.session_start, f"{d:%Y-%m-%d}") for r in got for n in range(1, 9)
                      for d in [r.session_start.date() + timedelta(days=n)] if d <= (r.session_end + reach).date()}


def stitch_ready(events):
    from tidemark.operators.events import dedup_events

    return dedup_events(events)


def test_gaps_of_whole_seconds_join_a_stored_session(spark, canonical, tmp_path):
    state = RunStore(spark, str(tmp_path / "state"))
    late = T0 + timedelta(hours=23, minutes=59, seconds=30.9)
    for when in (T0 + timedelta(days=1, minutes=29, seconds=30.95), late, T0 + timedelta(days=1, minutes=59, seconds=32)):
        state = nightly.take_in(spark, state, canonical([raw(when, "u", when, T0)]), 1800)
    assert sorted(r.event_count for r in state.read("sessions", iv.INTERVAL).collect()) == [1, 2]


def test_late_arrivals_reach_the_output_of_their_day(spark, make_events, tmp_path):
    """An event of the 14th that arrives at five in the morning of the 15th, and one two days late that bridges."""
    store, out = str(tmp_path / "raw"), str(tmp_path / "out")
    at = lambda h, m=0: T0 + timedelta(hours=h, minutes=m)
    write_events(make_events([
        raw(1, "u", at(10), at(10)), raw(2, "u", at(10, 50), at(10, 50)), raw(3, "u", at(10, 5), at(29)),
        raw(4, "v", at(30), at(30)), raw(5, "u", at(10, 27), at(53)), raw(2, "u", at(10, 50), at(54)),
    ]), store)
    for day in ("2024-10-14", "2024-10-15"):
        job.run(spark, store, out, day)
    read = lambda day: sorted((r.user_id, r.event_count) for r in source.stored_sessions(spark, out, day).collect())
    assert read("2024-10-14") == [("u", 1), ("u", 2)] and read("2024-10-15") == [("v", 1)]
    job.run(spark, store, out, "2024-10-16")
    assert read("2024-10-14") == [("u", 4)] and read("2024-10-15") == [("v", 1)] and read("2024-10-16") == []
    before = RunStore(spark, f"{out}-state").number
    job.run(spark, store, out, "2024-10-16")  # nothing new
    assert RunStore(spark, f"{out}-state").number == before and read("2024-10-14") == [("u", 4)]


def test_lost_runs(spark, make_events, tmp_path, monkeypatch):
    store, out = str(tmp_path / "raw"), str(tmp_path / "out")
    write_events(make_events([raw(1, "u", T0, T0), raw(2, "u", T0 + timedelta(minutes=9), T0 + timedelta(days=1, hours=5))]), store)
    job.run(spark, store, out, "2024-10-14")
    with monkeypatch.context() as lost:  # before the commit
        lost.setattr("tidemark.sinks.manifest.Change.commit", lambda self: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            job.run(spark, store, out, "2024-10-15")
    assert [r.event_count for r in RunStore(spark, f"{out}-state").read("sessions", iv.INTERVAL).collect()] == [1]
    with monkeypatch.context() as lost:  # between commit and output
        lost.setattr(nightly, "publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            job.run(spark, store, out, "2024-10-15")
    assert [r.event_count for r in source.stored_sessions(spark, out, "2024-10-14").collect()] == [1]
    job.run(spark, store, out, "2024-10-15")
    assert [r.event_count for r in source.stored_sessions(spark, out, "2024-10-14").collect()] == [2]


def test_manifest(spark, tmp_path):
    base = str(tmp_path / "store")
    rows = lambda *v: spark.createDataFrame([(x,) for x in v], "v string")
    schema = rows("a").schema
    store = RunStore(spark, base)
    assert store.number == 0 and store.read("t", schema).count() == 0
    first, other = store.change(), store.change()
    first.replace("t", rows("a", "b"), F.col("v"), ["a", "b", "c"])
    assert RunStore(spark, base).read("t", schema).count() == 0
    store = first.commit()
    assert store.parts("t") == ["a", "b"] and store.changed_since(0, "t") == ["a", "b", "c"]
    with pytest.raises(RuntimeError, match="another run"):
        other.commit()
    change = store.change()
    change.add("t", rows("a"), F.col("v"))
    change.replace("t2", rows(), F.col("v"), ["x"])
    store = change.commit()
    assert sorted(r.v for r in store.read("t", schema).collect()) == ["a", "a", "b"] and store.read("t", schema, ["b", "zz"]).count() == 1
    with pytest.raises(ValueError, match="outside"):
        store.change().replace("t", rows("z"), F.col("v"), ["a"])
    assert store.published() == 0
    store.mark_published()
    assert store.published() == 2 and not any(n.startswith("_") for n in os.listdir(f"{base}/manifests"))
