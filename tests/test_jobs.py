import json
import os
import shutil
from datetime import datetime, timedelta

from test_quarantine import b64, event, record
from test_streaming import write_batch
from tidemark.plans import audit, live, replay, report, stitch
from tidemark.sinks.files import write_events
from tidemark.sources import files as source
from tidemark.sources import tables

DAY = "2024-10-15"


def ev(i, clock, arrived=None, **more):
    return event(f"e{i}", event_time=f"2024-10-15T{clock}+00:00", arrival_time=f"2024-10-15T{arrived or clock}+00:00", **more)


def test_whole_chain(spark, tmp_path):
    """Lines to stores and state, snapshot, stitch, audit, report, replay."""
    root, lines = str(tmp_path / "root"), str(tmp_path / "lines")
    write_batch(lines, 0, [
        ev(1, "10:00:00"), ev(2, "10:05:00", event_type="cart", price=49.99), "NOT VALID JSON {{{",
        ev(8, "23:50:00", session_id="night"),
    ])
    write_batch(lines, 1, [
        ev(3, "10:02:00", "10:12:00", event_type="cart", price=50.0, is_late_arrival=True, late_arrival_delay_seconds=600),
        ev(2, "10:05:00", event_type="cart", price=49.99),
        event("e9", event_time="2024-10-16T00:10:00+00:00", arrival_time="2024-10-16T00:10:01+00:00", session_id="night"),
    ])
    for query in live.start(spark, lines, root, str(tmp_path / "cp"), available_now=True):
        assert query.awaitTermination(240)
    live.export_snapshot(spark, root, DAY)

    stitch.run(spark, f"{root}/events", f"{root}/sessions", DAY)
    sessions = {r.session_start.hour: r for r in source.stored_sessions(spark, f"{root}/sessions", DAY).collect()}
    assert (sessions[10].event_count, sessions[10].cart_total, sessions[10].late_arrival_count) == (3, 99.99, 1)
    assert sessions[23].event_count == 2
    stitch.run(spark, f"{root}/events", f"{root}/cut", DAY, before_hours=0, after_hours=0)
    assert sorted(r.event_count for r in source.stored_sessions(spark, f"{root}/cut", DAY).collect()) == [1, 3]

    kinds = audit.run(spark, f"{root}/sessions", root, f"{root}/restatement-audit", DAY).collect()
    assert {r.restatement_type: r.session_count for r in kinds} == {"revenue_restatement": 1, "no_restatement": 1}
    folder = f"{root}/restatement-audit-summary/year=2024/month=10/day=15"
    name = next(f for f in os.listdir(folder) if f.endswith(".json"))
    with open(f"{folder}/{name}") as f:
        assert json.load(f)["total_revenue_restated"] == 50.0

    row = report.run(spark, f"{root}/sessions", root, f"{root}/restatement-audit", DAY, str(tmp_path / "csv")).collect()[0]
    assert (row.restatement_pct, row.accuracy_pct) == (50.0, 50.0)

    letters = tmp_path / "letters"
    letters.mkdir()
    body = json.dumps({"Records": [record(b64(json.dumps(ev(20, "10:06:00"))))]})
    (letters / "a.json").write_text(json.dumps({"message_id": "m1", "body": body}) + "\n"
                                    + json.dumps({"message_id": "m2", "body": "junk"}) + "\n")
    ledger = str(tmp_path / "ledger")

    def counts(live_run):
        return replay.run(spark, str(letters), root, ledger, live_run).collect()[0].asDict()

    def stored():
        return source.readable(source.raw_events(spark, f"{root}/events")).count()

    before = stored()
    assert counts(False) == {"replayed": 1, "skipped": 1, "deleted": 0} and stored() == before
    assert counts(True) == {"replayed": 1, "skipped": 1, "deleted": 1} and stored() == before + 1
    assert counts(True) == {"replayed": 0, "skipped": 1, "deleted": 0} and stored() == before + 1
    # another letter of the same hour: its replay leaves the first one alone
    body = json.dumps({"Records": [record(b64(json.dumps(ev(21, "10:07:00"))))]})
    (letters / "b.json").write_text(json.dumps({"message_id": "m3", "body": body}) + "\n")
    assert counts(True) == {"replayed": 1, "skipped": 1, "deleted": 1} and stored() == before + 2
    # a replay that was lost before its ledger entry comes back under its number
    shutil.rmtree(ledger)
    assert counts(True)["replayed"] == 2 and stored() == before + 2

    spark.sql("CREATE DATABASE IF NOT EXISTS routed")
    for name, folder in (("raw_events", "events"), ("late_arrivals", "late-arrivals")):
        spark.sql(f"DROP TABLE IF EXISTS routed.{name}")
        tables.create_table(spark, name, root, "routed", batches=True)
        by_path = source.readable(source.raw_events(spark, f"{root}/{folder}")).select("event_id").collect()
        by_table = spark.table(f"routed.{name}").select("event_id").collect()
        assert sorted(r.event_id for r in by_table) == sorted(r.event_id for r in by_path) and by_path

    live.export_snapshot(spark, root, "2024-10-16")
    assert {r.session_id for r in source.snapshot_text(spark, f"{root}/realtime-sessions").filter("date_partition = '2024-10-16'").collect()} == set()


def test_sessions_over_many_days_are_whole_in_one_output(spark, make_events, tmp_path):
    """A user who never pauses for two days, one who crosses one midnight, and
    one within a day: run night by night, with the next day's events not there yet."""
    start = datetime(2024, 10, 14, 22)
    rows = [("long", start + timedelta(minutes=20 * i)) for i in range(150)]
    rows += [("night", start + timedelta(minutes=m)) for m in (100, 125, 150)] + [("day", start + timedelta(hours=16))]
    rows = [(f"e{i}", *r) for i, r in enumerate(rows)]
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    days = sorted({t.date().isoformat() for _, _, t in rows})
    assert len(days) == 3
    for day in days:
        today = [{"event_id": i, "user_id": u, "session_id": f"{u}-{t:%d%H}", "event_time": f"{t:%Y-%m-%d %H:%M:%S}", "arrival_time": f"{t:%Y-%m-%d %H:%M:%S}"} for i, u, t in rows if t.date().isoformat() == day]
        write_events(make_events(today), raw)
        stitch.run(spark, raw, out, day)
    got = [(r.session_date.isoformat(), r.user_id, r.event_count) for d in days for r in source.stored_sessions(spark, out, d).collect()]
    assert sorted(got) == [("2024-10-14", "long", 150), ("2024-10-14", "night", 3), ("2024-10-15", "day", 1)]
