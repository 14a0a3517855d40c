import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import report, stitch
from tidemark.operators.events import late_events
from tidemark.operators.speed import speed_sessions
from tidemark.sinks import files as sink
from tidemark.sources import files as source
from tidemark.sources import tables

DAY = "2024-10-05"


@pytest.fixture
def rows(canonical):
    return canonical([
        {"event_time": f"2024-10-05 {h:02d}:10:00", "arrival_time": f"2024-10-05 {h:02d}:10:01", "is_late_arrival": h == 9,
         "event_type": "cart", "price": 1.5}
        for h in (8, 9, 23)
    ] + [{"event_time": "2024-10-06 00:05:00", "arrival_time": "2024-10-06 00:05:01"}])


def test_hour_folders_round_trip(spark, rows, tmp_path):
    base = str(tmp_path / "events")
    sink.write_events(rows, base)
    assert os.path.isdir(f"{base}/year=2024/month=10/day=05/hour=08")
    back = source.readable(source.raw_events(spark, base))
    assert back.count() == 4
    assert sorted(r.event_id for r in back.collect()) == ["e0000", "e0001", "e0002", "e0003"]
    day = source.readable(source.raw_events(spark, base, [DAY]))
    assert day.count() == 3 and day.select("hour").distinct().count() == 3
    assert source.readable(source.raw_events(spark, base, source.days_around(DAY, 0, 2))).count() == 4


def test_partition_filter_prunes(spark, rows, tmp_path):
    base = str(tmp_path / "events")
    sink.write_events(rows, base)
    df = source.raw_events(spark, base).filter("year = 2024 AND month = 10 AND day = 5 AND hour = 8")
    plan = df._jdf.queryExecution().executedPlan().toString()
    start = plan.index("PartitionFilters: [") + len("PartitionFilters: [")
    assert "hour" in plan[start:plan.index("]", start)] and df.count() == 1


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    folder = tmp_path / "events" / "year=2024" / "month=10" / "day=05" / "hour=08"
    folder.mkdir(parents=True)
    (folder / "a.ndjson").write_text('{"event_id": "e1", "price": "x"}\nNOT JSON {{{\n\n{"event_id": "e2"}\n')
    df = source.raw_events(spark, str(tmp_path / "events"), [DAY])
    assert sorted(r.event_id for r in source.readable(df).collect()) == ["e1", "e2"]
    assert source.readable(df).count() == 2
    assert df.filter(F.col(source.CORRUPT).isNotNull()).count() == 2


def test_batch_is_replaced_when_retried(spark, rows, tmp_path):
    base = str(tmp_path / "events")
    for _ in range(2):
        sink.write_events(rows, base, batch_id=7)
    sink.write_events(rows, base, batch_id=8)
    back = source.readable(source.raw_events(spark, base))
    assert {r.batch_id: r["count"] for r in back.groupBy("batch_id").count().collect()} == {7: 4, 8: 4}


def test_nothing_written_for_an_empty_batch(spark, rows, tmp_path):
    base = str(tmp_path / "events")
    sink.write_events(rows.limit(0), base, batch_id=1)
    assert not [d for d in (os.listdir(base) if os.path.isdir(base) else []) if d.startswith("year")]


def test_columnar_form_fills_required_members(spark, make_events, tmp_path):
    df = make_events([{"price": None, "is_late_arrival": None, "product_id": None, "late_arrival_delay_seconds": 5},
                      {"price": float("nan")}])
    sink.columnar_text(df).write.parquet(str(tmp_path / "p"))
    back = source.raw_events_parquet(spark, str(tmp_path / "p")).orderBy("event_id").collect()
    assert (back[0].price, back[0].is_late_arrival, back[0].product_id, back[0].late_arrival_delay_seconds) == (0.0, False, "", 5)
    assert back[1].price == 0.0


def test_sessions_day_is_replaced(spark, rows, tmp_path):
    base = str(tmp_path / "sessions")
    sessions = stitch.batch_sessions(rows)
    sink.write_sessions(sessions, base, DAY)
    sink.write_sessions(sessions.limit(1), base, DAY)
    sink.write_sessions(sessions, base, "2024-10-06")
    assert source.stored_sessions(spark, base, DAY).count() == 1
    stored = source.stored_sessions(spark, base)
    view = report.batch_sessions_view(stored)
    assert {str(r.session_date) for r in view.collect()} == {DAY, "2024-10-06"}
    plan = report.batch_totals(stored, DAY)._jdf.queryExecution().executedPlan().toString()
    start = plan.index("PartitionFilters: [") + len("PartitionFilters: [")
    assert "day" in plan[start:plan.index("]", start)]
    sink.write_sessions(sessions.limit(0), base, DAY)
    assert source.stored_sessions(spark, base).count() == sessions.count()


def test_snapshot_is_text_and_types_come_back(spark, rows, tmp_path):
    base = str(tmp_path / "realtime-sessions")
    state = speed_sessions(rows)
    sink.write_snapshot(state, base, DAY)
    text = source.snapshot_text(spark, base, DAY)
    assert {k for n, k in text.dtypes} == {"string"}
    line = json.loads(next(
        (tmp_path / "realtime-sessions" / f"date_partition={DAY}").glob("*.json")).read_text().splitlines()[0])
    assert all(isinstance(v, str) for v in line.values())
    typed = source.snapshot_typed(text).collect()[0]
    expected = state.collect()[0]
    assert (typed.rt_event_count, typed.rt_cart_total, typed.rt_converted) == (
        expected.event_count, expected.cart_total, expected.converted)


def test_bad_numbers_in_a_snapshot_become_null(spark):
    from tidemark.schemas import SPEED_SNAPSHOT
    df = spark.createDataFrame([("s1", "u1", "three", "1.5", "", "maybe", None, None, "60", "2024-10-05"),
                                ("s2", "u1", "3", "1.5", "0", "true", None, None, "60", None)], SPEED_SNAPSHOT)
    row = source.snapshot_typed(df).collect()[0]
    assert (row.rt_event_count, row.rt_cart_total, row.rt_converted, row.rt_duration_seconds) == (None, 1.5, None, 60)
    assert [r.session_id for r in report.realtime_sessions_view(df).collect()] == ["s1"]


def test_shop_csv(spark, tmp_path):
    (tmp_path / "shop.csv").write_text(
        "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"
        "2019-10-01 00:00:03 UTC,view,1,10,a.b,acme,5.5,u1,s1\n"
        "2019-10-01 00:00:01 UTC,CART ,2,10,,,bad,u1,s1\n"
        "2019-10-01 00:00:02 UTC,remove,3,10,,,1,u1,s1\n")
    rows = source.shop_csv(spark, str(tmp_path / "shop.csv"))
    assert rows.count() == 2
    first = source.shop_csv(spark, str(tmp_path / "shop.csv"), first=1).collect()
    assert [(r.event_type, r.price, r.brand) for r in first] == [("cart", 0.0, None)]


def test_catalog_tables(spark, rows, tmp_path):
    sink.write_events(rows, str(tmp_path / "events"))
    sink.write_events(late_events(rows), str(tmp_path / "late-arrivals"))
    sink.write_sessions(stitch.batch_sessions(rows), str(tmp_path / "sessions"), DAY)
    sink.write_snapshot(speed_sessions(rows), str(tmp_path / "realtime-sessions"), DAY)
    (tmp_path / "restatement-audit").mkdir()
    spark.sql(f"CREATE DATABASE layouts LOCATION '{tmp_path}/db'")
    try:
        tables.create_tables(spark, str(tmp_path), "layouts")
        count = {t: spark.table(f"layouts.{t}").count() for t in tables.LAYOUTS}
        assert count == {"raw_events": 4, "late_arrivals": 1, "batch_sessions": 4, "realtime_sessions_raw": 1,
                         "restatement_audit": 0}
        late = spark.sql("SELECT hour, count(*) n FROM layouts.raw_events WHERE day = 5 AND is_late_arrival GROUP BY hour")
        assert [(r.hour, r.n) for r in late.collect()] == [(9, 1)]
    finally:
        spark.sql("DROP DATABASE layouts CASCADE")


def test_summary_and_metric_files(spark, tmp_path):
    stats = spark.createDataFrame([(3, 1)], "total_sessions_compared bigint, sessions_restated bigint")
    sink.write_summary(stats, str(tmp_path / "audit"), DAY)
    files = list((tmp_path / "audit-summary" / "year=2024" / "month=10" / "day=05").glob("*.json"))
    assert len(files) == 1 and json.loads(files[0].read_text()) == {"total_sessions_compared": 3, "sessions_restated": 1}
    metrics = spark.createDataFrame([("b", 1.0, 2.0), ("a", 3.0, None)], "metric string, speed_layer double, batch_layer double")
    sink.write_metric_csv(metrics, str(tmp_path / "csv"))
    text = next((tmp_path / "csv").glob("*.csv")).read_text().splitlines()
    assert text == ["metric,speed_layer,batch_layer", "a,3.0,", "b,1.0,2.0"]


def test_merged_layouts(spark, make_events, tmp_path):
    df = make_events([{"brand": "x"}])
    df.drop("brand").write.parquet(str(tmp_path / "t" / "v=1"))
    df.write.parquet(str(tmp_path / "t" / "v=2"))
    assert sorted((r.brand or "") for r in source.merged_parquet(spark, str(tmp_path / "t")).collect()) == ["", "x"]


class NamedFolder:
    """A session that names the shared folder, as a cluster does."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return {"spark.checkpoint.dir": "/shared/place/"}.get(key, default)


def test_scratch_is_the_named_folder(spark):
    from tidemark import session

    assert session.scratch_dir(NamedFolder) == "/shared/place"
    assert session.scratch_path(NamedFolder, "x").startswith("/shared/place/x-")
    assert session.scratch_dir(spark) == session.scratch_dir(spark) != "/shared/place"
    assert session.shuffle_partitions(0, 8) == 8
    assert session.shuffle_partitions(100 * 2**40, 4000) == 819200
