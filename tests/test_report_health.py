from pyspark.sql import functions as F

from tidemark.operators import health, report

BATCH = (
    "batch_session_id string, event_count bigint, cart_total double, conversion_value double, converted boolean,"
    " duration_seconds bigint, late_arrival_count bigint, had_restatement boolean, session_date date"
)
SPEED = (
    "session_id string, event_count bigint, cart_total double, conversion_value double, converted boolean,"
    " duration_seconds bigint, date_partition string"
)


def layers(spark):
    speed = spark.createDataFrame([
        ("s1", 3, 10.0, 90.0, True, 100, "2024-10-15"), ("s2", 1, 0.0, 0.0, False, 0, "2024-10-15"),
        ("s3", 1, 0.0, 0.0, False, 0, "2024-10-14"),
    ], SPEED)
    batch = spark.createDataFrame([
        ("u1_1", 4, 10.0, 100.0, True, 252, 1, True, None),
    ], BATCH).withColumn("session_date", F.lit("2024-10-15").cast("date"))
    return speed, batch


def test_comparison_per_day(spark):
    rows = report.accuracy_comparison(*layers(spark)).collect()
    assert [r.date for r in rows] == ["2024-10-15", "2024-10-14"]
    day = rows[0]
    assert (day.revenue_delta, day.revenue_error_pct) == (10.0, 10.0)
    assert (day.rt_conversion_rate_pct, day.batch_conversion_rate_pct) == (50.0, 100.0)
    assert (day.session_count_delta, day.pct_sessions_restated, day.total_late_arrivals) == (-1, 100.0, 1)
    assert rows[1].batch_total_sessions is None and rows[1].revenue_error_pct is None


def test_duplicate_snapshot_rows_count_once(spark):
    speed, _ = layers(spark)
    row = report.speed_totals(speed.unionByName(speed), "2024-10-15").collect()[0]
    assert (row.total_sessions, row.converted_sessions, row.total_events) == (2, 1, 8)


def test_single_expansion_free_plan(spark):
    plan = report.speed_summary(layers(spark)[0])._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_metrics_and_zero_guards(spark):
    speed, batch = layers(spark)
    stats = spark.createDataFrame([(1000, 35)], "total_sessions_compared bigint, sessions_restated bigint")
    row = report.report_metrics(
        report.speed_totals(speed, "2024-10-15"), report.batch_totals(batch, "2024-10-15"), stats).collect()[0]
    assert (row.restatement_pct, row.accuracy_pct, row.revenue_error_pct) == (3.5, 96.5, 10.0)
    assert (row.batch_duration_label, row.batch_revenue_label) == ("4m 12s", "$100.00")
    none = spark.createDataFrame([(0, 0)], "total_sessions_compared bigint, sessions_restated bigint")
    row = report.report_metrics(
        report.speed_totals(speed, "2020-01-01"), report.batch_totals(batch, "2020-01-01"), none).collect()[0]
    assert (row.restatement_pct, row.rt_conversion_rate_pct, row.revenue_error_pct) == (0.0, 0.0, 0.0)
    assert row.rt_duration_label == "0m 00s"


def test_metric_rows(spark):
    speed, batch = layers(spark)
    rows = {r.metric: (r.speed_layer, r.batch_layer) for r in report.metric_comparison(
        report.speed_totals(speed, "2024-10-15"), report.batch_totals(batch, "2024-10-15")).collect()}
    assert rows["total_sessions"] == (2.0, 1.0) and rows["total_revenue"] == (90.0, 100.0) and len(rows) == 6


def minutes(spark, values):
    rows = [(m, v) for m, v in values.items()]
    return spark.createDataFrame(rows, "m int, max_lag_ms bigint").select(
        F.timestamp_seconds(F.lit(1728986400) + F.col("m") * 60).alias("minute"), "max_lag_ms", "m")


def test_alarm_needs_consecutive_minutes(spark):
    high, low = 60001, 60000
    values = {0: high, 1: high, 2: high, 3: high, 4: low, 5: high, 6: high, 8: high, 9: high, 10: high}
    rows = minutes(spark, values).drop("m")
    found = {r.minute.minute: r.alarm for r in health.lag_alarm(rows).collect()}
    assert {m for m, alarm in found.items() if alarm} == {2, 3, 10}
    assert len(found) == len(values)


def test_error_rate_alarm(spark):
    rows = [(m, i < (2 if m != 3 else 1)) for m in range(7) for i in range(20)]
    df = spark.createDataFrame(rows, "m int, malformed boolean").select(
        F.timestamp_seconds(F.lit(1728986400) + F.col("m") * 60).alias("arrival_time"), "malformed")
    assert not any(r.alarm for r in health.error_rate_alarm(df).collect())
    alarms = {r.minute.minute for r in health.error_rate_alarm(df, minutes=3).collect() if r.alarm}
    assert alarms == {2, 6}


def test_rates_per_window(canonical, spark):
    df = canonical([
        {"event_time": "2024-10-15 10:00:00", "arrival_time": "2024-10-15 10:00:02"},
        {"event_time": "2024-10-15 09:50:00", "arrival_time": "2024-10-15 10:00:10", "is_late_arrival": True},
        {"event_time": "2024-10-15 11:00:00", "arrival_time": "2024-10-15 11:00:01"},
    ])
    hours = [(r.hour, r.total_events, r.late_count, r.late_pct) for r in health.late_rate_by_hour(df).collect()]
    assert hours == [(10, 2, 1, 50.0), (11, 1, 0, 0.0)]
    lag = health.lag_by_minute(df).orderBy("minute").collect()[0]
    assert (lag.max_lag_ms, lag.avg_lag_ms, lag.p50_lag_ms) == (610000, 306000.0, 2000.0)
    windows = health.throughput_by_window(df.withColumn("malformed", F.lit(False))).orderBy("window_start").collect()
    assert [(r.sent, r.late, r.per_second) for r in windows] == [(2, 1, 0.07), (1, 0, 0.03)]
