import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.money import lenient_number, safe_price
from tidemark.functions.times import duration_label
from tidemark.operators import events as ev
from tidemark.schemas import SHOP_CSV


def test_safe_price(spark):
    values = [None, float("nan"), -10.0, 0.0, 12.5, float("inf")]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, price double")
    assert [r[0] for r in rows.orderBy("i").select(safe_price("price")).collect()] == [0, 0, 0, 0, 12.5, float("inf")]
    text = spark.createDataFrame([("3.5",), ("abc",), ("",), (None,)], "price string")
    assert [r[0] for r in text.select(safe_price("price")).collect()] == [3.5, 0, 0, 0]


def test_large_prices_are_added_and_endless_ones_reported(spark, make_events):
    from pyspark.sql import functions as F

    from tidemark.functions.money import as_double, price_if

    values = [1e9, 4e12, 0.123456, 1e21, 1e22, float("inf")]
    rows = make_events([{"price": v} for v in values])
    assert rows.agg(as_double(F.sum(price_if("price < 1e20")))).first()[0] == 4001000000000.123456
    broken = {r.price: r.reasons for r in ev.schema_violations(rows, check_formats=False).collect()}
    assert [v for v in values if "price_too_large" in broken.get(v, [])] == [1e22, float("inf")]


def test_canonical_cleans_and_types(canonical):
    row = canonical([{
        "event_time": "2024-10-15T10:00:00Z", "event_type": "  CART ", "category_id": "", "category_code": "NaN",
        "brand": "nan", "price": None, "is_late_arrival": None,
    }]).collect()[0]
    assert row.event_type == "cart"
    assert (row.category_id, row.category_code, row.brand) == (None, None, None)
    assert (row.price, row.is_late_arrival) == (0.0, False)
    assert row.event_time == row.effective_time


@pytest.mark.parametrize("text", [
    "2024-10-15T10:00:00Z", "2024-10-15T10:00:00+00:00", "2024-10-15T12:00:00+02:00",
    "2024-10-15 10:00:00", "2024-10-15 10:00:00 UTC",
])
def test_time_forms(canonical, text):
    row = canonical([{"event_time": text}]).select(F.unix_seconds("effective_time").alias("s")).collect()[0]
    assert row.s == 1728986400


def test_bad_time_text_is_null_not_an_error(canonical):
    row = canonical([{"event_time": "soon", "arrival_time": "never"}])
    assert row.collect()[0].effective_time is None
    assert ev.timed_events(row).count() == 0


def test_unknown_types_are_dropped(canonical):
    assert canonical([{"event_type": "remove"}, {"event_type": None}, {"event_type": "view"}]).count() == 1


def test_shop_log_rows(spark):
    row = ("2019-10-01 00:00:00 UTC", "view", "44600062", "2103807459595387724", None, "shiseido", "35.79", "541312140", "s-1")
    out = ev.canonical_events(spark.createDataFrame([row], SHOP_CSV)).collect()[0]
    assert (out.session_id, out.price, out.user_id) == ("s-1", 35.79, "541312140")
    assert len(out.event_id) == 64 and out.arrival_time == out.event_time
    again = ev.canonical_events(spark.createDataFrame([row], SHOP_CSV)).collect()[0]
    assert again.event_id == out.event_id


def test_valid_events_and_counts(spark, make_events):
    df = make_events([{}, {"user_id": None}, {"session_id": None}, {"user_id": None, "session_id": None}])
    assert ev.valid_events(df).count() == 1
    assert ev.invalid_event_counts(df).collect()[0].asDict() == {
        "total": 4, "without_user": 2, "without_session": 2, "dropped": 3}


def test_observed_counts(make_events):
    from pyspark.sql import Observation

    seen = Observation("valid")
    missing = F.col("user_id").isNull() | F.col("session_id").isNull()
    df = make_events([{}, {"user_id": None}]).observe(seen, F.count_if(missing).alias("dropped"))
    ev.valid_events(df).collect()
    assert seen.get == {"dropped": 1}
    assert ev.observed_valid_events(make_events([{}, {"user_id": None}]), "n").count() == 1


def test_contract_violations(make_events):
    good = "123e4567-e89b-12d3-a456-426614174000"
    df = make_events([
        {"event_id": good},
        {"event_id": good, "price": -1.0, "event_type": "zoom"},
        {"event_id": "x", "event_time": "soon", "late_arrival_delay_seconds": -5},
        {"event_id": good, "price": float("nan"), "session_id": None},
    ])
    found = [r.reasons for r in ev.schema_violations(df).collect()]
    assert found == [
        ["event_type_unknown", "price_negative"],
        ["delay_negative", "event_id_format", "event_time_format"],
        ["session_id_missing", "price_not_a_number"],
    ]
    assert ev.schema_conforming(df).count() == 1
    assert ev.schema_violations(df, check_formats=False).count() == 3


def test_late_split_treats_null_as_on_time(make_events):
    df = make_events([{"is_late_arrival": True}, {"is_late_arrival": False}, {"is_late_arrival": None}])
    assert (ev.late_events(df).count(), ev.on_time_events(df).count()) == (1, 2)


def test_late_by_threshold(make_events):
    df = make_events([
        {"event_time": "2024-10-15 10:00:00", "arrival_time": "2024-10-15 10:05:00"},
        {"event_time": "2024-10-15 10:00:00", "arrival_time": "2024-10-15 10:05:01"},
    ])
    assert [r.is_late_arrival for r in ev.flag_late_by_threshold(df).collect()] == [False, True]


def test_mark_late(spark, make_events):
    df = make_events([{}]).drop("event_id").crossJoin(
        spark.range(20000).select(F.concat(F.lit("e"), F.col("id").cast("string")).alias("event_id")))
    marked = ev.mark_late(df, 0.05, seed=1)
    row = marked.agg(
        F.avg(F.col("is_late_arrival").cast("int")).alias("share"),
        F.min("late_arrival_delay_seconds").alias("low"), F.max("late_arrival_delay_seconds").alias("high"),
        F.count_if(F.col("is_late_arrival") != F.col("late_arrival_delay_seconds").isNotNull()).alias("bad"),
    ).collect()[0]
    assert 0.04 < row.share < 0.06
    assert 120 <= row.low and row.high <= 900 and row.bad == 0
    again = ev.mark_late(df, 0.05, seed=1)
    assert marked.exceptAll(again).count() == 0
    assert ev.late_events(ev.mark_late(df, 0.0)).count() == 0
    assert ev.late_events(ev.mark_late(df, 1.0)).count() == 20000
    with pytest.raises(ValueError):
        ev.mark_late(df, 1.5)


def test_payload_limit(make_events):
    df = make_events([{"brand": "x" * 50}, {"brand": "x" * 5000}])
    assert ev.within_payload_limit(df, 1000).count() == 1
    assert ev.within_payload_limit(df).count() == 2


def test_dedup_keeps_first_delivery_whole(make_events):
    df = make_events([
        {"event_id": "a", "arrival_time": "2024-10-15 10:00:05", "price": 1.0},
        {"event_id": "a", "arrival_time": "2024-10-15 10:00:01", "price": 2.0},
        {"event_id": "a", "arrival_time": "2024-10-15 10:00:01", "price": 2.0},
        {"event_id": "b"},
    ])
    rows = {r.event_id: r for r in ev.dedup_events(df).collect()}
    assert len(rows) == 2 and rows["a"].price == 2.0 and ev.dedup_events(df).columns == df.columns


def test_union_counts_overlap_once(make_events):
    df = make_events([{"is_late_arrival": True}, {}])
    assert ev.union_all_events(df, ev.late_events(df)).count() == 2


def test_merged_schema(spark):
    old = spark.createDataFrame([("a",)], "event_id string")
    new = spark.createDataFrame([("b", "x")], "event_id string, brand string")
    assert sorted(map(tuple, ev.merged_schema(old, new).collect())) == [("a", None), ("b", "x")]


def test_labels(spark):
    df = spark.createDataFrame([(252.0,), (59.9,), (3600.0,)], "s double")
    assert [r[0] for r in df.select(duration_label(F.col("s"))).collect()] == ["4m 12s", "0m 59s", "60m 00s"]
    text = spark.createDataFrame([("4.5",), ("",), ("n/a",), (None,)], "v string")
    assert [r[0] for r in text.select(lenient_number(F.col("v"))).collect()] == [4.5, 0.0, 0.0, 0.0]


def test_hour_partitions(canonical):
    row = ev.with_hour_partitions(canonical([{"arrival_time": "2024-10-05T09:15:00Z"}])).collect()[0]
    assert (row.year, row.month, row.day, row.hour) == (2024, 10, 5, 9)


def test_no_shuffle_in_event_operators(canonical):
    df = ev.with_hour_partitions(ev.mark_late(ev.on_time_events(ev.valid_events(canonical([{}])))))
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert isinstance(df.schema["price"].dataType, T.DoubleType)
