"""The same results in plain SQL, written for DuckDB from the definitions of
the queries: one window over all events of a key, one full outer join. None of
the cells, slices or two-step counts of the operators appear here."""

from __future__ import annotations

HOUR6 = 21600

RAW = """
raw AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, event_id AS n, ts AS event_time,
         ts + to_seconds(CASE WHEN (event_id * 7919 + 13) % 100 < 5
                              THEN 120 + (event_id * 104729 + 7) % 781 ELSE 1 END) AS arrival_time,
         CASE WHEN event_type = 'click' THEN 'cart' ELSE event_type END AS event_type,
         regexp_extract(props, '([0-9]+)', 1) AS product_id,
         value AS price, CAST(user_id AS VARCHAR) AS user_id,
         's' || user_id || '_' || (epoch_us(ts) // 21600000000) AS session_id,
         (event_id * 7919 + 13) % 100 < 5 AS is_late,
         CASE WHEN (event_id * 7919 + 13) % 100 < 5
              THEN 120 + (event_id * 104729 + 7) % 781 END AS delay
  FROM events
)"""

EV = RAW + """,
ev AS (SELECT *, epoch_us(event_time) AS us, epoch_us(event_time) // 1000000 AS s
       FROM raw WHERE event_type IN ('view', 'cart', 'purchase'))"""


def money(kind: str) -> str:
    return f"SUM(CASE WHEN event_type = '{kind}' THEN CAST(price AS DECIMAL(18,4)) ELSE 0 END)"


def stitched(timeout: int) -> str:
    return f""",
gaps AS (SELECT *, lag(us) OVER w AS prev_us, lag(s) OVER w AS prev_s
         FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)),
flagged AS (SELECT *, CASE WHEN prev_s IS NULL OR s - prev_s > {timeout} THEN 1 ELSE 0 END AS opens FROM gaps),
numbered AS (SELECT *, SUM(opens) OVER (PARTITION BY user_id ORDER BY us, event_id
                                        ROWS UNBOUNDED PRECEDING)::BIGINT AS seq FROM flagged),
batch AS (
  SELECT user_id || '_' || seq AS batch_session_id, user_id, MIN(us) AS session_start, MAX(us) AS session_end,
         COUNT(*) AS event_count, CAST({money('cart')} AS DOUBLE) AS cart_total,
         CAST({money('purchase')} AS DOUBLE) AS conversion_value, bool_or(event_type = 'purchase') AS converted,
         MAX(s) - MIN(s) AS duration_seconds, COUNT(*) FILTER (WHERE is_late) AS late_arrival_count,
         COUNT(*) FILTER (WHERE is_late) > 0 AS had_restatement,
         strftime(MIN(event_time), '%Y-%m-%d') AS session_date,
         string_agg(DISTINCT session_id, ',' ORDER BY session_id) AS original_session_ids
  FROM numbered GROUP BY user_id, seq),
links AS (
  SELECT DISTINCT n.session_id, b.batch_session_id, b.cart_total AS batch_cart_total,
         b.conversion_value AS batch_conversion_value, b.event_count AS batch_event_count,
         b.converted AS batch_converted, b.duration_seconds AS batch_duration_seconds,
         b.late_arrival_count, b.had_restatement, b.session_date AS batch_session_date
  FROM numbered n JOIN batch b ON b.batch_session_id = n.user_id || '_' || n.seq)"""


def live(timeout: int) -> str:
    return f""",
sgaps AS (SELECT *, us - lag(us) OVER (PARTITION BY session_id ORDER BY us, event_id) AS gap
          FROM ev WHERE NOT is_late),
scut AS (SELECT *, SUM(CASE WHEN gap > {timeout}000000 THEN 1 ELSE 0 END)
           OVER (PARTITION BY session_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS segment FROM sgaps),
segments AS (
  SELECT session_id, segment, MAX(user_id) AS user_id, COUNT(*) AS event_count,
         round(CAST({money('cart')} AS DOUBLE), 2) AS cart_total,
         round(CAST({money('purchase')} AS DOUBLE), 2) AS conversion_value,
         bool_or(event_type = 'purchase') AS converted, MIN(us) AS session_start, MAX(us) AS last_event_time,
         MAX(CASE WHEN event_type = 'purchase' THEN us END) AS conversion_time,
         MAX(s) - MIN(s) AS duration_seconds,
         string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS event_types_seen,
         strftime(MIN(event_time), '%Y-%m-%d') AS date_partition
  FROM scut GROUP BY session_id, segment),
speed AS (SELECT * EXCLUDE (segment) FROM segments
          QUALIFY segment = MAX(segment) OVER (PARTITION BY session_id))"""


RT = """,
rt AS (SELECT session_id, cart_total AS rt_cart_total, conversion_value AS rt_conversion_value,
              event_count AS rt_event_count, converted AS rt_converted,
              duration_seconds AS rt_duration_seconds, date_partition FROM speed)"""


def both(timeout: int) -> str:
    return EV + stitched(timeout) + live(timeout) + RT


def audit(timeout: int) -> str:
    return both(timeout) + """,
audit AS (
  SELECT session_id, batch_session_id, batch_cart_total, batch_event_count, batch_converted, had_restatement,
         batch_session_date, rt_cart_total, rt_event_count, rt_converted,
         abs(coalesce(batch_cart_total, 0) - coalesce(rt_cart_total, 0)) AS revenue_discrepancy,
         abs(coalesce(batch_event_count, 0) - coalesce(rt_event_count, 0)) AS event_count_discrepancy
  FROM links FULL OUTER JOIN rt USING (session_id))"""


def deltas(timeout: int, flip_first: bool = False) -> str:
    count = "WHEN event_count_delta <> 0 THEN 'event_count_restatement'"
    flip = "WHEN conversion_flipped THEN 'conversion_flip'"
    order = f"{flip} {count}" if flip_first else f"{count} {flip}"
    return both(timeout) + f""",
joined AS (
  SELECT *, round(coalesce(batch_cart_total, 0) - coalesce(rt_cart_total, 0), 2) AS cart_total_delta,
         abs(round(coalesce(batch_cart_total, 0) - coalesce(rt_cart_total, 0), 2)) AS cart_total_abs_delta,
         coalesce(batch_event_count, 0) - coalesce(rt_event_count, 0) AS event_count_delta,
         batch_converted <> rt_converted AS conversion_flipped,
         CASE WHEN batch_session_id IS NULL THEN 'speed_only' WHEN rt_event_count IS NULL THEN 'batch_only'
              ELSE 'both' END AS presence
  FROM links FULL OUTER JOIN rt USING (session_id)),
deltas AS (
  SELECT *, CASE WHEN session_id IS NULL THEN 'new_in_batch' WHEN rt_cart_total IS NULL THEN 'missing_in_realtime'
                 WHEN cart_total_abs_delta > 0.01 THEN 'revenue_restatement' {order}
                 ELSE 'no_restatement' END AS restatement_type FROM joined)"""


def money_sum(column: str) -> str:
    return f"CAST(SUM(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


STATS = f"""
SELECT COUNT(*) AS total_sessions_compared,
       COUNT(*) FILTER (WHERE restatement_type <> 'no_restatement') AS sessions_restated,
       {money_sum('cart_total_abs_delta')} / COUNT(cart_total_abs_delta) AS avg_revenue_discrepancy,
       MAX(cart_total_abs_delta) AS max_revenue_discrepancy,
       {money_sum('cart_total_abs_delta')} AS total_revenue_restated,
       AVG(event_count_delta) AS avg_event_count_discrepancy,
       COUNT(*) FILTER (WHERE restatement_type = 'conversion_flip') AS conversion_flips,
       COUNT(*) FILTER (WHERE restatement_type = 'new_in_batch') AS new_sessions_in_batch,
       COUNT(*) FILTER (WHERE conversion_flipped) AS sessions_with_changed_conversion
FROM deltas"""

BREAKDOWN = f"""
SELECT restatement_type, COUNT(*) AS session_count, {money_sum('cart_total_abs_delta')} AS total_revenue_impact
FROM deltas GROUP BY restatement_type"""

AUDIT_TOTALS = f"""
SELECT COUNT(*) AS total_sessions_compared, COUNT(*) FILTER (WHERE had_restatement) AS sessions_restated,
       {money_sum('revenue_discrepancy')} / COUNT(revenue_discrepancy) AS avg_revenue_discrepancy,
       MAX(revenue_discrepancy) AS max_revenue_discrepancy,
       {money_sum('revenue_discrepancy')} AS total_revenue_restated,
       AVG(event_count_discrepancy) AS avg_event_count_discrepancy
FROM audit"""


def share(part: str, whole: str) -> str:
    """part of whole in percent, two digits; no value where whole is 0."""
    return f"round(CASE WHEN {whole} <> 0 THEN CAST({part} AS DOUBLE) / {whole} * 100 END, 2)"


def totals(prefix: str, key: str) -> str:
    return f"""
       COUNT(DISTINCT {key}) AS {prefix}total_sessions,
       CAST(SUM(CAST(cart_total AS DECIMAL(18,4))) AS DOUBLE) AS {prefix}total_cart_value,
       CAST(SUM(CAST(conversion_value AS DECIMAL(18,4))) AS DOUBLE) AS {prefix}total_revenue,
       CAST(SUM(event_count) AS BIGINT) AS {prefix}total_events,
       COUNT(DISTINCT {key}) FILTER (WHERE converted) AS {prefix}converted_sessions"""


SPEED_DAYS = f"""
SELECT date_partition AS date, {totals('rt_', 'session_id')}, AVG(duration_seconds) AS rt_avg_duration_seconds
FROM speed GROUP BY date_partition"""

BATCH_DAYS = f"""
SELECT session_date AS date, {totals('batch_', 'batch_session_id')},
       AVG(duration_seconds) AS batch_avg_duration_seconds,
       COUNT(*) FILTER (WHERE had_restatement) AS sessions_restated,
       CAST(SUM(late_arrival_count) AS BIGINT) AS total_late_arrivals
FROM batch GROUP BY session_date"""

COMPARISON = f""",
ss AS ({SPEED_DAYS}), bs AS ({BATCH_DAYS})
SELECT coalesce(ss.date, bs.date) AS date, rt_total_sessions, batch_total_sessions,
       batch_total_sessions - rt_total_sessions AS session_count_delta,
       round(rt_total_revenue, 2) AS rt_revenue, round(batch_total_revenue, 2) AS batch_revenue,
       round(batch_total_revenue - rt_total_revenue, 2) AS revenue_delta,
       {share('abs(batch_total_revenue - rt_total_revenue)', 'batch_total_revenue')} AS revenue_error_pct,
       {share('rt_converted_sessions', 'rt_total_sessions')} AS rt_conversion_rate_pct,
       {share('batch_converted_sessions', 'batch_total_sessions')} AS batch_conversion_rate_pct,
       round(rt_avg_duration_seconds, 0) AS rt_avg_duration_seconds,
       round(batch_avg_duration_seconds, 0) AS batch_avg_duration_seconds,
       sessions_restated,
       {share('sessions_restated', 'batch_total_sessions')} AS pct_sessions_restated,
       total_late_arrivals, '< 30 seconds' AS speed_layer_latency, '~ 8 hours' AS batch_layer_latency
FROM ss FULL OUTER JOIN bs ON ss.date = bs.date"""

DAY = "2024-01-15"
SPEED_DAY = f"""SELECT {totals('', 'session_id')}, AVG(duration_seconds) AS avg_session_duration_seconds
FROM speed WHERE date_partition = '{DAY}'"""
BATCH_DAY = f"""SELECT {totals('', 'batch_session_id')}, AVG(duration_seconds) AS avg_session_duration_seconds
FROM batch WHERE session_date = '{DAY}'"""

METRICS = ("total_sessions", "total_cart_value", "total_revenue", "total_events", "converted_sessions",
           "avg_session_duration_seconds")
METRIC_ROWS = f""",
st AS ({SPEED_DAY}), bt AS ({BATCH_DAY})
""" + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, CAST(st.{m} AS DOUBLE) AS speed_layer, CAST(bt.{m} AS DOUBLE) AS batch_layer FROM st, bt"
    for m in METRICS
)


def label(x: str) -> str:
    return f"(CAST(floor({x} / 60) AS BIGINT) || 'm ' || lpad(CAST(CAST(floor({x}) AS BIGINT) % 60 AS VARCHAR), 2, '0') || 's')"


REPORT = f""",
st AS ({SPEED_DAY}), bt AS ({BATCH_DAY}), au AS ({STATS} WHERE batch_session_date = '{DAY}')
SELECT round(st.converted_sessions::DOUBLE / st.total_sessions * 100, 2) AS rt_conversion_rate_pct,
       round(bt.converted_sessions::DOUBLE / bt.total_sessions * 100, 2) AS batch_conversion_rate_pct,
       {label('st.avg_session_duration_seconds')} AS rt_duration_label,
       {label('bt.avg_session_duration_seconds')} AS batch_duration_label,
       round(au.sessions_restated::DOUBLE / au.total_sessions_compared * 100, 2) AS restatement_pct,
       round(100.0::DOUBLE - au.sessions_restated::DOUBLE / au.total_sessions_compared * 100, 2) AS accuracy_pct,
       round(abs(bt.total_revenue - st.total_revenue) / bt.total_revenue * 100, 2) AS revenue_error_pct,
       '$' || format('{{:,.2f}}', st.total_revenue) AS rt_revenue_label,
       '$' || format('{{:,.2f}}', bt.total_revenue) AS batch_revenue_label
FROM st, bt, au"""

# --- rows with planted faults ----------------------------------------------------
DIRTY = RAW + """,
dirty AS (
  SELECT CASE WHEN n % 211 = 0 THEN event_id ELSE
           substr(md5(event_id), 1, 8) || '-' || substr(md5(event_id), 9, 4) || '-' || substr(md5(event_id), 13, 4)
           || '-' || substr(md5(event_id), 17, 4) || '-' || substr(md5(event_id), 21, 12) END AS event_id,
         CASE WHEN n % 89 <> 0 AND n % 83 <> 0 THEN event_time END AS event_time,
         n % 89 = 0 AS bad_time,
         arrival_time,
         CASE WHEN n % 5 = 0 THEN '  ' || upper(event_type) || ' ' ELSE event_type END AS event_type,
         CASE WHEN n % 109 <> 0 THEN product_id END AS product_id,
         CASE WHEN n % 3 <> 0 AND CAST(product_id AS INT) % 7 <> 0 THEN 'brand' || product_id END AS brand,
         CAST(CAST(product_id AS INT) % 10 AS VARCHAR) AS category_id,
         CASE WHEN n % 101 = 0 THEN NULL WHEN n % 103 = 0 THEN 'NaN'::DOUBLE WHEN n % 107 = 0 THEN -price ELSE price END AS price,
         CASE WHEN n % 113 <> 0 THEN user_id END AS user_id,
         CASE WHEN n % 127 <> 0 THEN session_id END AS session_id,
         CASE WHEN n % 131 <> 0 THEN is_late END AS is_late,
         CASE WHEN n % 137 = 0 THEN -1 ELSE delay END AS delay
  FROM raw)"""

CLEAN_PRICE = "CASE WHEN price IS NULL OR isnan(price) OR price < 0 THEN 0.0 ELSE price END"

_RULES = [
    ("product_id_missing", "product_id IS NULL"),
    ("price_missing", "price IS NULL"),
    ("user_id_missing", "user_id IS NULL"),
    ("session_id_missing", "session_id IS NULL"),
    ("is_late_arrival_missing", "is_late IS NULL"),
    ("event_type_unknown", "event_type NOT IN ('view', 'cart', 'purchase')"),
    ("price_not_a_number", "isnan(price)"),
    ("price_negative", "price < 0"),
    ("delay_negative", "delay < 0"),
    ("event_id_format", "length(event_id) <> 36"),
    ("event_time_format", "bad_time"),
]
REASONS = "concat_ws(',', " + ", ".join(f"CASE WHEN {rule} THEN '{name}' END" for name, rule in _RULES) + ")"

ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%S.%fZ')"

# --- stream records ----------------------------------------------------------------
RECORDS = RAW + """,
records AS (SELECT *, n % 97 = 0 OR n % 59 = 0 AS broken, 'seq' || n AS sequence,
                   epoch_us(arrival_time) / 1e6 AS arrival FROM raw),
letters AS (SELECT *, n // 4 AS letter,
                   n // 4 % 31 = 0 AS unreadable, n // 4 % 31 <> 0 AND n // 4 % 29 = 0 AS batch_info FROM records),
letter_counts AS (SELECT letter, COUNT(*) FILTER (WHERE NOT broken AND NOT unreadable AND NOT batch_info) AS events
                  FROM letters GROUP BY letter)"""


def alarm(source: str, breach: str, needed: int, columns: str) -> str:
    return f"""
SELECT minute, {columns}, COUNT(*) FILTER (WHERE {breach}) OVER (
         ORDER BY minute RANGE BETWEEN {(needed - 1) * 60000000} PRECEDING AND CURRENT ROW) = {needed} AS alarm
FROM {source}"""


MINUTE = "epoch_us(date_trunc('minute', arrival_time))"
LAGS = f"""
SELECT {MINUTE} AS minute, COUNT(*) AS event_count, MAX(lag_ms) AS max_lag_ms, AVG(lag_ms) AS avg_lag_ms,
       CAST(quantile_disc(lag_ms, 0.5) AS DOUBLE) AS p50_lag_ms, CAST(quantile_disc(lag_ms, 0.99) AS DOUBLE) AS p99_lag_ms
FROM (SELECT arrival_time, (epoch_us(arrival_time) // 1000000 - epoch_us(event_time) // 1000000) * 1000 AS lag_ms FROM raw)
GROUP BY 1"""

ALL = {
    # sources
    "raw_events_scan": f"""WITH {RAW}
SELECT CAST(year(arrival_time) AS INT) AS year, CAST(month(arrival_time) AS INT) AS month, CAST(day(arrival_time) AS INT) AS day,
       COUNT(*) AS events, COUNT(*) FILTER (WHERE is_late) AS late, COUNT(DISTINCT event_id) AS ids,
       CAST(SUM(CAST(price AS DECIMAL(18,4))) AS DOUBLE) AS value FROM raw GROUP BY 1, 2, 3""",
    "raw_events_day": f"""WITH {RAW}
SELECT event_id, event_type, price, user_id, session_id, CAST(hour(arrival_time) AS INT) AS hour, is_late AS is_late_arrival
FROM raw WHERE strftime(arrival_time, '%Y-%m-%d') = '{DAY}'""",
    "late_arrivals_table": f"""WITH {RAW}
SELECT event_id, event_type, user_id, delay AS late_arrival_delay_seconds, CAST(year(arrival_time) AS INT) AS year,
       CAST(month(arrival_time) AS INT) AS month, CAST(day(arrival_time) AS INT) AS day, CAST(hour(arrival_time) AS INT) AS hour
FROM raw WHERE is_late""",
    "realtime_snapshot_typed": f"""WITH {EV}{live(1800)}
SELECT session_id, session_start, last_event_time, date_partition, event_count AS rt_event_count,
       cart_total AS rt_cart_total, conversion_value AS rt_conversion_value, converted AS rt_converted,
       duration_seconds AS rt_duration_seconds FROM speed""",
    "csv_events_scan": f"""WITH {EV}, shop AS (SELECT *, strftime(event_time, '%Y-%m-%d %H:%M:%S UTC') AS at_text FROM ev)
SELECT sha256(at_text || '|' || event_type || '|' || product_id || '|' || price || '|' || user_id || '|' || session_id) AS event_id,
       s * 1000000 AS event_time, event_type, product_id, nullif(CAST(CAST(product_id AS INT) % 10 AS VARCHAR), '0') AS category_id,
       CASE WHEN CAST(product_id AS INT) % 7 <> 0 THEN 'brand' || product_id END AS brand, price, user_id, session_id,
       false AS is_late_arrival FROM shop""",
    "csv_first_events": f"""WITH {EV}, shop AS (SELECT *, strftime(event_time, '%Y-%m-%d %H:%M:%S UTC') AS at_text FROM ev)
SELECT sha256(at_text || '|' || event_type || '|' || product_id || '|' || price || '|' || user_id || '|' || session_id) AS event_id,
       s * 1000000 AS event_time, event_type, price, user_id FROM shop ORDER BY 2, 1 LIMIT 500""",
    "columnar_events_scan": f"""WITH {RAW}
SELECT event_id, event_type, CAST(CAST(product_id AS INT) % 10 AS VARCHAR) AS category_id, CAST(NULL AS VARCHAR) AS category_code,
       CASE WHEN CAST(product_id AS INT) % 7 <> 0 THEN 'brand' || product_id END AS brand, price, session_id,
       is_late AS is_late_arrival, delay AS late_arrival_delay_seconds FROM raw""",
    "malformed_split": f"""WITH {RAW}
SELECT CASE WHEN n % 97 = 0 THEN 'not_json' ELSE event_type END AS kind, COUNT(*) AS rows FROM raw GROUP BY 1""",
    "quarantined_lines": f"""WITH {RAW}
SELECT 'NOT JSON {{{{{{' || event_id AS raw_line, 'not_json' AS reason FROM raw WHERE n % 97 = 0""",
    "decode_records": f"""WITH {RECORDS}
SELECT event_id, epoch_us(event_time) AS event_time, event_type, price, user_id, session_id, is_late AS is_late_arrival,
       sequence, arrival FROM records WHERE NOT broken""",
    "undecodable_records": f"WITH {RECORDS} SELECT sequence, arrival, 'undecodable' AS reason FROM records WHERE broken",
    "dlq_decode": f"""WITH {RECORDS}
SELECT 'm' || letter AS message_id, event_id, event_type, session_id, is_late AS is_late_arrival
FROM letters WHERE NOT broken AND NOT unreadable AND NOT batch_info""",
    "dlq_needs_refetch": f"""WITH {RECORDS}
SELECT DISTINCT 'm' || letter AS message_id, 'RetryAttemptsExhausted' AS condition, 'shard-0' AS "shardId",
       CAST(letter AS VARCHAR) AS "startSequenceNumber", CAST(letter AS VARCHAR) AS "endSequenceNumber",
       CAST(4 AS BIGINT) AS "batchSize", 'events' AS "streamArn" FROM letters WHERE batch_info""",
    "dlq_replay_counts": f"""WITH {RECORDS}
SELECT CAST(SUM(events) AS BIGINT) AS replayed, COUNT(*) FILTER (WHERE events = 0) AS skipped,
       COUNT(*) FILTER (WHERE events > 0) AS deleted FROM letter_counts""",
    "dlq_replay_dry_run": f"""WITH {RECORDS}
SELECT CAST(SUM(events) AS BIGINT) AS replayed, COUNT(*) FILTER (WHERE events = 0) AS skipped,
       CAST(0 AS BIGINT) AS deleted FROM letter_counts""",
    "typed_json_flatten": f"""WITH {EV}{live(1800)}
SELECT session_id, user_id, CAST(event_count AS VARCHAR) AS event_count,
       CAST(CAST(cart_total AS DECIMAL(18,2)) AS VARCHAR) AS cart_total, CAST(converted AS VARCHAR) AS converted,
       event_types_seen FROM speed""",
    "schema_merge": f"""WITH {RAW}
SELECT event_id, CASE WHEN is_late AND CAST(product_id AS INT) % 7 <> 0 THEN 'brand' || product_id END AS brand, price,
       is_late AS is_late_arrival, delay AS late_arrival_delay_seconds FROM raw""",
    # projections and filters
    "canonical_events": f"""WITH {DIRTY}
SELECT event_id, epoch_us(event_time) AS event_time, epoch_us(arrival_time) AS arrival_time, lower(trim(event_type)) AS event_type,
       product_id, nullif(category_id, '0') AS category_id, CAST(NULL AS VARCHAR) AS category_code, brand, {CLEAN_PRICE} AS price,
       user_id, session_id, coalesce(is_late, false) AS is_late_arrival, delay AS late_arrival_delay_seconds,
       epoch_us(coalesce(event_time, arrival_time)) AS effective_time
FROM dirty WHERE lower(trim(event_type)) IN ('view', 'cart', 'purchase')""",
    "effective_time": f"WITH {DIRTY} SELECT event_id, epoch_us(coalesce(event_time, arrival_time)) AS effective_time FROM dirty",
    "valid_events": f"""WITH {DIRTY} SELECT event_id, user_id, session_id, event_type FROM dirty
WHERE user_id IS NOT NULL AND session_id IS NOT NULL""",
    "invalid_event_counts": f"""WITH {DIRTY}
SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE user_id IS NULL) AS without_user,
       COUNT(*) FILTER (WHERE session_id IS NULL) AS without_session,
       COUNT(*) FILTER (WHERE user_id IS NULL OR session_id IS NULL) AS dropped FROM dirty""",
    "event_type_domain": f"""WITH {DIRTY} SELECT event_id, lower(trim(event_type)) AS event_type FROM dirty
WHERE lower(trim(event_type)) IN ('view', 'cart', 'purchase')""",
    "schema_violations": f"""WITH {DIRTY}
SELECT event_id, {ISO.format('arrival_time')} AS arrival_time, {REASONS} AS reasons FROM dirty WHERE {REASONS} <> ''""",
    "schema_conforming": f"WITH {DIRTY} SELECT event_id, event_type, price FROM dirty WHERE {REASONS} = ''",
    "on_time_events": f"WITH {DIRTY} SELECT event_id, session_id FROM dirty WHERE NOT coalesce(is_late, false)",
    "late_events": f"WITH {DIRTY} SELECT event_id, session_id, delay AS late_arrival_delay_seconds FROM dirty WHERE is_late",
    "late_by_threshold": f"""WITH {RAW} SELECT event_id, event_type, delay AS late_arrival_delay_seconds FROM raw WHERE delay > 300""",
    "safe_price": f"WITH {DIRTY} SELECT event_id, {CLEAN_PRICE} AS price FROM dirty",
    "realtime_sessions_view": f"""WITH {EV}{live(1800)}
SELECT session_id, event_count, cart_total, conversion_value, converted, session_start, last_event_time AS session_end,
       CAST(duration_seconds AS DOUBLE) AS duration_seconds, date_partition FROM speed""",
    "batch_sessions_view": f"""WITH {EV}{stitched(1800)}
SELECT batch_session_id, user_id, session_start, session_end, event_count, round(cart_total, 2) AS cart_total,
       round(conversion_value, 2) AS conversion_value, converted, duration_seconds, late_arrival_count, had_restatement,
       original_session_ids, CAST(substr(session_date, 1, 4) AS INT) AS year, CAST(substr(session_date, 6, 2) AS INT) AS month,
       CAST(substr(session_date, 9, 2) AS INT) AS day, session_date FROM batch""",
    "late_annotated_events": f"""WITH {RAW}, rolls AS (
  SELECT *, ('0x' || substr(md5('7:' || event_id), 1, 8))::BIGINT < CAST(floor(0.08::DOUBLE * 4294967296) AS BIGINT) AS chosen,
         120 + ('0x' || substr(md5('7:' || event_id), 9, 8))::BIGINT % 781 AS hold FROM raw)
SELECT event_id, chosen AS is_late_arrival, CASE WHEN chosen THEN hold END AS late_arrival_delay_seconds,
       epoch_us(arrival_time) + CASE WHEN chosen THEN hold * 1000000 ELSE 0 END AS arrival_time FROM rolls""",
    "hour_partitions": f"""WITH {RAW}
SELECT CAST(year(arrival_time) AS INT) AS year, CAST(month(arrival_time) AS INT) AS month, CAST(day(arrival_time) AS INT) AS day,
       CAST(hour(arrival_time) AS INT) AS hour, COUNT(*) AS events FROM raw GROUP BY 1, 2, 3, 4""",
    "stable_event_ids": f"""WITH {RAW}
SELECT event_id, sha256(event_id || '|' || event_type || '|' || user_id || '|') AS stable_id FROM raw""",
    "sessions_by_user": f"""WITH {EV}{live(1800)}
SELECT * EXCLUDE (event_types_seen, conversion_time) FROM speed WHERE user_id = '42'""",
    "live_sessions": f"""WITH {EV}{live(1800)}
SELECT session_id, last_event_time, event_count FROM speed
WHERE last_event_time + 7200000000 > epoch_us(TIMESTAMP '{DAY} 12:00:00')""",
    "payload_size_filter": f"""WITH {RAW}, sized AS (SELECT event_id,
  strlen('{{"event_id":"' || event_id || '","event_time":"' || {ISO.format('event_time')} || '","arrival_time":"' || {ISO.format('arrival_time')}
    || '","event_type":"' || event_type || '","product_id":"' || product_id || '","category_id":"' || CAST(product_id AS INT) % 10
    || '","category_code":null,"brand":' || CASE WHEN CAST(product_id AS INT) % 7 <> 0 THEN '"brand' || product_id || '"' ELSE 'null' END
    || ',"price":' || price || ',"user_id":"' || user_id || '","session_id":"' || session_id || '","is_late_arrival":' || is_late
    || ',"late_arrival_delay_seconds":' || coalesce(CAST(delay AS VARCHAR), 'null') || '}}') AS bytes FROM raw)
SELECT event_id, CAST(bytes AS INT) AS bytes FROM sized WHERE bytes <= 315""",
    # duplicates
    "dedup_events": f"WITH {RAW} SELECT event_id, epoch_us(arrival_time) AS arrival_time, event_type, price, session_id FROM raw",
    "union_all_events": f"WITH {RAW} SELECT event_id, is_late AS is_late_arrival, price FROM raw",
    # batch sessions
    "batch_sessions": f"WITH {EV}{stitched(1800)} SELECT * FROM batch",
    "nightly_sessions": f"""WITH {EV}{stitched(HOUR6)}
SELECT * EXCLUDE (batch_session_id), user_id || '_' || session_start AS batch_session_id FROM batch""",
    "session_id_chunks": f"""WITH {EV}{stitched(7 * 86400)}
SELECT batch_session_id, n AS n_ids, 1 AS chunks, n AS ids_held, ids FROM (
  SELECT batch_session_id, COUNT(DISTINCT session_id) AS n, string_agg(DISTINCT session_id, ',' ORDER BY session_id) AS ids
  FROM links GROUP BY batch_session_id)""",
    "batch_sessions_6h": f"WITH {EV}{stitched(HOUR6)} SELECT * FROM batch",
    "batch_session_facts": f"WITH {EV}{stitched(1800)} SELECT * EXCLUDE (original_session_ids) FROM batch",
    "session_links": f"WITH {EV}{stitched(HOUR6)} SELECT * FROM links",
    "event_gaps": f"""WITH {EV}{stitched(1800)}
SELECT event_id, user_id, us AS effective_time, prev_us AS prev_event_time, s - prev_s AS gap_seconds FROM gaps""",
    "session_boundaries": f"""WITH {EV}{stitched(HOUR6)}
SELECT event_id, user_id, opens AS is_session_start FROM flagged""",
    "sessionized_events": f"""WITH {EV}{stitched(1800)}
SELECT event_id, user_id, seq AS user_session_seq, user_id || '_' || seq AS batch_session_id, opens AS is_session_start FROM numbered""",
    "session_event_paths": f"""WITH {EV}
SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY us, event_id) AS position, event_id, event_type,
       us AS effective_time FROM ev""",
    "session_window_sessions": f"""WITH {EV},
wgaps AS (SELECT *, us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) AS gap FROM ev),
wcut AS (SELECT *, SUM(CASE WHEN gap > 1800000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY us, event_id
           ROWS UNBOUNDED PRECEDING) AS seg FROM wgaps)
SELECT user_id, MIN(us) AS session_start, MAX(us) AS session_end, COUNT(*) AS event_count,
       CAST({money('cart')} AS DOUBLE) AS cart_total, bool_or(event_type = 'purchase') AS converted FROM wcut GROUP BY user_id, seg""",
    # speed sessions
    "speed_sessions": f"WITH {EV}{live(1800)} SELECT * FROM speed",
    "closed_speed_sessions": f"""WITH {EV}{live(1800)}
SELECT * FROM segments QUALIFY segment < MAX(segment) OVER (PARTITION BY session_id)""",
    "cart_totals": f"WITH {EV} SELECT session_id, round(CAST({money('cart')} AS DOUBLE), 2) AS cart_total FROM ev GROUP BY session_id",
    "cart_totals_with_removals": f"""WITH RECURSIVE {RAW},
steps AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_time, event_id) AS i,
                 CASE event_type WHEN 'cart' THEN CAST(price AS DECIMAL(18,4)) WHEN 'error' THEN -CAST(price AS DECIMAL(18,4)) ELSE 0 END AS move
          FROM raw),
walk AS (SELECT user_id, i, CAST(greatest(0, move) AS DECIMAL(28,4)) AS total FROM steps WHERE i = 1
         UNION ALL
         SELECT s.user_id, s.i, CAST(greatest(0, w.total + s.move) AS DECIMAL(28,4))
         FROM walk w JOIN steps s ON s.user_id = w.user_id AND s.i = w.i + 1)
SELECT user_id, round(CAST(total AS DOUBLE), 2) AS cart_total FROM walk
QUALIFY i = MAX(i) OVER (PARTITION BY user_id)""",
    # reconciliation
    "restatement_audit": f"WITH {audit(1800)} SELECT * FROM audit",
    "restatement_audit_6h": f"WITH {audit(HOUR6)} SELECT * FROM audit",
    "session_deltas": f"WITH {deltas(1800)} SELECT * FROM deltas",
    "session_deltas_6h": f"WITH {deltas(HOUR6)} SELECT * FROM deltas",
    "session_deltas_flip_first": f"""WITH {deltas(HOUR6, True)}
SELECT session_id, batch_session_id, conversion_flipped, restatement_type FROM deltas""",
    "restatement_stats": f"WITH {deltas(1800)} {STATS}",
    "restatement_stats_6h": f"WITH {deltas(HOUR6)} {STATS}",
    "restatement_breakdown": f"WITH {deltas(1800)} {BREAKDOWN}",
    "restatement_breakdown_6h": f"WITH {deltas(HOUR6)} {BREAKDOWN}",
    "top_restated": f"""WITH {deltas(1800)}
SELECT session_id, batch_session_id, rt_cart_total, batch_cart_total, cart_total_delta, restatement_type, cart_total_abs_delta
FROM deltas ORDER BY cart_total_abs_delta DESC, session_id, batch_session_id LIMIT 20""",
    "restatement_detail": f"""WITH {both(1800)}
SELECT session_id, batch_session_id, round(rt_cart_total, 2) AS rt_cart_total, round(batch_cart_total, 2) AS batch_cart_total,
       round(batch_cart_total - rt_cart_total, 2) AS cart_delta, rt_event_count, batch_event_count, late_arrival_count, had_restatement
FROM links JOIN rt USING (session_id) WHERE had_restatement
ORDER BY abs(round(batch_cart_total - rt_cart_total, 2)) DESC, session_id, batch_session_id LIMIT 100""",
    "restatement_detail_of_day": f"""WITH {both(1800)}
SELECT session_id, batch_session_id, round(rt_cart_total, 2) AS rt_cart_total, round(batch_cart_total, 2) AS batch_cart_total,
       round(batch_cart_total - rt_cart_total, 2) AS cart_delta, rt_event_count, batch_event_count, late_arrival_count, had_restatement
FROM links JOIN rt USING (session_id) WHERE had_restatement AND date_partition = '{DAY}'
ORDER BY abs(round(batch_cart_total - rt_cart_total, 2)) DESC, session_id, batch_session_id LIMIT 100""",
    "audit_totals": f"WITH {audit(1800)} {AUDIT_TOTALS}",
    "audit_totals_of_day": f"WITH {audit(1800)} {AUDIT_TOTALS} WHERE batch_session_date = '{DAY}'",
    "late_event_match": f"""WITH {EV}
SELECT event_id, session_id, user_id, us AS effective_time,
       CASE WHEN EXISTS (SELECT 1 FROM ev o WHERE NOT o.is_late AND o.session_id = l.session_id AND o.user_id = l.user_id)
            THEN 'existing_session' ELSE 'new_session' END AS match,
       CASE WHEN event_type = 'cart' THEN price ELSE 0.0 END AS revenue_delta
FROM ev l WHERE is_late""",
    # reports
    "speed_summary": f"WITH {EV}{live(1800)} {SPEED_DAYS}",
    "batch_summary": f"WITH {EV}{stitched(1800)} {BATCH_DAYS}",
    "accuracy_comparison": f"WITH {both(1800)} {COMPARISON}",
    "speed_totals": f"WITH {EV}{live(1800)} {SPEED_DAY}",
    "batch_totals": f"WITH {EV}{stitched(1800)} {BATCH_DAY}",
    "metric_comparison": f"WITH {both(1800)} {METRIC_ROWS}",
    "report_metrics": f"WITH {deltas(1800)} {REPORT}",
    # health
    "late_rate_by_hour": f"""WITH {RAW}
SELECT CAST(hour(arrival_time) AS INT) AS hour, COUNT(*) AS total_events, COUNT(*) FILTER (WHERE is_late) AS late_count,
       round(COUNT(*) FILTER (WHERE is_late) * 100.0::DOUBLE / COUNT(*), 2) AS late_pct FROM raw GROUP BY 1""",
    "throughput_by_window": f"""WITH {RAW}
SELECT epoch_us(arrival_time) // 30000000 * 30000000 AS window_start, COUNT(*) FILTER (WHERE n % 97 <> 0) AS sent,
       COUNT(*) FILTER (WHERE n % 97 = 0) AS failed, COUNT(*) FILTER (WHERE is_late AND n % 97 <> 0) AS late,
       round(COUNT(*) FILTER (WHERE n % 97 <> 0) / 30.0::DOUBLE, 2) AS per_second FROM raw GROUP BY 1""",
    "lag_by_minute": f"WITH {RAW} {LAGS}",
    "lag_alarm": f"WITH {RAW}, lags AS ({LAGS}) {alarm('lags', 'max_lag_ms > 999', 3, 'max_lag_ms')}",
    "error_rate_alarm": f"""WITH {RAW}, rates AS (
  SELECT {MINUTE} AS minute, COUNT(*) AS records, COUNT(*) FILTER (WHERE n % 97 = 0) AS errors,
         round(COUNT(*) FILTER (WHERE n % 97 = 0)::DOUBLE / COUNT(*) * 100, 2) AS error_pct FROM raw GROUP BY 1)
{alarm('rates', 'error_pct > 5', 1, 'records, errors, error_pct')}""",
    "error_rate_alarm_five": f"""WITH {RAW}, rates AS (
  SELECT epoch_us(arrival_time) // 1000000 // 21600 * 60000000 AS minute, COUNT(*) AS records, COUNT(*) FILTER (WHERE n % 97 = 0) AS errors,
         round(COUNT(*) FILTER (WHERE n % 97 = 0)::DOUBLE / COUNT(*) * 100, 2) AS error_pct FROM raw GROUP BY 1)
{alarm('rates', 'errors * 100.0 > records * 0.5', 5, 'records, errors, error_pct')}""",
    # streams
    "stream_session_state": f"WITH {EV}{live(1800)} SELECT * FROM speed",
    "state_after_compaction": f"WITH {EV}{live(1800)} SELECT * FROM speed",
    "stream_closed_sessions": f"""WITH {EV}{live(1800)}
SELECT session_id, session_start, last_event_time, event_count, cart_total, converted FROM segments
QUALIFY segment < MAX(segment) OVER (PARTITION BY session_id)""",
    "stream_window_sessions": f"""WITH {EV},
wgaps AS (SELECT *, us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) AS gap FROM ev),
wcut AS (SELECT *, SUM(CASE WHEN gap > 1800000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY us, event_id
           ROWS UNBOUNDED PRECEDING) AS seg FROM wgaps)
SELECT user_id, MIN(us) AS session_start, MAX(us) + 1800000000 AS window_end, COUNT(*) AS event_count,
       CAST({money('cart')} AS DOUBLE) AS cart_total, bool_or(event_type = 'purchase') AS converted
FROM wcut GROUP BY user_id, seg
HAVING MAX(us) + 1800000000 <= ((SELECT MAX(us) FROM ev) // 1000 - 300000) * 1000""",
    "stream_dedup": f"WITH {EV} SELECT event_id, event_type, price, session_id FROM ev",
    "stream_routing": f"""WITH {RAW}
SELECT 'events' AS target, COUNT(*) FILTER (WHERE n % 97 <> 0) AS rows FROM raw
UNION ALL SELECT 'late-arrivals', COUNT(*) FILTER (WHERE n % 97 <> 0 AND is_late) FROM raw
UNION ALL SELECT 'quarantine', COUNT(*) FILTER (WHERE n % 97 = 0) FROM raw""",
    "stream_cart_counters": f"""WITH {EV}
SELECT session_id, CAST({money('cart')} AS DOUBLE) AS cart_total, COUNT(*) AS event_count FROM ev GROUP BY session_id""",
}

ORACLE: dict[str, str] = ALL


def large(sql: str) -> str:
    """The same question where every hundredth event costs 10^16 and more and the others nothing."""
    return sql.replace("value AS price", "CASE WHEN event_id % 100 = 0 THEN (event_id % 3 + 1) * CAST(1e16 AS DOUBLE) ELSE 0.0 END AS price").replace("DECIMAL(18,", "DECIMAL(38,")


ORACLE.update({
    "large_amounts": large(ORACLE["batch_summary"]),
    "large_restatements": large(ORACLE["restatement_breakdown"]),
    "stored_audit": ORACLE["audit_totals_of_day"],
    "stored_detail": ORACLE["restatement_breakdown"].replace("FROM deltas GROUP BY", f"FROM deltas WHERE batch_session_date = '{DAY}' GROUP BY"),
    "stored_summary": ORACLE["restatement_stats"],
    "stored_parquet": f"""WITH {EV}
SELECT event_type, COUNT(*) AS rows, CAST(SUM(CAST(price AS DECIMAL(18,4))) AS DOUBLE) AS value, MAX(us) AS last FROM ev GROUP BY event_type""",
    "columnar_store": f"""WITH {RAW}
SELECT CAST(year(arrival_time) AS INT) AS year, CAST(month(arrival_time) AS INT) AS month, CAST(day(arrival_time) AS INT) AS day, event_type,
       COUNT(*) AS rows, COUNT(*) FILTER (WHERE n % 3 = 0 OR price = 0) AS without_price, COUNT(*) FILTER (WHERE is_late) AS late,
       COUNT(*) FILTER (WHERE CAST(product_id AS INT) % 7 <> 0) AS branded, CAST(SUM(delay) AS BIGINT) AS delay
FROM raw GROUP BY 1, 2, 3, 4""",
    "raw_events_table": f"""WITH {RAW}
SELECT CAST(hour(arrival_time) AS INT) AS hour, event_type, COUNT(*) AS rows, COUNT(*) FILTER (WHERE is_late) AS late
FROM raw WHERE strftime(arrival_time, '%Y-%m-%d') = '{DAY}' GROUP BY 1, 2""",
    "raw_events_projected": f"""WITH {RAW}
SELECT CAST(month(arrival_time) AS INT) AS month, CAST(day(arrival_time) AS INT) AS day, COUNT(*) AS rows, COUNT(*) AS by_path FROM raw GROUP BY 1, 2""",
    "batch_sessions_table": ORACLE["batch_summary"],
    "snapshot_table": ORACLE["speed_summary"],
    "audit_table": f"""WITH {deltas(1800)}
SELECT CAST(year(CAST(batch_session_date AS DATE)) AS INT) AS year, CAST(month(CAST(batch_session_date AS DATE)) AS INT) AS month,
       CAST(day(CAST(batch_session_date AS DATE)) AS INT) AS day, restatement_type, COUNT(*) AS rows,
       CAST(SUM(event_count_delta) AS BIGINT) AS events, COUNT(*) FILTER (WHERE conversion_flipped) AS flipped
FROM deltas WHERE batch_session_date IS NOT NULL GROUP BY 1, 2, 3, 4""",
    "unknown_sessions": f"""WITH {EV}
SELECT CASE WHEN n % 127 > 0 THEN session_id ELSE 'unknown' END AS session_id, COUNT(*) AS rows FROM ev GROUP BY 1""",
    "date_parts": f"""WITH {RAW}, parts AS (SELECT event_id, CASE WHEN n % 31 = 0 THEN 'no-date' ELSE strftime(arrival_time, '%Y-%m-%d') END AS text FROM raw)
SELECT event_id, TRY_CAST(split_part(text, '-', 1) AS INT) AS year, TRY_CAST(split_part(text, '-', 2) AS INT) AS month,
       TRY_CAST(split_part(text, '-', 3) AS INT) AS day FROM parts""",
    "lenient_numbers": f"""WITH {RAW}
SELECT event_id, CASE WHEN n % 7 = 0 OR n % 11 = 0 THEN 0.0::DOUBLE ELSE CAST(product_id AS DOUBLE) END AS number FROM raw""",
    "nested_decimals": f"""WITH {RAW}, d AS (SELECT event_id, user_id, CAST(CAST(price AS DECIMAL(28,6)) AS VARCHAR) AS p FROM raw)
SELECT event_id, p || ',-,-' AS listed, p AS by_type, p AS own, p AS inner, user_id FROM d""",
    "stream_interval_trigger": f"""WITH {RAW}
SELECT event_type, COUNT(*) AS rows, 1 AS batches FROM raw WHERE n % 97 <> 0 GROUP BY event_type""",
    "stream_batch_counts": f"""WITH {EV}
SELECT COUNT(*) AS processed, COUNT(*) FILTER (WHERE is_late) AS late_arrivals, CAST(0 AS BIGINT) AS errors FROM ev""",
    "stream_behind_watermark": f"""WITH {RAW},
slow AS (SELECT event_id, event_type, epoch_us(event_time) AS us, epoch_us(arrival_time) + CASE WHEN n % 29 = 0 THEN 259200000000 ELSE 0 END AS came FROM raw),
span AS (SELECT MIN(came) AS low, (MAX(came) - MIN(came)) // 5 + 1 AS step FROM slow),
batched AS (SELECT event_id, us, (came - low) // step AS batch FROM slow, span WHERE event_type IN ('view', 'cart', 'purchase')),
tops AS (SELECT batch, MAX(us) AS top FROM batched GROUP BY batch),
judged AS (SELECT event_id, us < (SELECT MAX(top) FROM tops t WHERE t.batch < b.batch) - 300000000 AS late FROM batched b)
SELECT event_id, 'behind' AS side, CAST(1 AS BIGINT) AS rows FROM judged WHERE late
UNION ALL SELECT '', 'in-time', COUNT(*) FROM judged WHERE late IS NOT TRUE""",
})
