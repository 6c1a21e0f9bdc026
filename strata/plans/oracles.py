"""SQL for DuckDB that computes the same results as the registered queries.

Written against the test tables alone; nothing here is generated from the Spark code.
Averages and ratios are rounded to six digits. An average over 2^n rows can end in an exact 5 after
them, and the last bit of a sum then decides the digit; adding 1e-9 on both sides settles such ties.
"""

from __future__ import annotations

_TRIPS = """
b AS (
  SELECT CAST(l_orderkey * 7 + l_linenumber AS BIGINT) AS h, l_partkey, l_suppkey FROM lineitem
), t AS (
  SELECT h, l_partkey, l_suppkey,
    CASE WHEN h % 10 = 0 THEN 6 WHEN h % 10 = 1 THEN 7 WHEN h % 10 = 2 THEN 3 ELSE 1 + h % 2 END AS vendor,
    TIMESTAMP '2023-12-31 00:00:00' + to_seconds((h * 7919) % (32 * 86400)) AS pu,
    CASE WHEN h % 37 = 0 THEN -300 WHEN h % 61 = 0 THEN 0 ELSE (h % 61) * 60 + h % 60 END AS dur
  FROM b
), trips AS (
SELECT CAST(vendor AS INT) AS VendorID,
  pu AS tpep_pickup_datetime,
  CASE WHEN h % 101 = 0 THEN NULL ELSE pu + to_seconds(dur) END AS tpep_dropoff_datetime,
  CASE WHEN h % 97 = 0 THEN NULL ELSE CAST(h % 7 AS DOUBLE) END AS passenger_count,
  CAST(h % 250 AS DOUBLE) / 10 AS trip_distance,
  CAST(CASE WHEN h % 29 = 0 THEN 99 WHEN h % 31 = 0 THEN 8 ELSE 1 + h % 6 END AS DOUBLE) AS RatecodeID,
  CASE WHEN h % 50 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
  CAST(1 + h % 265 AS INT) AS PULocationID,
  CAST(1 + (h * 31) % 265 AS INT) AS DOLocationID,
  CAST(CASE WHEN h % 83 = 0 THEN 9 ELSE (h % 11) % 7 END AS BIGINT) AS payment_type,
  CASE WHEN h % 53 = 0 THEN CAST(-5 AS DOUBLE) ELSE CAST(30 + h % 400 AS DOUBLE) / 10 END AS fare_amount,
  CAST(l_suppkey % 4 AS DOUBLE) / 2 AS extra,
  CAST(0.5 AS DOUBLE) AS mta_tax,
  CASE WHEN h % 211 = 0 THEN CAST(500 AS DOUBLE) ELSE CAST(h % 150 AS DOUBLE) / 10 END AS tip_amount,
  CAST(0 AS DOUBLE) AS tolls_amount,
  CAST(1 AS DOUBLE) AS improvement_surcharge,
  CAST(30 + h % 400 + h % 150 + 15 AS DOUBLE) / 10 AS total_amount,
  CASE WHEN l_partkey % 3 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(2.5 AS DOUBLE) END AS congestion_surcharge,
  CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE CAST(0 AS DOUBLE) END AS Airport_fee
FROM t
)"""

_ZONES = """
zones AS (
SELECT CAST(z.id AS INT) AS LocationID, r.r_name AS Borough, concat('ZONE_', CAST(z.id % 260 AS INT)) AS Zone
FROM (SELECT unnest(range(1, 264)) AS id) z JOIN region r ON r.r_regionkey = z.id % 5
)"""

_RULES = {
    "tpep_pickup_datetime_tpep_dropoff_datetime_present": "tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL",
    "VendorID_known": "VendorID IN (1, 2, 6, 7)",
    "RatecodeID_known": "RatecodeID IN (1, 2, 3, 4, 5, 6, 99)",
    "payment_type_known": "payment_type IN (0, 1, 2, 3, 4, 5, 6)",
    "fare_amount_positive": "fare_amount > 0",
    "mta_tax_positive": "mta_tax > 0",
    "improvement_surcharge_positive": "improvement_surcharge > 0",
    "total_amount_positive": "total_amount > 0",
    "trip_distance_positive": "trip_distance > 0",
    "passenger_count_positive": "passenger_count > 0",
    "extra_non_negative": "extra >= 0",
    "tip_amount_non_negative": "tip_amount >= 0",
    "tolls_amount_non_negative": "tolls_amount >= 0",
    "congestion_surcharge_non_negative": "congestion_surcharge >= 0",
    "Airport_fee_non_negative": "Airport_fee >= 0",
    "tpep_pickup_datetime_before_tpep_dropoff_datetime": "tpep_pickup_datetime <= tpep_dropoff_datetime",
}

_CLEAN = (
    "clean AS (SELECT * FROM trips WHERE " + " AND ".join(f"({p})" for p in _RULES.values()) + ")"
)

_FEATURES = """
featured AS (
SELECT VendorID AS vendor_id, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance,
  RatecodeID AS ratecode_id, store_and_fwd_flag, PULocationID AS pulocation_id, DOLocationID AS dolocation_id,
  payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount,
  congestion_surcharge, Airport_fee AS airport_fee,
  md5(concat_ws('|', CAST(VendorID AS VARCHAR), CAST(tpep_pickup_datetime AS VARCHAR),
    CAST(tpep_dropoff_datetime AS VARCHAR), coalesce(CAST(PULocationID AS VARCHAR), ''),
    coalesce(CAST(DOLocationID AS VARCHAR), ''), CAST(passenger_count + 0.0 AS VARCHAR),
    CAST(trip_distance + 0.0 AS VARCHAR), CAST(fare_amount + 0.0 AS VARCHAR),
    CAST(tip_amount + 0.0 AS VARCHAR), CAST(total_amount + 0.0 AS VARCHAR),
    CAST(payment_type AS VARCHAR))) AS trip_id,
  coalesce(tip_amount > total_amount, false) AS is_tip_more_total,
  CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
  (floor(epoch(tpep_dropoff_datetime)) - floor(epoch(tpep_pickup_datetime))) / 60 AS trip_duration_min
FROM clean
), features AS (
SELECT *, trip_distance * 60 / nullif(trip_duration_min, 0) AS avg_speed_mph,
  total_amount / nullif(trip_distance, 0) AS fare_per_mile,
  total_amount / nullif(trip_duration_min, 0) AS fare_per_min
FROM featured
)"""

_SILVER = """
silver AS (
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY ratecode_id NULLS LAST, store_and_fwd_flag NULLS LAST,
    extra NULLS LAST, mta_tax NULLS LAST, tolls_amount NULLS LAST, improvement_surcharge NULLS LAST,
    congestion_surcharge NULLS LAST, airport_fee NULLS LAST) AS rn
  FROM features)
WHERE rn = 1
)"""

_FACT = """
fact AS (
SELECT trip_id, pickup_date, CAST(hour(tpep_pickup_datetime) AS INT) AS pickup_hour, pulocation_id, dolocation_id,
  payment_type, trip_distance, fare_amount, total_amount, tip_amount, trip_duration_min
FROM silver
)"""

_DATES = """
dates AS (
SELECT pickup_date, CAST(h AS INT) AS pickup_hour, CAST(dayofweek(pickup_date) + 1 AS INT) AS pickup_weekday,
  dayofweek(pickup_date) IN (0, 6) AS is_weekend,
  CASE WHEN h <= 6 THEN 'early_morning' WHEN h <= 12 THEN 'morning' WHEN h <= 18 THEN 'afternoon' ELSE 'evening' END AS time_bucket,
  (h BETWEEN 7 AND 9 OR h BETWEEN 16 AND 19) AS is_rush_hour,
  CAST(day(pickup_date) AS INT) AS day_of_month, CAST(month(pickup_date) AS INT) AS month,
  CAST(year(pickup_date) AS INT) AS year, CAST(quarter(pickup_date) AS INT) AS quarter
FROM (SELECT CAST(unnest(generate_series(min(tpep_pickup_datetime)::DATE, max(tpep_pickup_datetime)::DATE, INTERVAL 1 DAY)) AS DATE) AS pickup_date FROM trips),
  (SELECT unnest(range(0, 24)) AS h)
)"""

_PAYMENTS = """
payments(payment_type, payment_name) AS (
VALUES (CAST(0 AS BIGINT), 'Flex Fare trip'), (1, 'Credit card'), (2, 'Cash'), (3, 'No charge'), (4, 'Dispute'),
  (5, 'Unknown'), (6, 'Voided trip')
)"""


def _raw(sql: str, *more: str) -> str:
    return "WITH " + ", ".join((_TRIPS, *more)) + sql


def _with_clean(sql: str, *more: str) -> str:
    return _raw(sql, _CLEAN, *more)


def _with_features(sql: str, *more: str) -> str:
    return _with_clean(sql, _FEATURES, *more)


def _with_silver(sql: str, *more: str) -> str:
    return _with_features(sql, _SILVER, *more)


def _with_fact(sql: str, *more: str) -> str:
    return _with_silver(sql, _FACT, *more)


_BUCKET = """CASE WHEN {h} <= 6 THEN 'early_morning' WHEN {h} <= 12 THEN 'morning'
  WHEN {h} <= 18 THEN 'afternoon' ELSE 'evening' END"""

_DAILY = """
SELECT pickup_date, count(*) AS total_trips, round(sum(total_amount), 2) AS total_revenue,
  round(avg(total_amount) + 1e-9, 6) AS avg_revenue_per_trip, round(avg(trip_distance) + 1e-9, 6) AS avg_distance_per_trip,
  round(avg(tip_amount) + 1e-9, 6) AS avg_tip, round(sum(fare_amount), 2) AS total_fare
FROM fact {where} GROUP BY pickup_date"""

_TILES = """
SELECT count(*) AS total_trips, round(sum(total_amount), 2) AS total_revenue,
  round(avg(total_amount) + 1e-9, 6) AS avg_revenue_per_trip, round(avg(trip_distance) + 1e-9, 6) AS avg_distance_per_trip
FROM """

_UPSERTED = """, old AS (SELECT * FROM silver WHERE pickup_date <= DATE '2024-01-20'),
new AS (SELECT * REPLACE (extra + 1 AS extra) FROM silver WHERE pickup_date >= DATE '2024-01-15')
SELECT * FROM old WHERE trip_id NOT IN (SELECT trip_id FROM new) UNION ALL SELECT * FROM new"""

_SPLIT = """
SELECT {flag} AS {name}, count(*) AS trips, round(sum(total_amount), 2) AS revenue,
  round(avg(total_amount) + 1e-9, 6) AS avg_revenue, round(avg(trip_duration_min) + 1e-9, 6) AS avg_duration_min
FROM fact GROUP BY 1"""

_KEY_AUDIT = """
SELECT count(*) AS total_rows, count(*) FILTER (trip_id IS NULL) AS null_keys,
  count(*) FILTER (length(trip_id) <> 32) AS bad_length, count(DISTINCT trip_id) AS distinct_keys,
  count(*) - count(DISTINCT trip_id) AS duplicates,
  round(count(DISTINCT trip_id) * 100.0 / count(*) + 1e-9, 6) AS uniqueness_pct{more}
FROM {table}"""

_BREAKDOWN = """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS samples
FROM events GROUP BY ALL"""

_RATE = """
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, event_type, count(*) AS samples,
  round(count(*) / 300.0 + 1e-9, 6) AS rate FROM events GROUP BY 1, 2"""

_GAPS = """
SELECT user_id, gap_start, gap_end, round((epoch_us(gap_end) - epoch_us(gap_start)) / 1000000.0 + 1e-9, 6) AS seconds FROM (
  SELECT user_id, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap_start, ts AS gap_end FROM events)
WHERE epoch_us(gap_end) - epoch_us(gap_start) >= 43200000000"""

_SESSIONS = """
WITH marked AS (
  SELECT user_id, ts, CASE WHEN ts > lag(ts) OVER w + INTERVAL {minutes} MINUTE THEN 1 ELSE 0 END AS fresh
  FROM events {where} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
), numbered AS (
  SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM marked
)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL {minutes} MINUTE AS session_end, count(*) AS samples
FROM numbered GROUP BY user_id, s"""

_HOURS = """
WITH hours AS (
  SELECT unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)), INTERVAL 1 HOUR)) AS unit_start
  FROM events
), tally AS (
  SELECT date_trunc('hour', ts) AS unit_start, count(*) AS requests,
    count(*) FILTER (event_type = 'purchase') AS successes, count(*) FILTER (event_type = 'error') AS failures
  FROM events GROUP BY 1
)"""

_NUMERIC = (
    "VendorID",
    "passenger_count",
    "trip_distance",
    "RatecodeID",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "Airport_fee",
)
_ALL_COLUMNS = (*_NUMERIC, "tpep_pickup_datetime", "tpep_dropoff_datetime", "store_and_fwd_flag")

_CHECKS = {
    "pickup_before_2024": "tpep_pickup_datetime < TIMESTAMP '2024-01-01 00:00:00'",
    "negative_fare_amount": "fare_amount < 0",
    "negative_extra": "extra < 0",
    "negative_mta_tax": "mta_tax < 0",
    "negative_tip_amount": "tip_amount < 0",
    "negative_tolls_amount": "tolls_amount < 0",
    "negative_improvement_surcharge": "improvement_surcharge < 0",
    "negative_total_amount": "total_amount < 0",
    "negative_congestion_surcharge": "congestion_surcharge < 0",
    "negative_Airport_fee": "Airport_fee < 0",
    "dropoff_before_pickup": "tpep_dropoff_datetime < tpep_pickup_datetime",
    "zero_distance": "trip_distance = 0",
    "negative_distance": "trip_distance < 0",
    "negative_passengers": "passenger_count < 0",
    "tip_above_total": "tip_amount > total_amount",
}


def _union(parts: list[str]) -> str:
    return "\n" + "\nUNION ALL ".join(parts)


def _first_failure() -> str:
    cases = " ".join(f"WHEN NOT coalesce({p}, false) THEN '{n}'" for n, p in _RULES.items())
    return f"CASE {cases} END"


_LANDED = "(SELECT *, tpep_pickup_datetime::DATE AS day FROM trips WHERE tpep_pickup_datetime >= TIMESTAMP '2024-01-01')"

_SLIDING = """
WITH steps AS (
  SELECT DISTINCT event_type, time_bucket(INTERVAL 1 MINUTE, ts) + to_minutes(i) AS range_end
  FROM events, (SELECT unnest(range(1, 6)) AS i)
), ranges AS (
  SELECT s.range_end, s.event_type, count(*) AS increase FROM steps s JOIN events e
    ON e.event_type = s.event_type AND e.ts >= s.range_end - INTERVAL 5 MINUTE AND e.ts < s.range_end
  GROUP BY ALL
)"""

_MARTS = """
, marts(mart, key, trips, first_value, second_value) AS (
SELECT 'daily_summary', CAST(pickup_date AS VARCHAR), count(*), sum(total_amount), avg(tip_amount) FROM kept GROUP BY pickup_date
UNION ALL SELECT 'revenue_by_hour', CAST(pickup_hour AS VARCHAR), count(*), sum(total_amount), avg(total_amount) FROM kept GROUP BY pickup_hour
UNION ALL SELECT 'weekly_revenue', CAST(CAST(date_trunc('week', pickup_date) AS DATE) AS VARCHAR), count(*), sum(total_amount), stddev_samp(total_amount)
  FROM kept GROUP BY date_trunc('week', pickup_date)
UNION ALL SELECT 'weekend_split', CAST(dayofweek(pickup_date) IN (0, 6) AS VARCHAR), count(*), sum(total_amount), avg(trip_duration_min)
  FROM kept GROUP BY dayofweek(pickup_date) IN (0, 6)
UNION ALL SELECT 'rush_hour_split', CAST(pickup_hour BETWEEN 7 AND 9 OR pickup_hour BETWEEN 16 AND 19 AS VARCHAR), count(*), sum(total_amount),
  avg(trip_duration_min) FROM kept GROUP BY (pickup_hour BETWEEN 7 AND 9 OR pickup_hour BETWEEN 16 AND 19)
UNION ALL SELECT 'od_pairs', concat_ws('-', any_value(a.Zone), any_value(d.Zone), pulocation_id, dolocation_id), count(*), sum(total_amount),
  avg(trip_distance) FROM kept LEFT JOIN zones a ON a.LocationID = pulocation_id LEFT JOIN zones d ON d.LocationID = dolocation_id
  GROUP BY pulocation_id, dolocation_id
UNION ALL SELECT 'revenue_by_location', CAST(pulocation_id AS VARCHAR), count(*), sum(total_amount), avg(total_amount) FROM kept GROUP BY pulocation_id
UNION ALL SELECT 'zone_traffic', CAST(z AS VARCHAR), count(*), sum(p), sum(1 - p) FROM (
  SELECT pulocation_id AS z, 1 AS p FROM kept UNION ALL SELECT dolocation_id, 0 FROM kept) GROUP BY z
UNION ALL SELECT 'tip_behavior', CAST(payment_type AS VARCHAR), count(*), avg(CAST(tip_amount > 0 AS INT)), avg(tip_amount / nullif(total_amount, 0))
  FROM kept GROUP BY payment_type
UNION ALL SELECT 'tip_by_band', concat_ws('/', band, bucket), count(*), avg(tip_amount), avg(tip_amount / nullif(fare_amount, 0)) FROM (
  SELECT *, CASE WHEN trip_distance < 1 THEN '0-1' WHEN trip_distance < 3 THEN '1-3' WHEN trip_distance < 10 THEN '3-10' ELSE '10+' END AS band,
    CASE WHEN pickup_hour <= 6 THEN 'early_morning' WHEN pickup_hour <= 12 THEN 'morning' WHEN pickup_hour <= 18 THEN 'afternoon' ELSE 'evening' END AS bucket
  FROM kept) GROUP BY band, bucket
UNION ALL SELECT 'efficiency', bucket, count(*), avg(trip_distance * 60 / nullif(trip_duration_min, 0)), avg(total_amount / nullif(trip_distance, 0)) FROM (
  SELECT *, CASE WHEN pickup_hour <= 6 THEN 'early_morning' WHEN pickup_hour <= 12 THEN 'morning' WHEN pickup_hour <= 18 THEN 'afternoon' ELSE 'evening' END AS bucket
  FROM kept) GROUP BY bucket
UNION ALL SELECT 'fare_by_date', CAST(pickup_date AS VARCHAR), 0, quantile_cont(fare_amount, 0.5), avg(fare_amount) FROM kept GROUP BY pickup_date
)
SELECT mart, key, CAST(trips AS BIGINT) AS trips, round(CAST(first_value AS DOUBLE), 2) AS first_value,
  round(CAST(second_value AS DOUBLE) + 1e-9, 6) AS second_value FROM marts"""

ORACLES: dict[str, str] = {
    # cleaning, features, keys
    "q_daily_summary": _with_fact(_DAILY.format(where="")),
    "q_clean": _with_clean(" SELECT * FROM clean"),
    "q_features": _with_features(" SELECT * FROM features"),
    "q_dedup": _with_silver(" SELECT * FROM silver"),
    "q_upsert": _with_silver(_UPSERTED),
    "q_upsert_table": _with_silver(_UPSERTED),
    "q_key_legacy": _raw(
        """
SELECT md5(concat_ws('|', coalesce(CAST(VendorID AS VARCHAR), ''), coalesce(CAST(tpep_pickup_datetime AS VARCHAR), ''),
    coalesce(CAST(tpep_dropoff_datetime AS VARCHAR), ''), coalesce(CAST(PULocationID AS VARCHAR), ''),
    coalesce(CAST(DOLocationID AS VARCHAR), ''), coalesce(CAST(fare_amount + 0.0 AS VARCHAR), ''))) AS trip_id,
  VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, DOLocationID, fare_amount
FROM trips"""
    ),
    "q_key_audit": _with_features(_KEY_AUDIT.format(table="features", more="")),
    "q_reject_report": _raw(
        _union(
            [
                f"SELECT '{n}' AS rule, count(*) FILTER (NOT coalesce({p}, false)) AS failing,"
                f" count(*) FILTER (reason = '{n}') AS first_failing FROM judged"
                for n, p in _RULES.items()
            ]
        ),
        f"judged AS (SELECT *, {_first_failure()} AS reason FROM trips)",
    ),
    "q_rejected_rows": _raw(
        f" SELECT * FROM (SELECT *, {_first_failure()} AS reason FROM trips) WHERE reason IS NOT NULL"
    ),
    # dimensions
    "q_parse_times": """
SELECT stamp::DATE AS day, count(*) AS samples, min(stamp) AS first_at, max(stamp) AS last_at FROM (
  SELECT CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 10 < 5 THEN date_trunc('minute', ts) ELSE date_trunc('second', ts) END AS stamp
  FROM events) GROUP BY 1""",
    "q_sample_rows": """
SELECT * FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice LIMIT 20""",
    "q_dim_date": _raw(" SELECT * FROM dates", _DATES),
    "q_dim_zone": _with_fact(
        """
SELECT u.zone_id, u.total, z.Borough AS zone_borough, z.Zone AS zone_zone
FROM (SELECT zone_id, count(*) AS total FROM (SELECT pulocation_id AS zone_id FROM fact UNION ALL
  SELECT dolocation_id FROM fact) GROUP BY 1) u LEFT JOIN zones z ON z.LocationID = u.zone_id""",
        _ZONES,
    ),
    "q_dim_payment": _with_fact(
        """
SELECT p.payment_type, p.payment_name, count(f.trip_id) AS trips
FROM payments p LEFT JOIN fact f ON f.payment_type = p.payment_type GROUP BY 1, 2""",
        _PAYMENTS,
    ),
    "q_decode": _raw(
        """
SELECT CASE VendorID WHEN 1 THEN 'Creative Mobile Technologies, LLC' WHEN 2 THEN 'Curb Mobility, LLC'
    WHEN 6 THEN 'Myle Technologies Inc' WHEN 7 THEN 'Helix' ELSE 'Unknown' END AS vendor,
  CASE RatecodeID WHEN 1 THEN 'Standard rate' WHEN 2 THEN 'JFK' WHEN 3 THEN 'Newark' WHEN 4 THEN 'Nassau or Westchester'
    WHEN 5 THEN 'Negotiated fare' WHEN 6 THEN 'Group ride' WHEN 99 THEN 'Null/unknown' ELSE 'Unknown' END AS rate,
  CASE store_and_fwd_flag WHEN 'Y' THEN 'Store and forward trip' WHEN 'N' THEN 'Not a store and forward trip'
    ELSE 'Unknown' END AS store_flag,
  coalesce(p.payment_name, 'Unknown') AS payment, count(*) AS trips
FROM trips t LEFT JOIN payments p ON p.payment_type = t.payment_type GROUP BY 1, 2, 3, 4""",
        _PAYMENTS,
    ),
    # marts
    "q_fact_trips": _with_fact(" SELECT * FROM fact"),
    "q_kpi_tiles": _with_fact(_TILES + "fact"),
    "q_kpi_sliced": _with_fact(
        _TILES
        + """fact WHERE day(pickup_date) BETWEEN 1 AND 15 AND payment_type IN (1, 2) AND pickup_hour BETWEEN 7 AND 12"""
    ),
    "q_kpi_sliced_published": _with_fact(
        _TILES
        + """fact WHERE day(pickup_date) BETWEEN 1 AND 15 AND payment_type IN (1, 2) AND pickup_hour BETWEEN 7 AND 12"""
    ),
    "q_kpi_cube": _with_fact(
        """
SELECT is_weekend, time_bucket, payment_type, grouping_id(is_weekend, time_bucket, payment_type) AS totals,
  count(*) AS total_trips, round(sum(total_amount), 2) AS total_revenue,
  round(avg(total_amount) + 1e-9, 6) AS avg_revenue_per_trip, round(avg(trip_distance) + 1e-9, 6) AS avg_distance_per_trip
FROM (SELECT dayofweek(pickup_date) IN (0, 6) AS is_weekend, """
        + _BUCKET.format(h="pickup_hour")
        + """ AS time_bucket, nullif(payment_type, 3) AS payment_type, total_amount, trip_distance FROM fact)
GROUP BY CUBE (is_weekend, time_bucket, payment_type)"""
    ),
    "q_distinct_sketches": _with_clean(
        """
SELECT CAST(date_trunc('week', tpep_pickup_datetime) AS DATE) AS week, count(*) AS rows,
  count(DISTINCT concat_ws('-', PULocationID, DOLocationID, VendorID)) AS distinct_routes, true AS within_error
FROM clean GROUP BY 1"""
    ),
    "q_shared_routes": _with_clean(
        """
SELECT count(*) FILTER (a) AS first_routes, count(*) FILTER (b) AS second_routes, count(*) FILTER (a AND b) AS shared_routes,
  true AS within_error
FROM (SELECT bool_or(tpep_pickup_datetime < TIMESTAMP '2024-01-16') AS a, bool_or(tpep_pickup_datetime >= TIMESTAMP '2024-01-16') AS b
  FROM clean GROUP BY PULocationID, DOLocationID, VendorID)"""
    ),
    "q_weekly_percentiles": _with_clean(
        """
SELECT CAST(date_trunc('week', tpep_pickup_datetime) AS DATE) AS week, count(*) AS rows, true AS within_error
FROM clean GROUP BY 1"""
    ),
    "q_calendar_revenue": _with_fact(
        """
SELECT year, quarter, month, is_weekend, time_bucket, is_rush_hour, count(*) AS trips,
  round(sum(total_amount), 2) AS revenue
FROM fact JOIN dates USING (pickup_date, pickup_hour) GROUP BY ALL""",
        _DATES,
    ),
    "q_heatmap": _with_fact(
        """
SELECT CAST(dayofweek(pickup_date) + 1 AS INT) AS pickup_weekday, pickup_hour, count(*) AS trips
FROM fact GROUP BY 1, 2"""
    ),
    "q_heatmap_matrix": _with_fact(
        "\nSELECT CAST(dayofweek(pickup_date) + 1 AS INT) AS pickup_weekday, "
        + ", ".join(f"nullif(count(*) FILTER (pickup_hour = {h}), 0) AS h{h:02d}" for h in range(24))
        + " FROM fact GROUP BY 1"
    ),
    "q_daily_trend": _with_fact(
        """
SELECT pickup_date, total_trips, round(z + 1e-9, 6) AS z, coalesce(abs(z) > 2, false) AS flagged FROM (
  SELECT pickup_date, total_trips,
    (total_trips - avg(total_trips) OVER ()) / nullif(stddev_samp(total_trips) OVER (), 0) AS z
  FROM (SELECT pickup_date, count(*) AS total_trips FROM fact GROUP BY 1))"""
    ),
    "q_top_zones": _with_fact(
        """
SELECT f.pulocation_id, f.trips, z.Borough AS pickup_borough, z.Zone AS pickup_zone
FROM (SELECT pulocation_id, count(*) AS trips FROM fact GROUP BY 1 ORDER BY trips DESC, pulocation_id LIMIT 10) f
LEFT JOIN zones z ON z.LocationID = f.pulocation_id""",
        _ZONES,
    ),
    "q_distance_fare": _with_fact(
        """
SELECT count(*) AS trips, round(corr(fare_amount, trip_distance) + 1e-9, 6) AS corr,
  round(regr_slope(fare_amount, trip_distance) + 1e-9, 6) AS slope,
  round(regr_intercept(fare_amount, trip_distance) + 1e-9, 6) AS intercept
FROM fact"""
    ),
    "q_fare_outliers": _with_fact(
        """, fit AS (
  SELECT regr_slope(fare_amount, trip_distance) AS s, regr_intercept(fare_amount, trip_distance) AS i FROM fact
), residuals AS (
  SELECT trip_id, trip_distance, fare_amount, fare_amount - (s * trip_distance + i) AS residual FROM fact, fit
)
SELECT trip_id, trip_distance, fare_amount, round(residual + 1e-9, 6) AS residual FROM residuals
WHERE abs(residual) > 1.5 * (SELECT stddev_samp(residual) FROM residuals)"""
    ),
    "q_fare_bins": _with_fact(
        """
SELECT CAST(floor(trip_distance) AS BIGINT) AS distance_bin, CAST(floor(fare_amount) AS BIGINT) AS fare_bin,
  count(*) AS trips FROM fact GROUP BY 1, 2"""
    ),
    "q_payment_share": _with_fact(
        """
SELECT f.payment_type, f.trips, round(f.trips * 100.0 / (SELECT count(*) FROM fact) + 1e-9, 6) AS share_pct, p.payment_name
FROM (SELECT payment_type, count(*) AS trips FROM fact GROUP BY 1) f LEFT JOIN payments p USING (payment_type)""",
        _PAYMENTS,
    ),
    "q_weekend_split": _with_fact(_SPLIT.format(flag="dayofweek(pickup_date) IN (0, 6)", name="is_weekend")),
    "q_tip_by_band": _with_fact(
        """
SELECT CASE WHEN trip_distance < 1 THEN '0-1' WHEN trip_distance < 3 THEN '1-3' WHEN trip_distance < 10 THEN '3-10'
    ELSE '10+' END AS distance_band, """
        + _BUCKET.format(h="pickup_hour")
        + """ AS time_bucket, count(*) AS trips, round(avg(tip_amount) + 1e-9, 6) AS avg_tip,
  round(avg(tip_amount / nullif(fare_amount, 0)) + 1e-9, 6) AS avg_tip_ratio
FROM fact GROUP BY 1, 2"""
    ),
    "q_rush_hour": _with_fact(
        _SPLIT.format(flag="pickup_hour BETWEEN 7 AND 9 OR pickup_hour BETWEEN 16 AND 19", name="is_rush_hour")
    ),
    "q_od_pairs": _with_fact(
        """
SELECT f.*, a.Borough AS pickup_borough, a.Zone AS pickup_zone, d.Borough AS dropoff_borough, d.Zone AS dropoff_zone
FROM (SELECT pulocation_id, dolocation_id, count(*) AS trips, round(sum(total_amount), 2) AS revenue,
    round(avg(trip_distance) + 1e-9, 6) AS avg_distance FROM fact GROUP BY 1, 2) f
LEFT JOIN zones a ON a.LocationID = f.pulocation_id LEFT JOIN zones d ON d.LocationID = f.dolocation_id""",
        _ZONES,
    ),
    "q_revenue_by_hour": _with_fact(
        """
SELECT pickup_hour, count(*) AS trips, round(sum(total_amount), 2) AS revenue,
  round(avg(total_amount) + 1e-9, 6) AS avg_revenue FROM fact GROUP BY 1"""
    ),
    "q_revenue_by_location": _with_fact(
        """
SELECT f.*, z.Borough AS pickup_borough, z.Zone AS pickup_zone
FROM (SELECT pulocation_id, count(*) AS trips, round(sum(total_amount), 2) AS revenue,
    round(avg(total_amount) + 1e-9, 6) AS avg_revenue FROM fact GROUP BY 1) f
LEFT JOIN zones z ON z.LocationID = f.pulocation_id""",
        _ZONES,
    ),
    "q_fare_by_date": _with_fact(
        """
SELECT pickup_date, round(quantile_cont(fare_amount, 0.5) + 1e-9, 6) AS median_fare, round(avg(fare_amount) + 1e-9, 6) AS avg_fare,
  min(fare_amount) AS min_fare, max(fare_amount) AS max_fare FROM fact GROUP BY 1"""
    ),
    "q_efficiency": _with_silver(
        "\nSELECT "
        + _BUCKET.format(h="hour(tpep_pickup_datetime)")
        + """ AS time_bucket, count(*) AS trips, round(avg(avg_speed_mph) + 1e-9, 6) AS avg_speed_mph,
  round(avg(fare_per_min) + 1e-9, 6) AS avg_fare_per_min, round(avg(fare_per_mile) + 1e-9, 6) AS avg_fare_per_mile
FROM silver GROUP BY 1"""
    ),
    "q_tip_behavior": _with_fact(
        """
SELECT payment_type, count(*) AS trips, round(avg(CAST(tip_amount > 0 AS INT)) + 1e-9, 6) AS tipped_share,
  round(avg(tip_amount) + 1e-9, 6) AS avg_tip, round(avg(tip_amount / nullif(total_amount, 0)) + 1e-9, 6) AS avg_tip_ratio
FROM fact GROUP BY 1"""
    ),
    "q_zone_traffic": _with_fact(
        """
SELECT zone_id, CAST(sum(p) AS BIGINT) AS pickups, CAST(sum(d) AS BIGINT) AS dropoffs, count(*) AS total
FROM (SELECT pulocation_id AS zone_id, 1 AS p, 0 AS d FROM fact UNION ALL SELECT dolocation_id, 0, 1 FROM fact)
GROUP BY 1"""
    ),
    # landing, bronze, write path
    "q_landing_split": _raw(
        f' SELECT day AS date, count(*) AS rows, count(tpep_dropoff_datetime) AS dropoffs FROM {_LANDED} GROUP BY 1'
    ),
    "q_bronze_incremental": _raw(
        f" SELECT day AS ingestion_date, count(*) AS rows FROM {_LANDED} GROUP BY 1"
    ),
    "q_missing_days": _raw(
        """
SELECT CAST(d AS DATE) AS day FROM (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-02-05', INTERVAL 1 DAY)) AS d)
WHERE CAST(d AS DATE) NOT IN (SELECT tpep_pickup_datetime::DATE FROM trips)"""
    ),
    "q_latest_partition": _raw(f" SELECT max(day) AS latest_day FROM {_LANDED}"),
    "q_partition_replace": _with_fact(
        """
SELECT pickup_date, count(*) AS trips,
  round(sum(CASE WHEN pickup_date = DATE '2024-01-10' THEN total_amount * 2 ELSE total_amount END), 2) AS revenue
FROM fact GROUP BY 1"""
    ),
    "q_wap": _with_silver(
        """, parts AS (SELECT CASE WHEN pickup_date <= DATE '2024-01-15' THEN 'run-1' ELSE 'run-2' END AS run_id,
  pickup_date = DATE '2024-01-20' AS holed, trip_id FROM silver)
SELECT run_id, bool_and(NOT holed) AS published, count(*) AS rows, count(*) > 0 AS has_rows,
  bool_and(NOT holed) AS no_null_tpep_pickup_datetime, count(DISTINCT trip_id) = count(*) AS unique_trip_id,
  (SELECT count(*) FROM parts WHERE run_id = 'run-1') AS table_rows
FROM parts GROUP BY run_id"""
    ),
    "q_backfill": _with_silver(
        _KEY_AUDIT.format(table="silver", more=", min(trip_id) AS lowest_key, max(trip_id) AS highest_key")
    ),
    "q_upsert_null_partition": _with_silver(
        """ SELECT * REPLACE (CASE WHEN pickup_date = DATE '2024-01-20' AND vendor_id = 1 THEN extra + 1 ELSE extra END AS extra,
  CASE WHEN pickup_date <> DATE '2024-01-20' THEN pickup_date END AS pickup_date) FROM silver"""
    ),
    "q_backfill_new_column": _with_silver(
        """ SELECT trip_id, CASE WHEN pickup_date <> DATE '2024-01-20' THEN pickup_date END AS pickup_date, total_amount FROM silver"""
    ),
    "q_upsert_indexed": _with_silver(
        """
SELECT trip_id, CAST(pickup_date + CASE WHEN pickup_date = DATE '2024-01-09' AND pulocation_id <= 40 THEN CAST(pulocation_id % 3 AS INT) ELSE 0 END AS DATE) AS pickup_date,
  pulocation_id, total_amount FROM silver"""
    ),
    "q_evolved_schema": _with_silver(" SELECT trip_id, payment_type, pickup_date, total_amount FROM silver"),
    "q_rewrite_table": _with_fact(
        """ SELECT version, pickup_date, count(*) AS trips, round(sum(total_amount * factor), 2) AS revenue
FROM fact, (VALUES ('fact', 2), ('backup', 1)) AS v(version, factor) GROUP BY 1, 2"""
    ),
    "q_single_day": _raw(
        f" SELECT VendorID, tpep_pickup_datetime, total_amount FROM {_LANDED} WHERE day = DATE '2024-01-12'"
    ),
    "q_pipeline": _with_fact(
        _DAILY.format(where="WHERE pickup_date >= DATE '2024-01-01'")
    ),
    "q_pipeline_late": _with_fact(
        _DAILY.format(where="WHERE pickup_date >= DATE '2024-01-01'")
    ),
    "q_pipeline_marts": _with_fact(
        _MARTS, "kept AS (SELECT * FROM fact WHERE pickup_date >= DATE '2024-01-01')", _ZONES
    ),
    "q_pipeline_dims": _with_fact(
        """
SELECT d.year, d.month, d.is_weekend, d.time_bucket, p.payment_name, z.Borough AS pickup_borough, count(*) AS trips,
  round(sum(f.total_amount), 2) AS revenue
FROM fact f JOIN dates d USING (pickup_date, pickup_hour) LEFT JOIN payments p USING (payment_type)
  LEFT JOIN zones z ON z.LocationID = f.pulocation_id
WHERE f.pickup_date >= DATE '2024-01-01' GROUP BY ALL""",
        _DATES,
        _PAYMENTS,
        _ZONES,
    ),
    # profiling
    "q_null_fraction": _raw(
        _union(
            [
                f"SELECT '{c}' AS column_name, round(avg(CAST({c} IS NULL AS INT)) + 1e-9, 6) AS null_fraction FROM trips"
                for c in _ALL_COLUMNS
            ]
        )
    ),
    "q_value_counts": _raw(
        _union(
            [
                f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS rows FROM flagged GROUP BY 2"
                for c in (
                    "VendorID",
                    "passenger_count",
                    "RatecodeID",
                    "payment_type",
                    "store_and_fwd_flag",
                    "is_weekend",
                )
            ]
        ),
        "flagged AS (SELECT *, dayofweek(tpep_pickup_datetime) IN (0, 6) AS is_weekend FROM trips)",
    ),
    "q_numeric_summary": _raw(
        _union(
            [
                f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}) + 1e-9, 6) AS mean,
  round(stddev_samp({c}) + 1e-9, 6) AS std, CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.25) + 1e-9, 6) AS p25, round(quantile_cont(CAST({c} AS DOUBLE), 0.5) + 1e-9, 6) AS p50,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.75) + 1e-9, 6) AS p75 FROM trips"""
                for c in _NUMERIC
            ]
        )
    ),
    "q_dropoff_dates": _raw(" SELECT tpep_dropoff_datetime::DATE AS day, count(*) AS rows FROM trips GROUP BY 1"),
    "q_range_violations": _raw(
        _union(
            [
                f"SELECT '{n}' AS \"check\", count(*) FILTER ({p}) AS violations FROM trips"
                for n, p in _CHECKS.items()
            ]
        )
    ),
    "q_duplicate_rows": _raw(
        """
SELECT (SELECT count(*) FROM trips) AS total_rows, count(*) AS distinct_rows,
  (SELECT count(*) FROM trips) - count(*) AS duplicate_rows FROM (SELECT DISTINCT * FROM trips)"""
    ),
    "q_distinct_values": _raw(
        " SELECT DISTINCT tpep_pickup_datetime::DATE AS ingestion_date FROM trips ORDER BY 1 LIMIT 10"
    ),
    # maintenance
    "q_compact": _with_fact(
        """
SELECT pickup_date, count(*) AS rows, round(sum(total_amount), 2) AS revenue, CAST(8 AS BIGINT) AS files_before,
  CAST(1 AS BIGINT) AS files_after FROM fact GROUP BY 1"""
    ),
    "q_maintain": _with_fact(
        """, runs AS (
  SELECT pickup_date, row_number() OVER (ORDER BY pickup_date DESC) > 15
    AND pickup_date < DATE '2024-02-10' - INTERVAL 20 DAY AS gone
  FROM (SELECT DISTINCT pickup_date FROM fact)
)
SELECT step, true AS ok, CAST(CASE step WHEN 'compact' THEN (SELECT count(*) FROM runs)
    WHEN 'expire' THEN (SELECT count(*) FROM runs WHERE gone) WHEN 'after' THEN 0 ELSE 1 END AS BIGINT) AS items,
  (SELECT count(*) FROM runs WHERE NOT gone) AS kept_runs, (SELECT count(*) FROM fact) AS rows
FROM (VALUES ('compact'), ('expire'), ('orphans'), ('remove'), ('after')) AS s(step)"""
    ),
    "q_expire_select": """
SELECT o_orderstatus AS table_path, o_orderkey AS run_id, o_orderdate AS committed_at FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders)
WHERE r > 10 AND o_orderdate < (SELECT max(o_orderdate) FROM orders) - INTERVAL 30 DAY""",
    "q_orphans": """
SELECT concat('file-', p_partkey) AS path, p_size AS length FROM part WHERE p_partkey NOT IN (
  SELECT l_partkey FROM lineitem WHERE l_shipdate >= (SELECT max(l_shipdate) FROM lineitem) - INTERVAL 30 DAY)""",
    # metric samples
    "q_rate_5m": _RATE,
    "q_counter_rate": """
WITH linked AS (
  SELECT ts, user_id, event_type, value,
    lag(value) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS prev FROM events
)
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, user_id, event_type,
  round(sum(CASE WHEN value < prev THEN value ELSE value - prev END) + 1e-9, 6) AS increase,
  round(sum(CASE WHEN value < prev THEN value ELSE value - prev END) / 300.0 + 1e-9, 6) AS rate
FROM linked GROUP BY 1, 2, 3""",
    "q_counter_increase_alert": """
WITH linked AS (
  SELECT ts, user_id, event_type, value,
    lag(value) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS prev FROM events
)
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, user_id, event_type,
  round(sum(CASE WHEN value < prev THEN value ELSE value - prev END) + 1e-9, 6) AS increase
FROM linked GROUP BY 1, 2, 3 HAVING sum(CASE WHEN value < prev THEN value ELSE value - prev END) > 50""",
    "q_increase_alert": """
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, event_type, count(*) AS increase
FROM events GROUP BY 1, 2 HAVING count(*) > 2""",
    "q_sliding_increase": _SLIDING
    + """
SELECT range_end, event_type, increase, increase AS samples, round(increase / 300.0 + 1e-9, 6) AS rate FROM ranges""",
    "q_sliding_alert": _SLIDING
    + """, numbered AS (
  SELECT *, range_end - to_minutes(row_number() OVER (PARTITION BY event_type ORDER BY range_end)) AS island
  FROM ranges WHERE increase > 2
)
SELECT event_type, min(range_end) AS first_step, max(range_end) AS last_step, count(*) AS steps, max(increase) AS peak
FROM numbered GROUP BY event_type, island""",
    "q_sliding_counter": """
WITH linked AS (
  SELECT ts, user_id, event_type, value,
    lag(value) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS prev FROM events
), grown AS (SELECT *, coalesce(CASE WHEN value < prev THEN value ELSE value - prev END, 0) AS delta FROM linked
), steps AS (
  SELECT DISTINCT user_id, event_type, time_bucket(INTERVAL 10 MINUTE, ts) + to_minutes(10 * i) AS range_end
  FROM events, (SELECT unnest(range(1, 7)) AS i)
)
SELECT s.range_end, s.user_id, s.event_type, round(sum(delta) + 1e-9, 6) AS increase, count(*) AS samples,
  round(sum(delta) / 3600.0 + 1e-9, 6) AS rate
FROM steps s JOIN grown g ON g.user_id = s.user_id AND g.event_type = s.event_type
  AND g.ts >= s.range_end - INTERVAL 1 HOUR AND g.ts < s.range_end
GROUP BY ALL""",
    "q_sustained": """
WITH marked AS (
  SELECT user_id, ts, event_type, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END)
    OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM events
)
SELECT user_id, min(ts) AS run_start, max(ts) AS run_end, count(*) AS run_rows,
  round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0 + 1e-9, 6) AS seconds
FROM marked WHERE event_type = 'error' GROUP BY user_id, run
HAVING epoch_us(max(ts)) - epoch_us(min(ts)) >= 60000000""",
    "q_ratio_band": """
SELECT *, CASE WHEN error_pct < 18 THEN 'green' WHEN error_pct <= 22 THEN 'yellow' ELSE 'red' END AS band FROM (
  SELECT ts::DATE AS day, count(*) FILTER (event_type = 'error') AS errors, count(*) AS samples,
    round(count(*) FILTER (event_type = 'error') * 100.0 / count(*) + 1e-9, 6) AS error_pct
  FROM events GROUP BY 1)""",
    "q_success_rate": _HOURS
    + """
SELECT unit_start, coalesce(successes, 0) AS successes, coalesce(failures, 0) AS failures,
  round(successes * 100.0 / nullif(successes + failures, 0) + 1e-9, 6) AS success_pct
FROM hours LEFT JOIN tally USING (unit_start)""",
    "q_latest_sum": """
SELECT event_type, count(*) AS series, round(sum(value) + 1e-9, 6) AS total FROM (
  SELECT event_type, value, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) AS r
  FROM events) WHERE r = 1 GROUP BY 1""",
    "q_label_regex": """
SELECT event_type, ts::DATE AS day, count(*) AS samples, round(sum(value) + 1e-9, 6) AS total
FROM events WHERE regexp_full_match(event_type, 'err.*|purchase') GROUP BY 1, 2""",
    "q_state_breakdown": _BREAKDOWN,
    "q_heartbeat_gaps": _GAPS,
    "q_uptime": """
SELECT user_id, min(ts) AS started,
  round((epoch_us((SELECT max(ts) FROM events)) - epoch_us(min(ts))) / 1000000.0 + 1e-9, 6) AS uptime_seconds
FROM events GROUP BY 1""",
    "q_name_labels": """
SELECT CASE event_type WHEN 'error' THEN 'app_errors_total' WHEN 'purchase' THEN 'app_purchases_total'
    ELSE 'app_views_total' END AS metric, CAST(user_id AS VARCHAR) AS "user", count(*) AS samples
FROM events WHERE event_type IN ('error', 'purchase', 'view') GROUP BY 1, 2""",
    "q_error_rate": _HOURS
    + """
SELECT unit_start, coalesce(requests, 0) AS requests, coalesce(failures, 0) AS errors,
  round(coalesce(failures * 100.0 / nullif(requests, 0), 0.0) + 1e-9, 6) AS error_pct
FROM hours LEFT JOIN tally USING (unit_start)""",
    # streaming
    "q_stream_bronze": _raw(f" SELECT day AS ingestion_date, count(*) AS rows FROM {_LANDED} GROUP BY 1"),
    "q_stream_silver": _with_fact(
        """
SELECT f.*, z.Borough AS pickup_borough, z.Zone AS pickup_zone FROM fact f LEFT JOIN zones z ON z.LocationID = f.pulocation_id
WHERE f.pickup_date >= DATE '2024-01-01'""",
        _ZONES,
    ),
    "q_stream_state_breakdown": _BREAKDOWN,
    "q_stream_rate": _RATE,
    "q_stream_sessions": _SESSIONS.format(minutes=30, where=""),
    "q_stream_error_sessions": _SESSIONS.format(minutes=360, where="WHERE event_type = 'error'"),
    "q_stream_silence": _GAPS,
}
