"""Registry of queries: name -> callable(spark, sf_dir) returning a DataFrame.

Every query reads whole tables of ``sf_dir``. Aggregated doubles are rounded here and in the
SQL oracles alike; the operators themselves never round.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import DateRange, shared_dir, stored
from strata.functions import calendar, codes
from strata.functions.keys import record_key, with_key
from strata.operators import audit, clean, dedup, dims, marts, partials, profile, sketches, sliding, telemetry
from strata.operators.upsert import upsert
from strata.plans import trips as taxi
from strata.plans.pipeline import MART_TABLE, Layout, run_pipeline
from strata.sources import evolution, key_index, maintenance, publish, readers, writers
from strata.sources.contracts import RAW_TRIP, contract
from strata.streaming import ingest
from strata.streaming import silver as silver_streams
from strata.streaming import telemetry as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, **money: int) -> DataFrame:
    """Round all double columns: those in ``money`` to that many digits, ratios to six.

    The order of a distributed sum, and so its last bit, is not fixed. An average that ends
    in an exact 5 after the sixth digit would go either way; the added 1e-9 settles it.
    """
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns(
        {c: F.round(c, money[c]) if c in money else F.round(F.col(c) + F.lit(1e-9), 6) for c in doubles}
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxi.raw_trips(spark, sf_dir)


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxi.trip_facts(raw(spark, sf_dir))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxi.table(spark, sf_dir, "events")


ORDER = ["ts", "event_id"]


# --- cleaning, features, keys ------------------------------------------------------------


@query
def q_daily_summary(spark, sf_dir):
    return rounded(marts.daily_summary(facts(spark, sf_dir)), total_revenue=2, total_fare=2)


@query
def q_clean(spark, sf_dir):
    return clean.apply_rules(raw(spark, sf_dir), taxi.RULES)


@query
def q_features(spark, sf_dir):
    return taxi.clean_trips(raw(spark, sf_dir))


@query
def q_dedup(spark, sf_dir):
    return taxi.silver_trips(raw(spark, sf_dir))


def _old_and_new(spark, sf_dir, gathered_by=None):
    trips = stored(taxi.silver_trips(raw(spark, sf_dir), gathered_by=gathered_by), "silver")  # read as target and as source
    old = trips.where(F.col("pickup_date") <= dt.date(2024, 1, 20))
    new = trips.where(F.col("pickup_date") >= dt.date(2024, 1, 15)).withColumn("extra", F.col("extra") + 1)
    return old, new


@query
def q_upsert(spark, sf_dir):
    old, new = _old_and_new(spark, sf_dir)
    return upsert(old, new, ["trip_id"])


@query
def q_upsert_table(spark, sf_dir):
    path = shared_dir(spark, "silver")
    old, new = _old_and_new(spark, sf_dir, "pickup_date")
    writers.replace_partitions(old, path, ["pickup_date"], gathered=True)
    writers.upsert_into(spark, path, new, ["trip_id"], "pickup_date", gathered=True)
    return spark.read.parquet(path).select(*old.columns)


@query
def q_key_legacy(spark, sf_dir):
    keyed = with_key(raw(spark, sf_dir), taxi.LEGACY_KEY_COLUMNS, "trip_id")
    return keyed.select("trip_id", *taxi.LEGACY_KEY_COLUMNS)


@query
def q_key_audit(spark, sf_dir):
    return rounded(audit.key_audit(taxi.clean_trips(raw(spark, sf_dir)), "trip_id"))


@query
def q_reject_report(spark, sf_dir):
    return clean.reject_report(raw(spark, sf_dir), taxi.RULES)


@query
def q_rejected_rows(spark, sf_dir):
    return clean.rejected(raw(spark, sf_dir), taxi.RULES)


@query
def q_parse_times(spark, sf_dir):
    """Times written as text in two formats, some of them broken: what is read back per day."""
    number = F.col("event_id") % 10
    text = F.when(number == 0, "n/a").when(number < 5, F.date_format("ts", "dd/MM/yyyy HH:mm")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    )
    parsed = calendar.parse_timestamp(text, "yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm")
    read = events(spark, sf_dir).select(parsed.alias("at"))
    return read.groupBy(F.to_date("at").alias("day")).agg(
        F.count(F.lit(1)).alias("samples"), F.min("at").alias("first_at"), F.max("at").alias("last_at")
    )


@query
def q_sample_rows(spark, sf_dir):
    """Twenty rows to look at, the same ones every time."""
    items = taxi.table(spark, sf_dir, "lineitem")
    return profile.sample_rows(items, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], 20)


# --- dimensions --------------------------------------------------------------------------


@query
def q_dim_date(spark, sf_dir):
    days = raw(spark, sf_dir).select(F.to_date(taxi.PICKUP).alias("pickup_date"))
    return dims.dim_date_for(days)


@query
def q_dim_zone(spark, sf_dir):
    """Zone attributes of every location that occurs in accepted trips."""
    traffic = marts.zone_traffic(facts(spark, sf_dir)).select("zone_id", "total")
    return marts.with_zone(traffic, taxi.zones(spark, sf_dir), "zone_id", "zone")


@query
def q_dim_payment(spark, sf_dir):
    """The payment dimension with the number of accepted trips, zero included."""
    used = facts(spark, sf_dir).groupBy("payment_type").agg(marts.trips())
    return dims.dim_payment(spark).join(used, "payment_type", "left").fillna(0, ["trips"])


@query
def q_decode(spark, sf_dir):
    labels = {
        "vendor": codes.decode(F.col("VendorID"), codes.VENDORS, "Unknown"),
        "rate": codes.decode(F.col("RatecodeID"), codes.RATE_CODES, "Unknown"),
        "store_flag": codes.decode(F.col("store_and_fwd_flag"), codes.STORE_FLAGS, "Unknown"),
        "payment": codes.decode(F.col("payment_type"), codes.PAYMENT_TYPES, "Unknown"),
    }
    named = raw(spark, sf_dir).select(*(c.alias(n) for n, c in labels.items()))
    return named.groupBy(*labels).agg(marts.trips())


# --- marts -------------------------------------------------------------------------------


@query
def q_fact_trips(spark, sf_dir):
    return facts(spark, sf_dir)


@query
def q_kpi_tiles(spark, sf_dir):
    daily = marts.daily_summary(facts(spark, sf_dir))
    return rounded(marts.kpi_tiles_from_daily(daily), total_revenue=2)


@query
def q_kpi_sliced(spark, sf_dir):
    fact = facts(spark, sf_dir)
    days = raw(spark, sf_dir).select(F.to_date(taxi.PICKUP).alias("pickup_date"))
    chosen = marts.sliced(fact, dims.dim_date_for(days), 1, 15, [1, 2], ["morning"])
    return rounded(marts.kpi_tiles(chosen), total_revenue=2)


@query
def q_kpi_sliced_published(spark, sf_dir):
    """The sliced tiles over the published fact: the filtered dimension prunes the days that are read."""
    root = shared_dir(spark, "gold")
    writers.replace_partitions(facts(spark, sf_dir), f"{root}/fact_trips", ["pickup_date"])
    days = raw(spark, sf_dir).select(F.to_date(taxi.PICKUP).alias("pickup_date"))
    writers.write_once(dims.dim_date_for(days), f"{root}/dim_date")
    fact, dates = spark.read.parquet(f"{root}/fact_trips"), spark.read.parquet(f"{root}/dim_date")
    return rounded(marts.kpi_tiles(marts.sliced(fact, dates, 1, 15, [1, 2], ["morning"])), total_revenue=2)


@query
def q_kpi_cube(spark, sf_dir):
    """All slicer combinations and totals at once; payment type 3 is taken as unknown."""
    known = F.when(F.col("payment_type") != 3, F.col("payment_type"))
    slicers = {
        "is_weekend": calendar.is_weekend(F.col("pickup_date")),
        "time_bucket": calendar.time_bucket(F.col("pickup_hour")),
        "payment_type": known,
    }
    fact = facts(spark, sf_dir).withColumns(slicers)
    return rounded(marts.kpi_cube(fact, list(slicers)), total_revenue=2)


@query
def q_calendar_revenue(spark, sf_dir):
    """Fact joined to the date dimension on day and hour."""
    fact = facts(spark, sf_dir)
    days = raw(spark, sf_dir).select(F.to_date(taxi.PICKUP).alias("pickup_date"))
    dated = marts.with_date(fact, dims.dim_date_for(days))
    return rounded(
        dated.groupBy("year", "quarter", "month", "is_weekend", "time_bucket", "is_rush_hour").agg(
            marts.trips(), F.sum("total_amount").alias("revenue")
        ),
        revenue=2,
    )


@query
def q_heatmap(spark, sf_dir):
    return marts.heatmap(facts(spark, sf_dir))


@query
def q_heatmap_matrix(spark, sf_dir):
    matrix = marts.heatmap_matrix(facts(spark, sf_dir))
    return matrix.withColumnsRenamed({str(h): f"h{h:02d}" for h in range(24)})


@query
def q_daily_trend(spark, sf_dir):
    return rounded(marts.daily_trend(marts.daily_summary(facts(spark, sf_dir))))


@query
def q_top_zones(spark, sf_dir):
    return marts.top_zones(facts(spark, sf_dir), taxi.zones(spark, sf_dir))


@query
def q_distance_fare(spark, sf_dir):
    return rounded(marts.distance_fare(facts(spark, sf_dir)))


@query
def q_fare_outliers(spark, sf_dir):
    return rounded(marts.fare_outliers(facts(spark, sf_dir)))


@query
def q_fare_bins(spark, sf_dir):
    return marts.binned_distance_fare(facts(spark, sf_dir))


@query
def q_payment_share(spark, sf_dir):
    return rounded(marts.payment_share(facts(spark, sf_dir), dims.dim_payment(spark)))


@query
def q_weekend_split(spark, sf_dir):
    return rounded(marts.weekend_split(facts(spark, sf_dir)), revenue=2)


@query
def q_tip_by_band(spark, sf_dir):
    return rounded(marts.tip_by_band(facts(spark, sf_dir)))


@query
def q_rush_hour(spark, sf_dir):
    return rounded(marts.rush_hour_split(facts(spark, sf_dir)), revenue=2)


@query
def q_od_pairs(spark, sf_dir):
    return rounded(marts.od_pairs(facts(spark, sf_dir), taxi.zones(spark, sf_dir)), revenue=2)


@query
def q_revenue_by_hour(spark, sf_dir):
    return rounded(marts.revenue_by_hour(facts(spark, sf_dir)), revenue=2)


@query
def q_revenue_by_location(spark, sf_dir):
    return rounded(marts.revenue_by_location(facts(spark, sf_dir), taxi.zones(spark, sf_dir)), revenue=2)


@query
def q_fare_by_date(spark, sf_dir):
    return rounded(marts.fare_by_date(facts(spark, sf_dir)))


@query
def q_efficiency(spark, sf_dir):
    return rounded(marts.efficiency(taxi.timed_trips(raw(spark, sf_dir))))


@query
def q_tip_behavior(spark, sf_dir):
    return rounded(marts.tip_behavior(facts(spark, sf_dir)))


@query
def q_zone_traffic(spark, sf_dir):
    return marts.zone_traffic(facts(spark, sf_dir))


def _sketched(spark, sf_dir):
    """Trips with copies and their daily sketches, of origin and destination as one key."""
    trips = taxi.clean_trips(raw(spark, sf_dir)).select(
        "pickup_date", F.concat_ws("-", "pulocation_id", "dolocation_id", "vendor_id").alias("route"), "fare_amount"
    )
    return trips, stored(sketches.daily_sketches(trips, "pickup_date", "route", "fare_amount"), "daily-sketches")


@query
def q_distinct_sketches(spark, sf_dir):
    """Distinct routes per week from daily sketches, held against the exact number."""
    trips, daily = _sketched(spark, sf_dir)
    week = F.trunc("pickup_date", "week").alias("week")
    exact = trips.groupBy(week).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("route").alias("distinct_routes"))
    estimated = sketches.merged_distinct(daily, week).select("week", "distinct_keys")
    close = F.abs(F.col("distinct_keys") - F.col("distinct_routes")) <= F.col("distinct_routes") * sketches.DISTINCT_ERROR
    return exact.join(estimated, "week").withColumn("within_error", close).drop("distinct_keys")


@query
def q_shared_routes(spark, sf_dir):
    """Routes that both halves of the month know, from daily set sketches, held against the exact number."""
    trips, daily = _sketched(spark, sf_dir)
    halves = F.col("pickup_date") < dt.date(2024, 1, 16), F.col("pickup_date") >= dt.date(2024, 1, 16)
    per_route = trips.groupBy("route").agg(*(F.max(h).alias(n) for h, n in zip(halves, ("a", "b"))))
    exact = per_route.agg(
        F.count_if("a").alias("first_routes"), F.count_if("b").alias("second_routes"), F.count_if(F.col("a") & F.col("b")).alias("shared_routes")
    )
    both = exact.unionByName(sketches.shared_keys(daily, *halves), allowMissingColumns=True)  # one row each
    found = both.agg(*(F.max(c).alias(c) for c in both.columns))
    pairs = (("first_routes", "first_keys"), ("second_routes", "second_keys"), ("shared_routes", "shared_keys"))
    limit = F.greatest("first_routes", "second_routes") * 2 * sketches.SET_ERROR
    close = [F.abs(F.col(a) - F.col(b)) <= limit for a, b in pairs]
    return found.select("first_routes", "second_routes", "shared_routes", (close[0] & close[1] & close[2]).alias("within_error"))


@query
def q_weekly_percentiles(spark, sf_dir):
    """Fare quantiles per week from daily sketches, held against their true ranks."""
    trips, daily = _sketched(spark, sf_dir)
    wanted = {"p50": 0.5, "p90": 0.9, "p99": 0.99}
    estimates = sketches.merged_quantiles(daily, wanted, F.trunc("pickup_date", "week").alias("week"))
    dated = trips.withColumn("week", F.trunc("pickup_date", "week"))
    errors = sketches.rank_errors(dated, stored(estimates, "weekly-quantiles"), "fare_amount", wanted, ["week"])
    close = F.greatest(*(F.col(n) for n in wanted)) <= sketches.RANK_ERROR
    return errors.select("week", "rows", close.alias("within_error"))


# --- landing, bronze, write path ---------------------------------------------------------


def _land(spark, sf_dir) -> str:
    """All days in two parts, as two deliveries would land them."""
    landing, middle = shared_dir(spark, "landing"), F.lit(dt.datetime(2024, 1, 11)).cast("timestamp_ntz")
    for part in (F.col(taxi.PICKUP) < middle, F.col(taxi.PICKUP) >= middle):
        writers.split_by_day(raw(spark, sf_dir).where(part), landing, taxi.PICKUP, "date", taxi.TAXI.landing_from)
    return landing


def _land_late(spark, sf_dir) -> str:
    """Half of the trips land two days after their pickup day."""
    landing = shared_dir(spark, "landing")
    late = F.pmod(F.col("PULocationID"), F.lit(2)) == 1
    landed_on = F.when(late, F.date_add(F.to_date(taxi.PICKUP), 2)).otherwise(F.to_date(taxi.PICKUP))
    trips = raw(spark, sf_dir).where(F.col(taxi.PICKUP) >= F.lit(taxi.TAXI.landing_from)).withColumn("date", landed_on)
    writers.replace_partitions(trips, landing, ["date"])
    return landing


@query
def q_landing_split(spark, sf_dir):
    landed = spark.read.parquet(_land(spark, sf_dir))
    return landed.groupBy("date").agg(F.count(F.lit(1)).alias("rows"), F.count(taxi.DROPOFF).alias("dropoffs"))


@query
def q_bronze_incremental(spark, sf_dir):
    landing, bronze = _land(spark, sf_dir), shared_dir(spark, "bronze")
    writers.append_new_days(spark, landing, bronze, DateRange.of("2024-01-01", "2024-01-20"))
    writers.append_new_days(spark, landing, bronze, DateRange.of("2024-01-10", "2024-01-31"))
    return spark.read.parquet(bronze).groupBy("ingestion_date").agg(F.count(F.lit(1)).alias("rows"))


@query
def q_missing_days(spark, sf_dir):
    dated = raw(spark, sf_dir).select(F.to_date(taxi.PICKUP).alias("date"))
    return readers.missing_days(spark, DateRange.of("2024-01-01", "2024-02-05"), dated, "date")


@query
def q_latest_partition(spark, sf_dir):
    landed = readers.present_days(spark, _land(spark, sf_dir), "date")
    return readers.latest_partition(landed, "date").withColumnRenamed("date", "latest_day")


@query
def q_partition_replace(spark, sf_dir):
    path = shared_dir(spark, "fact")
    fact = facts(spark, sf_dir)
    writers.replace_partitions(fact, path, ["pickup_date"])
    one_day = fact.where(F.col("pickup_date") == dt.date(2024, 1, 10))
    doubled = one_day.withColumn("total_amount", F.col("total_amount") * 2)
    writers.replace_partitions(doubled, path, ["pickup_date"])
    return rounded(
        spark.read.parquet(path).groupBy("pickup_date").agg(F.sum("total_amount").alias("revenue"), marts.trips()),
        revenue=2,
    )


@query
def q_wap(spark, sf_dir):
    root = shared_dir(spark, "wap")
    path, log = f"{root}/silver", f"{root}/log"
    silver = taxi.silver_trips(raw(spark, sf_dir))
    checks = audit.increment_checks(taxi.PICKUP, "trip_id")
    first = silver.where(F.col("pickup_date") <= dt.date(2024, 1, 15))
    holes = F.when(F.col("pickup_date") != dt.date(2024, 1, 20), F.col(taxi.PICKUP))
    second = silver.where(F.col("pickup_date") > dt.date(2024, 1, 15)).withColumn(taxi.PICKUP, holes)
    results = [
        publish.publish(part, path, ["pickup_date"], checks, run, log)
        for run, part in (("run-1", first), ("run-2", second))
    ]
    schema = contract(run_id="string", **{c: "boolean" for c in checks})
    audits = readers.literal_table(spark, [(r.run_id, *r.audit.values()) for r in results], schema)
    visible = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n")).scalar()
    return (
        spark.read.parquet(log)
        .select("run_id", "published", "rows")
        .join(audits, "run_id")
        .withColumn("table_rows", visible)
    )


@query
def q_backfill(spark, sf_dir):
    path = shared_dir(spark, "silver")
    silver = taxi.silver_trips(raw(spark, sf_dir))
    gaps = F.when(F.dayofmonth("pickup_date") % 2 == 0, F.col("trip_id"))
    writers.replace_partitions(silver.withColumn("trip_id", gaps), path, ["pickup_date"])
    columns = [taxi.RENAMES.get(c, c) for c in taxi.KEY_COLUMNS]
    writers.backfill_column(spark, path, "trip_id", lambda df: record_key(df, columns), "pickup_date")
    filled = spark.read.parquet(path)
    lowest, highest = (
        filled.agg(f("trip_id").alias("v")).scalar() for f in (F.min, F.max)
    )
    return rounded(
        audit.key_audit(filled, "trip_id").withColumns({"lowest_key": lowest, "highest_key": highest})
    )


@query
def q_pipeline(spark, sf_dir):
    """Landing to gold for two overlapping ranges; the daily summary that readers see."""
    layout, landing = Layout(shared_dir(spark, "lake")), _land(spark, sf_dir)
    for run, days in enumerate((("2024-01-01", "2024-01-20"), ("2024-01-15", "2024-01-31"))):
        result = run_pipeline(spark, taxi.TAXI, layout, landing, DateRange.of(*days), f"run-{run}", marts=False)
        if not result.published:
            raise RuntimeError(f"audit failed: {result}")
    daily = spark.read.parquet(layout.path("agg_daily_summary"))
    return rounded(daily, total_revenue=2, total_fare=2)


@query
def q_pipeline_marts(spark, sf_dir):
    """All marts from the partials that three runs published, half of the trips landing two days late."""
    layout, landing = Layout(shared_dir(spark, "lake")), _land_late(spark, sf_dir)
    for run, days in enumerate((("2024-01-01", "2024-01-12"), ("2024-01-13", "2024-01-24"), ("2024-01-25", "2024-02-05"))):
        run_pipeline(spark, taxi.TAXI, layout, landing, DateRange.of(*days), f"run-{run}")
    published, zones = spark.read.parquet(layout.path(MART_TABLE)), taxi.zones(spark, sf_dir)
    tables = {
        "daily_summary": (partials.daily_summary(published), "pickup_date", "total_trips", "total_revenue", "avg_tip"),
        "revenue_by_hour": (partials.revenue_by_hour(published), "pickup_hour", "trips", "revenue", "avg_revenue"),
        "weekly_revenue": (partials.weekly_revenue(published), "week", "trips", "revenue", "revenue_deviation"),
        "weekend_split": (partials.weekend_split(published), "is_weekend", "trips", "revenue", "avg_duration_min"),
        "rush_hour_split": (partials.rush_hour_split(published), "is_rush_hour", "trips", "revenue", "avg_duration_min"),
        "od_pairs": (partials.od_pairs(published, zones), F.concat_ws("-", "pickup_zone", "dropoff_zone", "pulocation_id", "dolocation_id"), "trips", "revenue", "avg_distance"),
        "revenue_by_location": (partials.revenue_by_location(published, zones), "pulocation_id", "trips", "revenue", "avg_revenue"),
        "zone_traffic": (partials.zone_traffic(published), "zone_id", "total", "pickups", "dropoffs"),
        "tip_behavior": (partials.tip_behavior(published), "payment_type", "trips", "tipped_share", "avg_tip_ratio"),
        "tip_by_band": (partials.tip_by_band(published), F.concat_ws("/", "distance_band", "time_bucket"), "trips", "avg_tip", "avg_tip_ratio"),
        "efficiency": (partials.efficiency(published), "time_bucket", "trips", "avg_speed_mph", "avg_fare_per_mile"),
        "fare_by_date": (partials.fare_by_date(published), "pickup_date", F.lit(0), "median_fare", "avg_fare"),
    }
    parts = [
        table.select(
            F.lit(name).alias("mart"), _column(key).cast("string").alias("key"), _column(n).cast("long").alias("trips"),
            _column(a).cast("double").alias("first_value"), _column(b).cast("double").alias("second_value"),
        )
        for name, (table, key, n, a, b) in tables.items()
    ]
    return rounded(reduce(DataFrame.unionByName, parts), first_value=2)


def _column(name):
    return F.col(name) if isinstance(name, str) else name


def _nulls_at(df, day, column="pickup_date"):
    return df.withColumn(column, F.when(F.col(column) != dt.date(2024, 1, day), F.col(column)))


@query
def q_upsert_null_partition(spark, sf_dir):
    """A table whose 20 January stands in the NULL partition; half of that is updated."""
    path = shared_dir(spark, "silver")
    silver = _nulls_at(taxi.silver_trips(raw(spark, sf_dir)), 20)
    writers.replace_partitions(silver, path, ["pickup_date"])
    half = silver.where("pickup_date IS NULL AND vendor_id = 1").withColumn("extra", F.col("extra") + 1)
    writers.upsert_into(spark, path, half, ["trip_id"], "pickup_date")
    return spark.read.parquet(path).select(*silver.columns)


@query
def q_backfill_new_column(spark, sf_dir):
    """A key column that the table lacks altogether, NULL partition included."""
    path = shared_dir(spark, "silver")
    silver = _nulls_at(taxi.silver_trips(raw(spark, sf_dir)), 20)
    writers.replace_partitions(silver.drop("trip_id"), path, ["pickup_date"])
    columns = [taxi.RENAMES.get(c, c) for c in taxi.KEY_COLUMNS]
    writers.backfill_column(spark, path, "trip_id", lambda df: record_key(df, columns), "pickup_date")
    return spark.read.parquet(path).select("trip_id", "pickup_date", "total_amount")


@query
def q_upsert_indexed(spark, sf_dir):
    """Trips whose pickup day was corrected: their old partition is found by the key index."""
    path = shared_dir(spark, "silver")
    silver = taxi.silver_trips(raw(spark, sf_dir)).select("trip_id", "pickup_date", "pulocation_id", "total_amount")
    writers.replace_partitions(silver, path, ["pickup_date"])
    key_index.index_keys(spark, path, f"{path}_keys", ["trip_id"], "pickup_date")
    corrected = silver.where((F.col("pickup_date") == dt.date(2024, 1, 9)) & (F.col("pulocation_id") <= 40))
    corrected = corrected.withColumn("pickup_date", F.date_add("pickup_date", F.pmod("pulocation_id", F.lit(3))))
    writers.upsert_into(spark, path, corrected, ["trip_id"], "pickup_date", key_fixes_partition=False, index_path=f"{path}_keys")
    return spark.read.parquet(path).select(*silver.columns)


@query
def q_evolved_schema(spark, sf_dir):
    """Older files lack the key and have a narrower payment type; all files are read under the newer schema."""
    path = shared_dir(spark, "silver")
    columns = [taxi.RENAMES.get(c, c) for c in taxi.KEY_COLUMNS]
    newer = taxi.silver_trips(raw(spark, sf_dir)).select("trip_id", *columns, "pickup_date")
    older = newer.drop("trip_id").withColumn("payment_type", F.col("payment_type").cast("int"))
    first = F.col("pickup_date") <= dt.date(2024, 1, 15)
    writers.replace_partitions(older.where(first), path, ["pickup_date"])
    writers.replace_partitions(newer.where(~first), path, ["pickup_date"])
    evolution.require_readable(spark, path, newer.schema)
    table = evolution.read_under(spark, path, newer.schema, {"trip_id": lambda df: record_key(df, columns)})
    return table.select("trip_id", "payment_type", "pickup_date", "total_amount")


@query
def q_rewrite_table(spark, sf_dir):
    """A whole table replaced by a computation on itself; the backup keeps the old amounts."""
    root = shared_dir(spark, "rewrite")
    facts(spark, sf_dir).write.parquet(f"{root}/fact")
    doubled = spark.read.parquet(f"{root}/fact").withColumn("total_amount", F.col("total_amount") * 2)
    writers.rewrite_table(doubled, f"{root}/fact", f"{root}/backup")
    both = [spark.read.parquet(f"{root}/{t}").withColumn("version", F.lit(t)) for t in ("fact", "backup")]
    return rounded(
        both[0].unionByName(both[1]).groupBy("version", "pickup_date").agg(
            marts.trips(), F.sum("total_amount").alias("revenue")
        ),
        revenue=2,
    )


@query
def q_single_day(spark, sf_dir):
    """One day of landing, read by its partition."""
    day = readers.read_day(spark, _land(spark, sf_dir), "date", "2024-01-12")
    return day.select("VendorID", taxi.PICKUP, "total_amount")


@query
def q_pipeline_late(spark, sf_dir):
    """Half of the trips land two days after their pickup day, so days that are published already grow."""
    layout, landing = Layout(shared_dir(spark, "lake")), _land_late(spark, sf_dir)
    for run, days in enumerate((("2024-01-01", "2024-01-12"), ("2024-01-13", "2024-01-24"), ("2024-01-25", "2024-02-05"))):
        run_pipeline(spark, taxi.TAXI, layout, landing, DateRange.of(*days), f"run-{run}", marts=False)
    daily = spark.read.parquet(layout.path("agg_daily_summary"))
    return rounded(daily, total_revenue=2, total_fare=2)


@query
def q_pipeline_dims(spark, sf_dir):
    """Fact, calendar, payment types and CSV zones as published; a second run leaves the dimensions alone."""
    layout, landing = Layout(shared_dir(spark, "lake")), _land(spark, sf_dir)
    zones, renamed = taxi.zones(spark, sf_dir), F.lit("changed after the first run")
    for run, days in enumerate((("2024-01-01", "2024-01-20"), ("2024-01-15", "2024-01-31"))):
        lookup = shared_dir(spark, "zones-csv")
        (zones.withColumn("Borough", renamed) if run else zones).write.option("header", "true").csv(lookup)
        run_pipeline(spark, taxi.TAXI, layout, landing, DateRange.of(*days), f"run-{run}", lookup, marts=False)
    fact, dates, payments, zone = (
        spark.read.parquet(layout.path(t)) for t in ("fact_trips", "dim_date", "dim_payment", "dim_zone")
    )
    dated = marts.with_date(fact.select("pickup_date", "pickup_hour", "payment_type", "pulocation_id", "total_amount"), dates)
    totals = dated.groupBy("year", "month", "is_weekend", "time_bucket", "payment_type", "pulocation_id").agg(
        marts.trips(), F.sum("total_amount").alias("revenue")
    )
    named = marts.with_zone(marts.with_payment(totals, payments), zone, "pulocation_id", "pickup")
    return rounded(
        named.groupBy("year", "month", "is_weekend", "time_bucket", "payment_name", "pickup_borough").agg(
            F.sum("trips").alias("trips"), F.sum("revenue").alias("revenue")
        ),
        revenue=2,
    )


# --- profiling ---------------------------------------------------------------------------


@query
def q_null_fraction(spark, sf_dir):
    return rounded(profile.null_fraction(raw(spark, sf_dir)))


@query
def q_value_counts(spark, sf_dir):
    flagged = raw(spark, sf_dir).withColumn("is_weekend", F.dayofweek(taxi.PICKUP).isin(1, 7))
    columns = ["VendorID", "passenger_count", "RatecodeID", "payment_type", "store_and_fwd_flag", "is_weekend"]
    return profile.value_counts(flagged, columns)


@query
def q_numeric_summary(spark, sf_dir):
    return rounded(profile.numeric_summary(raw(spark, sf_dir)))


@query
def q_dropoff_dates(spark, sf_dir):
    return profile.rows_per_day(raw(spark, sf_dir), taxi.DROPOFF)


@query
def q_range_violations(spark, sf_dir):
    return clean.violations(raw(spark, sf_dir), taxi.RANGE_CHECKS)


@query
def q_duplicate_rows(spark, sf_dir):
    return dedup.duplicate_rows(raw(spark, sf_dir))


@query
def q_distinct_values(spark, sf_dir):
    days = raw(spark, sf_dir).select(F.to_date(taxi.PICKUP).alias("ingestion_date"))
    return profile.distinct_values(days, "ingestion_date", limit=10)


# --- maintenance -------------------------------------------------------------------------


def _in_eight_files(fact):
    """Eight files a day, written by 64 tasks: each has one part of some days only."""
    part = F.pmod(F.xxhash64("trip_id"), F.lit(8)) * 8 + F.pmod(F.dayofmonth("pickup_date"), F.lit(8))
    return fact.repartitionById(64, part.cast("int"))


@query
def q_compact(spark, sf_dir):
    path = shared_dir(spark, "fact")
    _in_eight_files(facts(spark, sf_dir)).write.partitionBy("pickup_date").parquet(path)
    report = maintenance.compact(spark, path, ["pickup_date"])
    rows = spark.read.parquet(path).groupBy("pickup_date").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("total_amount").alias("revenue")
    )
    files = report.select("pickup_date", "files_before", "files_after")
    return rounded(rows.join(files, "pickup_date"), revenue=2)


@query
def q_maintain(spark, sf_dir):
    """All maintenance steps on a fact table of small files with one logged run per day."""
    root, path = shared_dir(spark, "lake"), shared_dir(spark, "fact")
    fact = facts(spark, sf_dir)
    _in_eight_files(fact).write.partitionBy("pickup_date").parquet(path)
    log = fact.select("pickup_date").distinct().select(
        F.lit(path).alias("table_path"),
        F.col("pickup_date").cast("string").alias("run_id"),
        F.lit(True).alias("published"),
        F.col("pickup_date").cast("timestamp").alias("committed_at"),
    )
    publish.write_log(log, f"{root}/log")
    publish.record_manifest(spark, path, "2024-01-31", f"{root}/manifest")
    table = maintenance.MaintainedTable(path, ("pickup_date",), f"{root}/log", f"{root}/manifest")
    compacted = maintenance.maintain(spark, [table], "weekly")
    # A writer that died left a file that no run knows: too young to go at first, then removed. All tasks read the
    # table for it, and the one that writes it gets a trip per hour and payment type, however large the table is.
    stray = spark.read.parquet(path).drop("pickup_date").dropDuplicates(["pickup_hour", "payment_type"])
    stray.coalesce(1).write.mode("append").parquet(f"{path}/pickup_date=2024-01-10")
    then, later = dt.datetime(2024, 2, 10, tzinfo=dt.timezone.utc), dt.datetime(2100, 1, 1, tzinfo=dt.timezone.utc)
    found = maintenance.maintain(spark, [table], "monthly", (), then, days_to_keep=20, retain_last=15, remove_after_days=3)
    removed = maintenance.maintain(spark, [table], "full", ("compact", "expire"), later, remove_after_days=3)
    left = maintenance.maintain(spark, [table], "full", ("compact", "expire"), later)
    steps = [compacted, found, *(d.withColumn("step", F.lit(s)) for s, d in (("remove", removed), ("after", left)))]
    done = reduce(DataFrame.unionByName, steps)
    kept = publish.read_log(spark, f"{root}/log").agg(F.count(F.lit(1)).alias("n")).scalar()
    rows = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n")).scalar()
    return done.select("step", "ok", "items").withColumns({"kept_runs": kept, "rows": rows})


@query
def q_expire_select(spark, sf_dir):
    log = taxi.table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("table_path"),
        F.col("o_orderkey").alias("run_id"),
        F.col("o_orderdate").alias("committed_at"),
    )
    as_of = log.agg(F.max("committed_at").alias("as_of")).scalar()
    return maintenance.expire_candidates(log, as_of)


@query
def q_orphans(spark, sf_dir):
    """Files (parts) that no version (line item) of the retention period refers to."""

    def file_of(key):
        return F.concat(F.lit("file-"), F.col(key).cast("string"))

    inventory = taxi.table(spark, sf_dir, "part").select(
        file_of("p_partkey").alias("path"), F.col("p_size").alias("length")
    )
    items = taxi.table(spark, sf_dir, "lineitem")
    newest = items.agg(F.max("l_shipdate").alias("newest")).scalar()
    live = items.where(F.col("l_shipdate") >= newest - F.expr("INTERVAL '30' DAY"))
    return maintenance.orphans(inventory, live.select(file_of("l_partkey").alias("path")))


# --- metric samples ----------------------------------------------------------------------


@query
def q_rate_5m(spark, sf_dir):
    return rounded(telemetry.event_rate(events(spark, sf_dir), "ts", ["event_type"]))


@query
def q_counter_rate(spark, sf_dir):
    """``value`` read as a counter per user and event type that restarts when it drops."""
    return rounded(
        telemetry.counter_rate(events(spark, sf_dir), "ts", ["user_id", "event_type"], ORDER, "value")
    )


@query
def q_counter_increase_alert(spark, sf_dir):
    """Five-minute windows in which a counter grew by more than 50, restarts included."""
    series = ["user_id", "event_type"]
    return rounded(telemetry.counter_increase_above(events(spark, sf_dir), "ts", series, ORDER, "value", 50))


@query
def q_increase_alert(spark, sf_dir):
    return telemetry.increase_above(events(spark, sf_dir), "ts", ["event_type"], 2)


@query
def q_sliding_increase(spark, sf_dir):
    """Events of the last five minutes at every minute, per event type."""
    return rounded(sliding.sliding_increase(events(spark, sf_dir), "ts", ["event_type"]))


@query
def q_sliding_alert(spark, sf_dir):
    """Stretches of minutes at which more than two events of a type lie in the last five."""
    steps = sliding.sliding_increase(events(spark, sf_dir), "ts", ["event_type"])
    return sliding.alert_episodes(steps, ["event_type"], 2)


@query
def q_sliding_counter(spark, sf_dir):
    """``value`` read as a counter: its growth over the last hour at every ten minutes."""
    series = ["user_id", "event_type"]
    return rounded(sliding.sliding_counter_increase(events(spark, sf_dir), "ts", series, ORDER, "value", 3600, 600))


@query
def q_sustained(spark, sf_dir):
    is_error = F.col("event_type") == "error"
    return rounded(telemetry.sustained(events(spark, sf_dir), "ts", ["user_id"], ORDER, is_error, 60))


@query
def q_ratio_band(spark, sf_dir):
    daily = events(spark, sf_dir).groupBy(F.to_date("ts").alias("day")).agg(
        F.count_if(F.col("event_type") == "error").alias("errors"), F.count(F.lit(1)).alias("samples")
    )
    shares = daily.withColumn("error_pct", telemetry.share_percent(F.col("errors"), F.col("samples")))
    return rounded(telemetry.banded(shares, "error_pct", 18, 22))


@query
def q_success_rate(spark, sf_dir):
    return rounded(telemetry.success_rate(events(spark, sf_dir), "ts", "event_type", "purchase", "error"))


@query
def q_latest_sum(spark, sf_dir):
    return rounded(
        telemetry.latest_sum(events(spark, sf_dir), ["event_type", "user_id"], ORDER, "value", ["event_type"])
    )


@query
def q_label_regex(spark, sf_dir):
    chosen = telemetry.label_matches(events(spark, sf_dir), "event_type", "err.*|purchase")
    return rounded(
        chosen.groupBy("event_type", F.to_date("ts").alias("day")).agg(
            F.count(F.lit(1)).alias("samples"), F.sum("value").alias("total")
        )
    )


@query
def q_state_breakdown(spark, sf_dir):
    return telemetry.state_breakdown(events(spark, sf_dir), "ts", ["event_type"], "1 hour")


@query
def q_heartbeat_gaps(spark, sf_dir):
    return rounded(telemetry.silence(events(spark, sf_dir), "ts", ["user_id"], 12 * 3600))


@query
def q_uptime(spark, sf_dir):
    return rounded(telemetry.uptime(events(spark, sf_dir), "ts", ["user_id"]))


NAME_MAPPINGS = (
    telemetry.NameMapping("app.error.*", "app_errors_total", ("user",)),
    telemetry.NameMapping("app.purchase.*", "app_purchases_total", ("user",)),
    telemetry.NameMapping("app.view.*", "app_views_total", ("user",)),
)


@query
def q_name_labels(spark, sf_dir):
    named = events(spark, sf_dir).select(
        F.concat_ws(".", F.lit("app"), "event_type", F.col("user_id").cast("string")).alias("name")
    )
    # Counting first leaves one name per series for the regular expressions.
    counted = named.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    labelled = telemetry.name_labels(counted, "name", NAME_MAPPINGS)
    return labelled.groupBy("metric", "user").agg(F.sum("n").alias("samples"))


@query
def q_error_rate(spark, sf_dir):
    return rounded(telemetry.error_rate(events(spark, sf_dir), "ts", "event_type", "error"))


# --- streaming ---------------------------------------------------------------------------


@query
def q_stream_bronze(spark, sf_dir):
    """Two runs of the same stream; in between all days land again under new file names."""
    landing, root = shared_dir(spark, "landing"), shared_dir(spark, "stream")
    for _ in range(2):
        writers.split_by_day(raw(spark, sf_dir), landing, taxi.PICKUP, "date", taxi.TAXI.landing_from)
        stream = ingest.stream_landing(spark, landing, RAW_TRIP)
        ingest.write_bronze(stream, landing, f"{root}/bronze", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/bronze").groupBy("ingestion_date").agg(F.count(F.lit(1)).alias("rows"))


@query
def q_stream_silver(spark, sf_dir):
    """Landed trips as a stream: rules, one row per key, and the zone of a static lookup."""
    landing, root = _land(spark, sf_dir), shared_dir(spark, "stream")
    stream = ingest.stream_landing(spark, landing, RAW_TRIP).drop("date")
    facts_of = marts.fact_trips(silver_streams.silver_stream(stream, taxi.TAXI, "40 days"))
    streams.run_to_table(silver_streams.with_pickup_zone(facts_of, taxi.zones(spark, sf_dir)), f"{root}/silver", f"{root}/checkpoint", "append")
    return spark.read.parquet(f"{root}/silver")


def _event_stream(spark, sf_dir):
    return streams.stream_samples(spark, sf_dir, files="events.parquet")


def _streamed(spark, result: DataFrame) -> DataFrame:
    """Run a streaming result to the end; its table with timestamps as in the input."""
    root = shared_dir(spark, "stream")
    streams.run_to_table(result, f"{root}/table", f"{root}/checkpoint", "complete")
    found = spark.read.parquet(f"{root}/table")
    stamps = [f.name for f in found.schema.fields if f.dataType.typeName() == "timestamp"]
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps})


@query
def q_stream_state_breakdown(spark, sf_dir):
    return _streamed(
        spark, telemetry.state_breakdown(_event_stream(spark, sf_dir), "ts", ["event_type"], "1 hour")
    )


@query
def q_stream_rate(spark, sf_dir):
    return rounded(_streamed(spark, telemetry.event_rate(_event_stream(spark, sf_dir), "ts", ["event_type"])))


@query
def q_stream_sessions(spark, sf_dir):
    return _streamed(spark, streams.sessions(_event_stream(spark, sf_dir), "ts", ["user_id"], "30 minutes"))


@query
def q_stream_error_sessions(spark, sf_dir):
    """Stretches of errors of a user; unlike ``q_sustained`` other events do not end them."""
    errors = _event_stream(spark, sf_dir).where(F.col("event_type") == "error")
    return _streamed(spark, streams.sessions(errors, "ts", ["user_id"], "6 hours"))


@query
def q_stream_silence(spark, sf_dir):
    sessions = _streamed(spark, streams.sessions(_event_stream(spark, sf_dir), "ts", ["user_id"], "12 hours"))
    return rounded(streams.silence_between(sessions, ["user_id"], 12 * 3600))
