"""Landing to gold in one call."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import DatasetSpec, DateRange, beside, stored
from strata.operators import dims
from strata.operators.audit import increment_checks
from strata.operators.marts import daily_summary, fact_trips
from strata.operators.partials import daily_partials
from strata.operators.upsert import upsert
from strata.plans.trips import silver_trips
from strata.sources.files import remove_path, restore_partitions
from strata.sources.publish import PublishResult, publish, staged_copy
from strata.sources.readers import in_partitions, read_parquet, read_range_or_none
from strata.sources.writers import Ingested, append_new_days, promote, stage, write_once


#: Table of the daily partials of all marts.
MART_TABLE = "agg_daily_partials"


@dataclass(frozen=True)
class Layout:
    """Table directories below one root."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    @property
    def log(self) -> str:
        return self.path("publish_log")

    @property
    def manifest(self) -> str:
        return self.path("manifest")


@dataclass(frozen=True)
class PipelineResult:
    bronze: Ingested
    silver: PublishResult | None
    gold: dict[str, PublishResult]

    @property
    def published(self) -> bool:
        runs = [self.silver, *self.gold.values()]
        return self.silver is not None and all(r.published for r in runs)


def run_pipeline(
    spark: SparkSession,
    spec: DatasetSpec,
    layout: Layout,
    landing: str,
    days: DateRange,
    run_id: str,
    zones_csv: str | None = None,
    marts: bool = True,
) -> PipelineResult:
    """Ingest, clean, upsert and publish one range of days; repeating a range changes nothing.

    A row that landed in the range may belong to any day of the event time. So the increment is written
    first, silver is merged on the days the increment really touches, and gold is rebuilt for exactly
    those days. Dimensions are written once: payment types, the calendar of each year that occurs (a year
    is added when its first day is published), and zones when ``zones_csv`` names their lookup. Marts are
    published as daily partials (``operators/partials.py``) of exactly those days, unless ``marts`` is off; other
    days keep their files.
    """
    bronze_path, silver_path = layout.path("bronze"), layout.path("silver")
    ingested = append_new_days(spark, landing, bronze_path, days, spec.landing_day, spec.bronze_day)
    bronze = read_range_or_none(spark, bronze_path, spec.bronze_day, days)
    if bronze is None:
        return PipelineResult(ingested, None, {})

    # Written where it is published from: days without rows yet move into the table as they are.
    silver_run = f"{run_id}-silver"
    increment_path = staged_copy(silver_path, silver_run)
    restore_partitions(spark, silver_path)
    existing = read_parquet(spark, silver_path, missing_ok=True)
    computed = silver_trips(bronze, spec, gathered_by=spec.silver_day)
    if existing is not None:
        computed = computed.select(*existing.columns)
    stage(computed, increment_path, [spec.silver_day], gathered=True)
    increment = spark.read.schema(computed.schema).parquet(increment_path).select(*computed.columns)
    touched = stored(increment.select(spec.silver_day).distinct(), "touched")
    if existing is not None:
        # Only days that have rows already are merged; they take the place of the increment's own.
        kept = in_partitions(existing, spec.silver_day, touched)
        present = kept.select(spec.silver_day).distinct()
        changed, grown_path = upsert(kept, in_partitions(increment, spec.silver_day, present), [spec.key_name]), beside(silver_path, "grown")
        stage(changed, grown_path, [spec.silver_day])
        promote(spark, grown_path, increment_path)
        remove_path(spark, grown_path)
    silver = publish(
        increment,
        silver_path,
        [spec.silver_day],
        increment_checks(spec.event_time, spec.key_name),
        silver_run,
        layout.log,
        layout.manifest,
        staged=True,
    )
    if not silver.published:
        return PipelineResult(ingested, silver, {})

    fact = fact_trips(in_partitions(spark.read.parquet(silver_path), spec.silver_day, touched))
    gold = {}
    tables = [
        ("fact_trips", fact, increment_checks(spec.silver_day, spec.key_name)),
        ("agg_daily_summary", daily_summary(fact), increment_checks(spec.silver_day, spec.silver_day)),
    ]
    if marts:
        tables.append((MART_TABLE, daily_partials(fact), increment_checks(spec.silver_day)))
    for name, table, checks in tables:
        gold[name] = publish(
            table,
            layout.path(name),
            [spec.silver_day],
            checks,
            f"{run_id}-{name}",
            layout.log,
            layout.manifest,
            gathered=table is fact,
        )
    _dimensions(spark, layout, touched, spec.silver_day, zones_csv)
    return PipelineResult(ingested, silver, gold)


def _dimensions(spark: SparkSession, layout: Layout, touched: DataFrame, day: str, zones_csv: str | None) -> None:
    """Write what is not there yet; existing dimension rows are never rewritten."""
    write_once(dims.dim_payment(spark), layout.path("dim_payment"))
    if zones_csv is not None:
        write_once(dims.dim_zone(spark, zones_csv), layout.path("dim_zone"))
    for row in touched.where(F.col(day).isNotNull()).select(F.year(day).alias("year")).distinct().orderBy("year").collect():
        calendar = dims.dim_date(spark, dt.date(row.year, 1, 1), dt.date(row.year, 12, 31))
        # Each year is a directory of its own, so adding one leaves the others alone.
        write_once(calendar.drop("year"), f"{layout.path('dim_date')}/year={row.year}")
