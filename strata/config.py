"""Control parameters: date ranges, dataset descriptions and the shared scratch folder."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.rules import Rule


@dataclass(frozen=True)
class DateRange:
    """Inclusive range of days; ``end`` falls back to ``start``."""

    start: dt.date
    end: dt.date

    def __post_init__(self) -> None:
        if self.end < self.start:
            raise ValueError(f"end {self.end} lies before start {self.start}")

    @classmethod
    def of(cls, start: str | dt.date, end: str | dt.date | None = None) -> DateRange:
        first = _as_date(start)
        return cls(first, _as_date(end) if end is not None else first)

    @property
    def is_single_day(self) -> bool:
        return self.start == self.end

    @property
    def n_days(self) -> int:
        return (self.end - self.start).days + 1

    @property
    def label(self) -> str:
        """``20240101`` or ``20240101_20240131``, for run ids and application names."""
        first, last = self.start.strftime("%Y%m%d"), self.end.strftime("%Y%m%d")
        return first if self.is_single_day else f"{first}_{last}"

    def spine(self, spark: SparkSession, column: str = "day") -> DataFrame:
        """One row per day of the range."""
        return spark.range(1).select(
            F.explode(F.sequence(F.lit(self.start), F.lit(self.end))).alias(column)
        )


def _as_date(value: str | dt.date) -> dt.date:
    if isinstance(value, dt.date):
        return value
    try:
        return dt.datetime.strptime(value, "%Y-%m-%d").date()
    except ValueError as error:
        raise ValueError(f"not a YYYY-MM-DD date: {value!r}") from error


@dataclass(frozen=True)
class DatasetSpec:
    """What the pipeline needs to know about one event dataset."""

    event_time: str
    key_columns: tuple[str, ...]
    key_name: str
    rules: tuple[Rule, ...]
    renames: dict[str, str]
    tie_break: tuple[str, ...]
    order: tuple[str, ...] = ()
    landing_from: dt.date | None = None
    landing_day: str = "date"
    bronze_day: str = "ingestion_date"
    silver_day: str = "pickup_date"
    gold_columns: tuple[str, ...] = field(default=())


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory below the session's checkpoint folder.

    The cluster names a shared folder in ``spark.checkpoint.dir``. Only a local
    session without one may fall back to a folder of its own machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="strata-")
    return f"{base.rstrip('/')}/strata/{name}-{uuid.uuid4().hex[:12]}"


def beside(path: str, name: str) -> str:
    """A fresh directory next to a table, in the same file system, so that its parts can be moved into the table."""
    return f"{path.rstrip('/')}_staging/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: computed once, and safe when executors are lost."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
