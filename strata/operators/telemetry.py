"""Metric-sample analytics: rates, ratios, sustained conditions and silence.

A sample table has a timestamp, one or more series columns, and mostly a value. Functions
that only count or sum per time window accept a streaming DataFrame as well.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.config import stored
from strata.operators.ordered import previous_row, runs, with_slices
from strata.sources.contracts import contract

RATE_WINDOW = "5 minutes"


def state_breakdown(samples: DataFrame, ts: str, labels: Sequence[str], width: str) -> DataFrame:
    """Samples per tumbling window and label combination; batch or stream."""
    return (
        samples.groupBy(F.window(ts, width).alias("_window"), *labels)
        .agg(F.count(F.lit(1)).alias("samples"))
        .select(F.col("_window.start").alias("window_start"), *labels, "samples")
    )


def event_rate(samples: DataFrame, ts: str, series: Sequence[str], minutes: int = 5) -> DataFrame:
    """Events per second in each window; a window without events has no row."""
    counted = state_breakdown(samples, ts, series, f"{minutes} minutes")
    return counted.withColumn("rate", F.col("samples") / F.lit(minutes * 60.0))


def increase_above(
    samples: DataFrame, ts: str, series: Sequence[str], threshold: float, width: str = RATE_WINDOW
) -> DataFrame:
    """Windows in which a series grew by more than ``threshold`` events."""
    counted = state_breakdown(samples, ts, series, width)
    return counted.where(F.col("samples") > threshold).withColumnRenamed("samples", "increase")


def counter_increase_above(
    samples: DataFrame, ts: str, series: Sequence[str], order: Sequence[str], value: str, threshold: float, minutes: int = 5
) -> DataFrame:
    """Windows in which a counter grew by more than ``threshold``, restarts of the counter included."""
    grown = counter_rate(samples, ts, series, order, value, minutes)
    return grown.where(F.col("increase") > threshold).drop("rate")


def counter_deltas(
    samples: DataFrame, ts: str, series: Sequence[str], order: Sequence[str], value: str
) -> DataFrame:
    """Growth of a counter since the previous sample of its series.

    A counter that drops was restarted, so its new value is the growth. The first sample of
    a series has no growth.
    """
    linked = previous_row(with_slices(samples, series, order), series, order, [value])
    grown = F.col(value) - F.col(f"prev_{value}")
    return linked.withColumn("delta", F.when(grown < 0, F.col(value)).otherwise(grown))


def counter_rate(
    samples: DataFrame, ts: str, series: Sequence[str], order: Sequence[str], value: str, minutes: int = 5
) -> DataFrame:
    """Increase of a counter per window and its rate per second, without extrapolation."""
    return (
        counter_deltas(samples, ts, series, order, value)
        .groupBy(F.window(ts, f"{minutes} minutes").alias("_window"), *series)
        .agg(F.sum("delta").alias("increase"))
        .select(
            F.col("_window.start").alias("window_start"),
            *series,
            "increase",
            (F.col("increase") / F.lit(minutes * 60.0)).alias("rate"),
        )
    )


def sustained(
    samples: DataFrame, ts: str, series: Sequence[str], order: Sequence[str], condition: Column, seconds: float
) -> DataFrame:
    """Stretches of consecutive samples on which a condition held for at least ``seconds``."""
    stretches = runs(with_slices(samples, series, order), series, order, condition)
    return stretches.withColumn("seconds", seconds_between("run_start", "run_end")).where(
        F.col("seconds") >= seconds
    )


def seconds_between(earlier: str, later: str) -> Column:
    """Seconds with fractions between two timestamps."""
    micros = F.unix_micros(F.col(later).cast("timestamp")) - F.unix_micros(F.col(earlier).cast("timestamp"))
    return micros / F.lit(1_000_000)


def silence(samples: DataFrame, ts: str, series: Sequence[str], seconds: int) -> DataFrame:
    """Gaps of at least ``seconds`` between consecutive samples of a series.

    Time is cut into cells of exactly that length. Two samples in one cell are closer than
    that, so only the first and last sample of a cell matter. They come from a map-side
    combined aggregate; the window then sees one row per series and cell, however many
    samples there are.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    cells = (
        samples.groupBy(*series, F.floor(micros / F.lit(seconds * 1_000_000)).alias("_cell"))
        .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"))
    )
    earlier = Window.partitionBy(*series).orderBy("_cell")
    return (
        cells.select(
            *series, F.lag("_last").over(earlier).alias("gap_start"), F.col("_first").alias("gap_end")
        )
        .withColumn("seconds", seconds_between("gap_start", "gap_end"))
        .where(F.col("seconds") >= seconds)
    )


def banded(df: DataFrame, value: str, yellow_from: float, red_above: float, out: str = "band") -> DataFrame:
    """Colour band of a gauge: green below, yellow in between, red above; NULL stays NULL."""
    v = F.col(value)
    return df.withColumn(
        out, F.when(v < yellow_from, "green").when(v <= red_above, "yellow").when(v > red_above, "red")
    )


def share_percent(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``, NULL where ``whole`` is zero."""
    return F.try_divide(part * F.lit(100.0), whole)


def success_rate(samples: DataFrame, ts: str, kind: str, success: str, failure: str, unit: str = "hour") -> DataFrame:
    """Success percentage for every time unit in the span; a unit without samples counts as zero of each.

    With neither successes nor failures the percentage is NULL.
    """
    counts = {"successes": F.count_if(F.col(kind) == success), "failures": F.count_if(F.col(kind) == failure)}
    return per_unit(samples, ts, unit, counts).withColumn(
        "success_pct", share_percent(F.col("successes"), F.col("successes") + F.col("failures"))
    )


def error_rate(samples: DataFrame, ts: str, kind: str, failure: str, unit: str = "hour") -> DataFrame:
    """Error percentage for every time unit in the span, 0 where nothing happened."""
    counts = {"requests": F.count(F.lit(1)), "errors": F.count_if(F.col(kind) == failure)}
    return per_unit(samples, ts, unit, counts).withColumn(
        "error_pct", F.coalesce(share_percent(F.col("errors"), F.col("requests")), F.lit(0.0))
    )


def per_unit(samples: DataFrame, ts: str, unit: str, counts: dict[str, Column]) -> DataFrame:
    """Counts for every time unit from the first to the last sample, 0 where there is none.

    The samples are read once: each unit with samples fills the empty units up to the next one, so no
    list of all units is built. Samples without a time count nowhere.
    """
    start = F.date_trunc(unit, ts).cast("timestamp_ntz").alias("unit_start")
    tally = samples.where(F.col(ts).isNotNull()).groupBy(start).agg(*(c.alias(n) for n, c in counts.items()))
    following = F.lead("unit_start").over(Window.orderBy("unit_start"))
    step = F.expr(f"interval 1 {unit}")
    last = F.coalesce(following - step, F.col("unit_start"))
    filled = tally.withColumn("_last", last).withColumn("_unit", F.explode(F.sequence("unit_start", "_last", step)))
    is_own = F.col("_unit") == F.col("unit_start")
    return filled.select(
        F.col("_unit").alias("unit_start"), *(F.when(is_own, F.col(n)).otherwise(0).alias(n) for n in counts)
    )


def latest_per_series(samples: DataFrame, series: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Newest value of each series, combined before the shuffle."""
    return samples.groupBy(*series).agg(F.max_by(value, F.struct(*order)).alias(value))


def latest_sum(
    samples: DataFrame, series: Sequence[str], order: Sequence[str], value: str, by: Sequence[str] = ()
) -> DataFrame:
    """Sum of the newest values, per group of series."""
    newest = latest_per_series(samples, series, order, value)
    return newest.groupBy(*by).agg(F.count(F.lit(1)).alias("series"), F.sum(value).alias("total"))


def label_matches(samples: DataFrame, label: str, pattern: str) -> DataFrame:
    """Samples whose label matches the whole pattern, as in a ``=~`` selector."""
    return samples.where(F.col(label).rlike(f"^(?:{pattern})$"))


def uptime(samples: DataFrame, ts: str, series: Sequence[str]) -> DataFrame:
    """Seconds from a series' first sample to the newest sample of the table.

    The newest sample follows from the newest of each series, so the samples are read once.
    """
    ends = stored(samples.groupBy(*series).agg(F.min(ts).alias("started"), F.max(ts).alias("_last")), "series-ends")
    newest = ends.agg(F.max("_last").alias("as_of")).scalar()
    return ends.withColumn("_now", newest).withColumn("uptime_seconds", seconds_between("started", "_now")).drop(
        "_now", "_last"
    )


class NameMapping(NamedTuple):
    """Maps dotted names such as ``app.*.*`` to a metric; each ``*`` is one whole, non-empty part of the name."""

    pattern: str
    metric: str
    labels: tuple[str, ...]

    def parts(self) -> list[str]:
        found = self.pattern.split(".")
        if any("*" in part and part != "*" for part in found):
            raise ValueError(f"a * in {self.pattern} is not a part of its own")
        return found


def _trie(mappings: Sequence[NameMapping]) -> tuple[list[list[tuple[int, str, int]]], list[tuple[int, int]]]:
    """Edges (node, part, child) per level, and (node, number) of the first mapping that ends at a node."""
    child: dict[tuple[int, str], int] = {}
    levels: list[list[tuple[int, str, int]]] = []
    ends: dict[int, int] = {}
    for number, mapping in enumerate(mappings):
        node = 0
        for level, part in enumerate(mapping.parts()):
            if level == len(levels):
                levels.append([])
            if (node, part) not in child:
                child[node, part] = len(child) + 1
                levels[level].append((node, part, child[node, part]))
            node = child[node, part]
        ends.setdefault(node, number)
    return levels, sorted(ends.items())


def name_labels(df: DataFrame, name: str, mappings: Sequence[NameMapping]) -> DataFrame:
    """Metric name and label columns for dotted names.

    The first matching mapping decides, names that match none are dropped, and labels a
    mapping does not define are NULL. All mappings form one trie of name parts. Distinct names walk down it level by
    level, along the edge of their part and along a ``*``, so the work per name depends on its parts and not on
    how many mappings there are.
    """
    spark = df.sparkSession
    levels, ends = _trie(mappings)
    edge = contract(_node="integer", _part="string", _child="integer")
    last = spark.createDataFrame(ends, contract(_node="integer", _number="integer"))
    at = df.select(F.col(name).alias("_name")).distinct().withColumns({"_parts": F.split("_name", r"\."), "_node": F.lit(0)})
    found = []
    for level, edges in enumerate(levels):
        here = at.where(F.size("_parts") > level).withColumn("_part", F.col("_parts")[level])
        steps = []
        if exact := [e for e in edges if e[1] != "*"]:
            steps.append(here.join(spark.createDataFrame(exact, edge), ["_node", "_part"]))
        if wild := [e for e in edges if e[1] == "*"]:
            any_part = spark.createDataFrame(wild, edge).select("_node", "_child")
            steps.append(here.where("_part <> ''").join(any_part, "_node"))
        at = reduce(DataFrame.unionByName, (s.select("_name", "_parts", F.col("_child").alias("_node")) for s in steps))
        found.append(at.where(F.size("_parts") == level + 1).join(last, "_node").select("_name", "_parts", "_number"))
    decided = reduce(DataFrame.unionByName, found).groupBy("_name", "_parts").agg(F.min("_number").alias("_number"))
    rows = [
        (k, m.metric, dict(zip(m.labels, (p + 1 for p, part in enumerate(m.parts()) if part == "*")))) for k, m in enumerate(mappings)
    ]
    chosen = _mapping_table(spark, rows)
    every_label = list(dict.fromkeys(label for m in mappings for label in m.labels))
    labelled = decided.join(chosen, "_number").select(
        "_name", "metric", *(F.try_element_at("_parts", F.col("_places")[label]).alias(label) for label in every_label)
    )
    return df.join(labelled, df[name] == labelled["_name"]).drop("_name")


def _mapping_table(spark: SparkSession, rows: Sequence[tuple[int, str, dict[str, int]]]) -> DataFrame:
    """Number, metric and the place of each label in a name, of every mapping."""
    schema = contract(_number="integer", metric="string")
    schema = schema.add("_labels", T.ArrayType(T.StringType())).add("_at", T.ArrayType(T.IntegerType()))
    table = spark.createDataFrame([(k, metric, list(places), list(places.values())) for k, metric, places in rows], schema)
    return table.select("_number", "metric", F.map_from_arrays("_labels", "_at").alias("_places"))
