"""Increase and rate over ranges that slide along: a range is evaluated at every step, so no burst is cut in two.

Samples are first summed in panes, tumbling partials of one step, before the shuffle. A pane then counts in
every range that covers it, so a hot series costs as many rows as it has steps and no task gathers it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.telemetry import counter_deltas

RANGE_SECONDS, STEP_SECONDS = 300, 60


def panes(samples: DataFrame, ts: str, series: Sequence[str], growth: Column, step: int = STEP_SECONDS) -> DataFrame:
    """Samples and growth per series and step; batch or stream."""
    return samples.groupBy(F.window(ts, f"{step} seconds").alias("pane"), *series).agg(
        F.sum(growth).alias("increase"), F.count(F.lit(1)).alias("samples")
    )


def sliding_increase(
    samples: DataFrame,
    ts: str,
    series: Sequence[str],
    growth: Column | None = None,
    seconds: int = RANGE_SECONDS,
    step: int = STEP_SECONDS,
) -> DataFrame:
    """Increase and rate per second over the ``seconds`` up to each step, for every step whose range has samples.

    ``range_end`` is exclusive. Without ``growth`` every sample counts one. Samples without a time are in no range; a
    NULL series is a series like any other.
    """
    if seconds % step:
        raise ValueError(f"a range of {seconds} s is not made of steps of {step} s")
    growth = F.lit(1).cast("long") if growth is None else growth
    rows = panes(samples.where(F.col(ts).isNotNull()), ts, series, growth, step)
    starts = F.sequence(F.lit(1), F.lit(seconds // step))
    ends = F.transform(starts, lambda k: F.col("pane.start") + F.make_dt_interval(secs=k * step))
    covered = rows.select(F.explode(ends).alias("range_end"), *series, "increase", "samples")
    return (
        covered.groupBy("range_end", *series)
        .agg(F.sum("increase").alias("increase"), F.sum("samples").alias("samples"))
        .withColumn("rate", F.col("increase") / F.lit(float(seconds)))
    )


def sliding_counter_increase(
    samples: DataFrame,
    ts: str,
    series: Sequence[str],
    order: Sequence[str],
    value: str,
    seconds: int = RANGE_SECONDS,
    step: int = STEP_SECONDS,
) -> DataFrame:
    """The same for a counter, restarts included; growth counts where the later of two samples stands."""
    linked = counter_deltas(samples, ts, series, order, value)
    return sliding_increase(linked, ts, series, F.coalesce("delta", F.lit(0.0)), seconds, step)


def alert_episodes(
    steps: DataFrame, series: Sequence[str], above: float, step: int = STEP_SECONDS, value: str = "increase"
) -> DataFrame:
    """Stretches of consecutive steps on which ``value`` lies above a limit: first and last step, how many, and the peak.

    Steps meet as sessions, which are merged before the shuffle where the session's settings ask for it.
    """
    alarming = steps.where(F.col(value) > above)
    # Longer than one step and shorter than two, so that only neighbours meet.
    episode = F.session_window("range_end", f"{step * 1500} milliseconds").alias("_episode")
    return (
        alarming.groupBy(episode, *series)
        .agg(
            F.min("range_end").alias("first_step"),
            F.max("range_end").alias("last_step"),
            F.count(F.lit(1)).alias("steps"),
            F.max(value).alias("peak"),
        )
        .drop("_episode")
    )


def sliding_stream(
    stream: DataFrame, ts: str, series: Sequence[str], lateness: str, seconds: int = RANGE_SECONDS, step: int = STEP_SECONDS
) -> DataFrame:
    """Increase per range as a stream in append mode: panes and ranges that the watermark has passed leave the state."""
    rows = panes(stream.withWatermark(ts, lateness), ts, series, F.lit(1).cast("long"), step)
    ranges = F.window(F.window_time("pane"), f"{seconds} seconds", f"{step} seconds")
    return (
        rows.groupBy(ranges.alias("range"), *series)
        .agg(F.sum("increase").alias("increase"))
        .select(F.col("range.end").alias("range_end"), *series, "increase")
    )
