"""Metric samples evaluated at instants, as a time-series server evaluates its panels.

* **Lookback.** At an instant ``t`` of the ``step`` grid a series has the value
  of its latest sample in ``(t - lookback, t]``: it carries over steps without a
  sample of their own, and disappears when its latest sample is ``lookback`` old.
* **Extrapolated rate.** The increase between the first and last sample of
  ``(t - window, t]``, corrected for resets, is extended towards the window's
  edges: by the distance to the edge when that is less than 1.1 times the mean
  spacing of the samples, else by half that spacing, and at the start never past
  the point where the counter would have been zero.

The grid is aligned to the epoch. Samples are reduced to one row per (series,
step) by a partial aggregation before anything else; a series is never gathered
in one task (:mod:`trafficlens.operators.asof`, :mod:`trafficlens.operators.series`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import from_micros, micros, sample_order
from ..operators.asof import asof_join, carries, chunk_of
from .metrics import BY, SERIES, duration_seconds, latest, with_increase

_MILLION = 1_000_000
STEPS_PER_CHUNK = 256  # grid instants of a series that one task handles together


def _step_end(ts: str, step_seconds: int) -> Column:
    """Number of the grid instant that ends the step ``(t - step, t]`` holding ``ts``."""
    return F.ceil(micros(ts) / F.lit(step_seconds * _MILLION)).cast("bigint")


def instant_values(
    samples: DataFrame,
    step: str,
    lookback: str,
    series: Sequence[str] = SERIES,
    ts: str = "ts",
    tiebreak: str | None = "event_id",
    value: str = "v",
) -> DataFrame:
    """Value of each live series at each grid instant: ``series…, ts, value``.

    Samples without a time are left out; a null value of the latest sample is that
    instant's value. A series has no row at instants where it is stale.
    """
    step_s, lookback_s = duration_seconds(step), duration_seconds(lookback)
    chunk_s = step_s * max(STEPS_PER_CHUNK, -(-lookback_s // step_s))
    present = samples.where(F.col(ts).isNotNull())
    # Only the last sample of a step can be the latest at an instant.
    order = sample_order(ts, tiebreak)
    lasts = present.groupBy(*series, _step_end(ts, step_s).alias("_end")).agg(
        F.max_by(value, order).alias("value"), F.max(ts).alias("ts")
    )
    held = lasts.select(*series, chunk_of(micros("ts"), chunk_s).alias("_chunk")).distinct()
    reach = F.explode(F.sequence("_chunk", F.col("_chunk") + carries(chunk_s, lookback_s)))
    alive = held.select(*series, reach.alias("_chunk")).distinct()
    per_chunk = chunk_s // step_s
    first = F.col("_chunk") * per_chunk
    instants = alive.select(*series, F.explode(F.sequence(first, first + (per_chunk - 1))).alias("_t"))
    grid = instants.select(*series, from_micros(F.col("_t") * (step_s * _MILLION)).alias("ts"))
    joined = asof_join(
        grid, lasts.drop("_end"), series, lookback_s, ["value"], chunk_seconds=chunk_s, matched_ts="_sampled"
    )
    return joined.where(F.col("_sampled").isNotNull()).select(*series, "ts", "value")


def instant_sum(
    samples: DataFrame,
    step: str,
    lookback: str,
    by: Sequence[str] = BY,
    series: Sequence[str] = SERIES,
    **cols,
) -> DataFrame:
    """``sum by (by)(gauge)`` at each grid instant over the series that are live there: ``by…, ts, value``."""
    live = instant_values(samples, step, lookback, series, **cols)
    return live.groupBy(*by, "ts").agg(F.sum("value").alias("value"))


def instant_at(
    samples: DataFrame,
    at: str,
    lookback: str,
    series: Sequence[str] = SERIES,
    ts: str = "ts",
    tiebreak: str | None = "event_id",
    value: str = "v",
) -> DataFrame:
    """Value of each series that is live at the one instant ``at``: ``series…, value``.

    The lookback is a range predicate on ``ts``, so only that range of a sorted or partitioned table is read.
    """
    end = F.lit(at).cast("timestamp_ntz")
    begin = end - F.make_dt_interval(secs=F.lit(duration_seconds(lookback)).cast("decimal(18,6)"))
    return latest(samples.where((F.col(ts) > begin) & (F.col(ts) <= end)), series, ts, tiebreak, value)


def extrapolated_rate(
    samples: DataFrame,
    window: str,
    step: str,
    series: Sequence[str] = SERIES,
    ts: str = "ts",
    tiebreak: str | None = "event_id",
    value: str = "v",
) -> DataFrame:
    """Per-second rate of each series in ``(t - window, t]`` at each grid instant: ``series…, ts, samples, rate``.

    A window needs two samples at different times. Samples become one mergeable
    summary per (series, step) - count, increase, first sample, first and last
    time - and the summaries, not the samples, are dealt to the ``window / step``
    windows that hold them.
    """
    window_s, step_s = duration_seconds(window), duration_seconds(step)
    if window_s % step_s:
        raise ValueError("window must be a whole number of steps")
    rows = with_increase(samples.where(F.col(ts).isNotNull()), series, ts, tiebreak, value)
    buckets = rows.groupBy(*series, _step_end(ts, step_s).alias("_end")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("inc").alias("_inc"),
        F.min("seq").alias("_seq"),
        F.min_by("inc", "seq").alias("_first_inc"),
        F.min_by(value, "seq").alias("_first"),
        F.min(micros(ts)).alias("_from"),
        F.max(micros(ts)).alias("_to"),
    )
    later = F.explode(F.sequence(F.lit(0), F.lit(window_s // step_s - 1)))
    dealt = buckets.select("*", later.alias("_later")).withColumn("_end", F.col("_end") + F.col("_later"))
    per = dealt.groupBy(*series, "_end").agg(
        F.sum("_n").alias("samples"),
        (F.sum("_inc") - F.min_by("_first_inc", "_seq")).alias("_increase"),
        F.min_by("_first", "_seq").alias("_first"),
        F.min("_from").alias("_from"),
        F.max("_to").alias("_to"),
    )
    per = per.where((F.col("samples") >= 2) & (F.col("_to") > F.col("_from")))
    end = F.col("_end") * (step_s * _MILLION)
    sampled = ((F.col("_to") - F.col("_from")) / F.lit(_MILLION)).alias("_sampled")
    per = per.select(
        *series,
        from_micros(end).alias("ts"),
        "samples",
        F.col("_increase").cast("double").alias("_increase"),
        F.col("_first").cast("double").alias("_first"),
        sampled,
        ((F.col("_from") - (end - window_s * _MILLION)) / F.lit(_MILLION)).alias("_before"),
        ((end - F.col("_to")) / F.lit(_MILLION)).alias("_after"),
    )
    spacing = F.col("_sampled") / (F.col("samples") - 1)

    def towards(edge: str) -> Column:
        return F.when(F.col(edge) >= spacing * 1.1, spacing / 2).otherwise(F.col(edge))

    counts = (F.col("_increase") > 0) & (F.col("_first") >= 0)
    to_zero = F.col("_sampled") * F.try_divide(F.col("_first"), F.col("_increase"))
    before = F.when(counts, F.least(towards("_before"), to_zero)).otherwise(towards("_before"))
    covered = (F.col("_sampled") + before + towards("_after")) / F.col("_sampled")
    return per.select(*series, "ts", "samples", (F.col("_increase") * covered / F.lit(float(window_s))).alias("rate"))


def extrapolated_rate_sum(
    samples: DataFrame,
    window: str,
    step: str,
    by: Sequence[str] = BY,
    series: Sequence[str] = SERIES,
    sign: int = 1,
    digits: int = 6,
    **cols,
) -> DataFrame:
    """``sum by (by)(rate(counter[window]))`` with extrapolation, rounded to ``digits``: ``by…, ts, rate``.

    Sums of floating-point numbers depend on their order in the last bits; the rounding takes those away.
    """
    per = extrapolated_rate(samples, window, step, series, **cols)
    return per.groupBy(*by, "ts").agg(F.round(float(sign) * F.sum("rate"), digits).alias("rate"))
