"""Aggregations over metric samples: latest gauges, counter rates, sums by label.

A sample table has label columns (``series``, e.g. ``name, k``), a time column,
a tie-break column and a value. A *series* is one label combination.

These are the dashboard calculations expressed over a table instead of a
time-series server:

* latest value of each series, summed by label (``sum(gauge)``);
* counter rate over a sliding window, summed by label (``sum by (name)(rate(c[w]))``);
* gauge summed by label per step (``sum by (name)(g)``);
* anchored label regex matching (``name=~"..."``) and per-series reductions.

Rate semantics: the increase of a counter between the first and last sample of a
window ``[end - w, end)``, corrected for resets (a drop counts the new value as
the increase), divided by the window length in seconds; a series needs at least
two samples in the window. Unlike a time-series server, there is no
extrapolation to the window edges; evaluation instants are the window ends on
the ``step`` grid, aligned to the epoch.

Scale: every stage is a partial aggregation or a window over per-bucket
summaries. Samples are first reduced per (series, step bucket); each bucket
summary is then fanned out to the ``w / step`` windows that contain it, so the
fan-out multiplies buckets, not samples. Per-series ordering (the previous
value of a counter) is computed chunk-wise, so one huge series is not one task.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import anchored
from ..functions.timefmt import sample_order
from ..operators.series import previous_value

SERIES = ("name", "k")
BY = ("name",)


_UNIT_SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86400}
_DURATION = re.compile(r"^\s*(\d+)\s*(s|sec|secs|seconds?|m|min|mins|minutes?|h|hours?|d|days?)\s*$")


def duration_seconds(duration: str) -> int:
    """Seconds in a duration such as ``'6 hours'``, ``'1 hour'``, ``'30s'`` or ``'5m'``."""
    match = _DURATION.match(duration)
    if not match:
        raise ValueError(f"unsupported duration {duration!r}")
    return int(match.group(1)) * _UNIT_SECONDS[match.group(2)[0]]


def _spark_duration(duration: str) -> str:
    """The same duration in the form Spark's ``window`` accepts."""
    return f"{duration_seconds(duration)} seconds"


def latest(
    samples: DataFrame,
    series: Sequence[str] = SERIES,
    ts: str = "ts",
    tiebreak: str | None = "event_id",
    value: str = "v",
) -> DataFrame:
    """Latest value of each series: ``series…, value``."""
    return samples.groupBy(*series).agg(F.max_by(value, sample_order(ts, tiebreak)).alias("value"))


def latest_sum(samples: DataFrame, by: Sequence[str] = BY, series: Sequence[str] = SERIES, **cols) -> DataFrame:
    """Sum over series of their latest value, per ``by`` labels: ``by…, value``."""
    return latest(samples, series, **cols).groupBy(*by).agg(F.sum("value").alias("value"))


def sum_of_two(
    samples: DataFrame, first: str, second: str, metric: str = "name", series: Sequence[str] = SERIES, **cols
) -> DataFrame:
    """``sum(first) + sum(second)`` of latest gauge values, one row ``value`` (null if one is absent)."""
    last = latest(samples.where(F.col(metric).isin(first, second)), series, **cols)
    part = [F.sum(F.when(F.col(metric) == m, F.col("value"))) for m in (first, second)]
    return last.agg((part[0] + part[1]).alias("value"))


def with_increase(
    samples: DataFrame,
    series: Sequence[str] = SERIES,
    ts: str = "ts",
    tiebreak: str | None = "event_id",
    value: str = "v",
    chunk_unit: str = "hour",
) -> DataFrame:
    """Add ``inc``: counter increase since the previous sample of the series (0 for the first;
    after a reset the new value), and ``seq``: a ``bigint`` ordering key equivalent to
    (ts, tiebreak) within the series."""
    prev = previous_value(samples, series, ts, tiebreak, value, "_prev", chunk_unit, seq_out="seq")
    inc = (
        F.when(F.col("_prev").isNull(), F.lit(0))
        .when(F.col(value) >= F.col("_prev"), F.col(value) - F.col("_prev"))
        .otherwise(F.col(value))
    )
    return prev.withColumn("inc", inc).drop("_prev")


def counter_increase_windows(
    samples: DataFrame,
    window: str,
    step: str,
    series: Sequence[str] = SERIES,
    ts: str = "ts",
    tiebreak: str | None = "event_id",
    value: str = "v",
) -> DataFrame:
    """Per series and window end: reset-corrected increase within ``[end - window, end)``.

    ``series…, ts (window end), increase, samples``; only windows with two samples or more.
    """
    w_s, s_s = duration_seconds(window), duration_seconds(step)
    if w_s % s_s:
        raise ValueError("window must be a whole number of steps")
    inc = with_increase(samples, series, ts, tiebreak, value)
    # "seq" orders samples like (ts, tiebreak) but is one bigint: hash aggregation, no sorts.
    buckets = inc.groupBy(*series, F.window(ts, _spark_duration(step)).alias("_b")).agg(
        F.sum("inc").alias("_sum"),
        F.count(F.lit(1)).alias("_n"),
        F.min_by("inc", "seq").alias("_first"),
        F.min("seq").alias("_first_key"),
    )
    offsets = F.sequence(F.lit(0), F.lit(w_s // s_s - 1))
    fanned = buckets.select(
        *series, "_sum", "_n", "_first", "_first_key", F.explode(offsets).alias("_j"), F.col("_b.end").alias("_end")
    ).withColumn("ts", F.col("_end") + F.make_dt_interval(secs=(F.col("_j") * s_s).cast("decimal(18,6)")))
    per_window = fanned.groupBy(*series, "ts").agg(
        F.sum("_sum").alias("_total"), F.sum("_n").alias("samples"), F.min_by("_first", "_first_key").alias("_f")
    )
    return per_window.where(F.col("samples") >= 2).select(
        *series, "ts", (F.col("_total") - F.col("_f")).alias("increase"), "samples"
    )


def counter_rate(
    samples: DataFrame,
    window: str,
    step: str,
    by: Sequence[str] = BY,
    series: Sequence[str] = SERIES,
    sign: int = 1,
    **cols,
) -> DataFrame:
    """``sum by (by)(rate(counter[window]))`` on the ``step`` grid: ``by…, ts, rate`` (per second).

    Increases are summed as integers before the one division, so the result does
    not depend on summation order. ``sign=-1`` gives the sign-flipped panel form.
    """
    w_s = duration_seconds(window)
    inc = counter_increase_windows(samples, window, step, series, **cols)
    summed = inc.groupBy(*by, "ts").agg(F.sum("increase").alias("_inc"))
    return summed.select(*by, "ts", (F.lit(float(sign)) * F.col("_inc") / w_s).alias("rate"))


def sum_by_label(
    samples: DataFrame,
    step: str,
    by: Sequence[str] = BY,
    series: Sequence[str] = SERIES,
    ts: str = "ts",
    tiebreak: str | None = "event_id",
    value: str = "v",
) -> DataFrame:
    """``sum by (by)(gauge)`` per step: latest value of each series in each step bucket,
    summed by label, stamped at the bucket end: ``by…, ts, value``."""
    per_bucket = samples.groupBy(*series, F.window(ts, _spark_duration(step)).alias("_b")).agg(
        F.max_by(value, sample_order(ts, tiebreak)).alias("_last")
    )
    return per_bucket.groupBy(*by, F.col("_b.end").alias("ts")).agg(F.sum("_last").alias("value"))


def label_matches(df: DataFrame, label: str, pattern: str) -> DataFrame:
    """Rows whose ``label`` fully matches ``pattern`` (label matchers are anchored both ends)."""
    return df.where(F.col(label).rlike(anchored(pattern)))


def reduce_series(points: DataFrame, keys: Sequence[str] = BY, ts: str = "ts", value: str = "value") -> DataFrame:
    """Panel reductions per series: ``keys…, last_value, mean_value, max_value`` (nulls skipped)."""
    present = points.where(F.col(value).isNotNull())
    return present.groupBy(*keys).agg(
        F.max_by(value, ts).alias("last_value"),
        F.avg(value).alias("mean_value"),
        F.max(value).alias("max_value"),
    )
