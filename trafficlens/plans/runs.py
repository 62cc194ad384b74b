"""Statistics over a run manifest: ordinal, per-configuration summary, scaling.

A run belongs to a job ``family`` (the job name before the first ``_``) and a
``parallelism``. The summary gives count, exact median, min, max and spread per
(family, parallelism); scaling compares each parallelism's median with the
smallest parallelism of its family (speedup, efficiency, Amdahl serial part).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.quantiles import group_median
from ..operators.ranking import global_row_number

GROUP = ("family", "parallelism")


def run_ordinal(runs: DataFrame, order: Sequence[str] = ("ts_utc", "run_id")) -> DataFrame:
    """Runs numbered 1.. in start-time order (``ordinal`` bigint), without a single-task window."""
    return global_row_number(runs, list(order), "ordinal")


def run_families(runs: DataFrame) -> DataFrame:
    """Distinct (family, parallelism) configurations present in the manifest, in order."""
    return runs.select(*GROUP).distinct().orderBy(*GROUP)


def run_summary(runs: DataFrame, value: str = "duration_s") -> DataFrame:
    """``family, parallelism, n, median_s, min_s, max_s, spread_pct`` per configuration.

    ``spread_pct = (max - min) / median * 100`` for two runs or more, 0 for a single
    run, null when the median is 0.
    """
    stats = group_median(runs, GROUP, value, "median_s", stats=True)
    spread = F.try_divide(F.col("max") - F.col("min"), F.col("median_s")) * 100
    return stats.select(
        *GROUP,
        F.col("n").alias("n"),
        "median_s",
        F.col("min").alias("min_s"),
        F.col("max").alias("max_s"),
        F.when(F.col("n") > 1, spread).otherwise(F.lit(0.0)).alias("spread_pct"),
    ).orderBy(*GROUP)


def run_scaling(runs: DataFrame, value: str = "duration_s") -> DataFrame:
    """``family, parallelism, median_s, speedup, efficiency, seq_fraction``.

    Baseline = the family's smallest parallelism ``p0`` and its median ``m0``;
    ``speedup = m0 / m``, ``n = p / p0``, ``efficiency = speedup / n``, and the Amdahl
    serial fraction ``max(((n / speedup) - 1) / (n - 1), 0)``: null at the baseline
    itself (n = 1), 0 when the speedup is 0. The window runs over the per-configuration
    summary (one row per configuration), never over runs.
    """
    med = group_median(runs, GROUP, value, "median_s")
    first = Window.partitionBy("family").orderBy("parallelism").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    based = med.select(
        *GROUP,
        "median_s",
        F.first("parallelism").over(first).alias("_p0"),
        F.first("median_s").over(first).alias("_m0"),
    )
    speedup = F.try_divide(F.col("_m0"), F.col("median_s"))
    n = F.try_divide(F.col("parallelism"), F.col("_p0"))
    amdahl = F.greatest(F.try_divide(F.try_divide(n, F.col("speedup")) - 1, n - 1), F.lit(0.0))
    seq = (
        F.when(n == 1, F.lit(None).cast("double"))
        .when(F.col("speedup") == 0, F.lit(0.0))
        .otherwise(amdahl)
    )
    return (
        based.withColumn("speedup", speedup)
        .withColumn("efficiency", F.try_divide(F.col("speedup"), n))
        .withColumn("seq_fraction", seq)
        .select(*GROUP, "median_s", "speedup", "efficiency", "seq_fraction")
        .orderBy(*GROUP)
    )
