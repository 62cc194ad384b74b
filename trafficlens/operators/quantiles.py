"""Exact group median by selection: no group is gathered, and none is ranked as a whole.

``median``/``percentile`` keep every distinct value of a group in one in-memory
buffer. Here each group has a middle range, at first all its values. While a
range holds more than SMALL rows it is narrowed: a mergeable sketch of the rows
inside gives the group bounds just around the middle ranks (weighted by the rows,
so a value that fills half the group is one bound), and an exact count of the
rows below and between them confirms the new range; where the sketch was off, the
old range stays. Both steps are partial aggregations over all tasks, for all large
groups together. What is left of each group is ranked: at most about SMALL rows, or
few distinct values.

The ranges are one row a group, written to the session's shared folder between the
rounds. A round shrinks a range by a factor of some hundreds, so no input needs more
than a handful; the driver sees one number a round.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_path
from .keys import join_on_keys

SMALL = 100_000  # rows of a group's middle range that are ranked together
CUTS = 1_000  # quantiles of a range among which its narrower bounds are chosen
ACCURACY = 10_000  # of the sketch: ranks are off by at most the rows divided by this
ROUNDS = 8


def _stored(ranges: DataFrame) -> DataFrame:
    path = shared_path(ranges.sparkSession, "ranges")
    ranges.write.parquet(path)
    return ranges.sparkSession.read.schema(ranges.schema).parquet(path)


def _low_rank() -> Column:
    return F.floor((F.col("n") - 1) / 2)


def _high_rank() -> Column:
    return F.floor(F.col("n") / 2)


def _inside(rows: DataFrame, ranges: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows whose value lies in their group's range, with the range's columns."""
    return join_on_keys(rows, ranges, keys).where(F.col(value).between(F.col("_lo"), F.col("_hi")))


def narrowed(rows: DataFrame, ranges: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The ranges of the same groups, cut by a sketch of the rows inside and confirmed by exact counts."""
    sketch = _inside(rows, ranges.select(*keys, "_lo", "_hi"), keys, value).groupBy(*keys).agg(
        F.percentile_approx(value, [k / CUTS for k in range(CUTS + 1)], ACCURACY).alias("_cuts")
    )
    off = F.lit(1.5 / ACCURACY)
    low = F.floor(((_low_rank() - F.col("_before")) / F.col("_within") - off) * CUTS)
    high = F.ceil(((_high_rank() - F.col("_before") + 1) / F.col("_within") + off) * CUTS)
    guess = join_on_keys(ranges, sketch, keys).select(
        *ranges.columns,
        F.get("_cuts", F.greatest(low, F.lit(0)).cast("int")).alias("_a"),
        F.get("_cuts", F.least(high, F.lit(CUTS)).cast("int")).alias("_b"),
    )
    counted = _inside(rows, guess.select(*keys, "_lo", "_hi", "_a", "_b"), keys, value).groupBy(*keys).agg(
        F.count(F.when(F.col(value) < F.col("_a"), 1)).alias("_below"),
        F.count(F.when(F.col(value).between(F.col("_a"), F.col("_b")), 1)).alias("_between"),
    )
    checked = join_on_keys(guess, counted, keys)
    before = F.col("_before") + F.col("_below")
    holds = (before <= _low_rank()) & (_high_rank() < before + F.col("_between"))
    return checked.select(
        *keys,
        "n",
        "min",
        "max",
        *[
            F.when(holds, new).otherwise(F.col(old)).alias(old)
            for old, new in (
                ("_lo", F.col("_a")), ("_hi", F.col("_b")), ("_before", before), ("_within", F.col("_between"))
            )
        ],
        (holds & (F.col("_between") < F.col("_within"))).alias("_open"),
    )


def middle_ranges(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``keys…, n, min, max, _lo, _hi, _before, _within``: where each group's middle ranks lie.

    ``_before`` rows of the group are smaller than ``_lo``, ``_within`` lie in the range.
    """
    totals = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(value).alias("min"), F.max(value).alias("max")
    )
    ranges = totals.select(
        "*",
        F.col("min").alias("_lo"),
        F.col("max").alias("_hi"),
        F.lit(0).cast("bigint").alias("_before"),
        F.col("n").alias("_within"),
        F.lit(True).alias("_open"),
    )
    ranges = _stored(ranges)
    for _ in range(ROUNDS):
        large = F.col("_open") & (F.col("_within") > SMALL) & (F.col("_lo") < F.col("_hi"))
        if ranges.where(large).isEmpty():
            break
        ranges = _stored(ranges.where(~large).unionByName(narrowed(rows, ranges.where(large), keys, value)))
    return ranges.drop("_open")


def group_median(
    df: DataFrame, keys: Sequence[str], value: str, out: str = "median", stats: bool = False
) -> DataFrame:
    """Exact median of ``value`` per ``keys``: ``keys…, out`` (plus ``n, min, max`` with ``stats``).

    Even sizes give the mean of the two middle values, ``(a + b) / 2``; nulls are ignored.
    Runs the sizing rounds when called; the ranking itself is lazy.
    """
    rows = df.where(F.col(value).isNotNull()).select(*keys, value)
    ranges = middle_ranges(rows, keys, value)
    middle = _inside(rows, ranges.select(*keys, "_lo", "_hi", "_before", "n"), keys, value)
    counts = middle.groupBy(*keys, value, "_before", "n").agg(F.count(F.lit(1)).alias("_c"))
    rising = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("_last", F.col("_before") + F.sum("_c").over(rising)).withColumn(
        "_first", F.col("_last") - F.col("_c")
    )

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_first") <= rank) & (rank < F.col("_last")), F.col(value)))

    picked = ranked.groupBy(*keys).agg(at(_low_rank()).alias("_lo"), at(_high_rank()).alias("_hi"))
    result = picked.select(*keys, ((F.col("_lo") + F.col("_hi")) / 2).alias(out))
    if not stats:
        return result
    return join_on_keys(result, ranges.select(*keys, "n", "min", "max"), keys).select(*keys, out, "n", "min", "max")
