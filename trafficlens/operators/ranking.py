"""Global row numbers without a single-task window and without a copy of the input.

The rows are cut into runs of the order by bounds taken from a deterministic
sample of the keys, so a row's run is a pure function of the row: the counting
pass and the numbering pass agree, and a lost executor recomputes the same runs.
A hash of the whole row breaks ties, so a sort key that many rows share is still
cut into several runs.

The bounds never pass through the driver and are no literals of the plan. They are
a table of two levels in the session's shared folder: FAN x FAN runs at most, FAN
coarse ones, each with the bounds of its finer ones. A row finds its coarse run by
the top level (one row, a scalar subquery), the finer one by a join on the coarse
run's number (at most FAN rows), both by a search among at most FAN bounds.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_path

ROWS_PER_RUN = 100_000
FAN = 128  # coarse runs, and runs of each: the bounds have at most FAN * FAN rows, their sample SAMPLED_PER_RUN times as many
SAMPLED_PER_RUN = 32


def run_number(key: Column, bounds: Sequence[Column]) -> Column:
    """How many of the rising ``bounds`` lie at or below ``key``, by a tree of comparisons; a null bound lies above all."""

    def pick(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        at_least = F.coalesce(key >= bounds[middle], F.lit(False))
        return F.when(at_least, pick(middle + 1, high)).otherwise(pick(low, middle))

    return pick(0, len(bounds))


def run_bounds(keyed: DataFrame, names: Sequence[str], fan: int, rows: int) -> DataFrame:
    """``coarse, fine, key``: the lower bound of each of at most ``fan * fan`` runs but the first, stored.

    The sample is ordered by one task; its size follows ``fan``, not the input.
    """
    every = max(1, rows // (fan * fan * SAMPLED_PER_RUN))
    sample = keyed.where(F.pmod(F.xxhash64("_tie"), F.lit(every)) == 0).select(*names).distinct()
    at = F.row_number().over(Window.orderBy(*names)) - 1
    slot = (F.col("_at") / SAMPLED_PER_RUN).cast("int")
    cut = sample.withColumn("_at", at).where((F.col("_at") % SAMPLED_PER_RUN == 0) & (F.col("_at") > 0))
    bounds = cut.where(slot < fan * fan).select(
        (slot / fan).cast("int").alias("coarse"), (slot % fan).cast("int").alias("fine"), F.struct(*names).alias("key")
    )
    path = shared_path(keyed.sparkSession, "bounds")
    bounds.write.parquet(path)
    return keyed.sparkSession.read.schema(bounds.schema).parquet(path)


def _in_order(place: str) -> Column:
    """The keys of a group of bounds as an array, in the order of ``place``."""
    return F.transform(F.array_sort(F.collect_list(F.struct(place, "key"))), lambda b: b["key"])


def placed_in_runs(keyed: DataFrame, names: Sequence[str], bounds: DataFrame, fan: int) -> DataFrame:
    """``keyed`` with ``_run``, the number of each row's run in the order."""
    key = F.struct(*names)
    top = bounds.where("fine = 0").agg(_in_order("coarse").alias("keys")).scalar()
    tops = keyed.withColumn("_top", top)
    coarse = run_number(key, [F.get("_top", F.lit(i)) for i in range(fan - 1)])
    rows = tops.withColumn("_coarse", coarse).drop("_top")
    finer = bounds.where("fine > 0").groupBy(F.col("coarse").alias("_c")).agg(_in_order("fine").alias("_keys"))
    joined = rows.join(F.broadcast(finer), F.col("_coarse") == F.col("_c"), "left")
    fine = run_number(key, [F.get("_keys", F.lit(i)) for i in range(fan - 1)])
    return joined.withColumn("_run", F.col("_coarse") * fan + fine).drop("_coarse", "_c", "_keys")


def global_row_number(df: DataFrame, order: Sequence[Column | str], out: str = "row_number") -> DataFrame:
    """Add ``out`` = 1-based position of each row in rising ``order``, nulls first (ties by a hash of the row).

    ``order`` holds columns or value expressions; negate a number for a falling
    order. Counts the rows and stores the bounds when called; then two lazy passes, a
    count per run and one shuffle of the rows by run.
    """
    values = [F.col(o) if isinstance(o, str) else o for o in order]
    names = [f"_k{i}" for i in range(len(values))] + ["_tie"]
    keyed = df.select("*", *[v.alias(n) for v, n in zip(values, names)], F.xxhash64(*df.columns).alias("_tie"))
    rows = df.count()
    fan = min(FAN, max(2, math.ceil(math.sqrt(rows / ROWS_PER_RUN))))
    placed = placed_in_runs(keyed, names, run_bounds(keyed, names, fan, rows), fan)
    sizes = placed.groupBy("_run").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)  # at most FAN * FAN rows
    offsets = sizes.select("_run", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_run").orderBy(*names))
    numbered = placed.withColumn("_at", inside).join(offsets, "_run")
    return numbered.withColumn(out, F.col("_offset") + F.col("_at")).drop("_run", "_at", "_offset", *names)
