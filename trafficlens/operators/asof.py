"""As-of join: for each left row the latest right row of its key, no older than a tolerance.

A plain window over (key) would gather a whole series in one task, and an
inequality join would pair every row with all earlier ones. Here both sides are
cut into time chunks of a fixed length; a chunk needs only its own rows and the
last right row of each earlier chunk that the tolerance still reaches (a *carry*,
one row a chunk). One shuffle by (key, chunk) then puts them together, and one
pass in time order hands every left row the right row before it. The largest
task holds one chunk of one key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefmt import micros, sample_order

_MILLION = 1_000_000


def chunk_of(at: Column, chunk_seconds: int) -> Column:
    """Chunk number of a time in microseconds: chunk ``c`` holds ``[c, c + 1) * chunk_seconds``."""
    return F.floor(at / F.lit(chunk_seconds * _MILLION)).cast("bigint")


def carries(chunk_seconds: int, tolerance_seconds: int) -> int:
    """Chunks after its own in which a row may still be the latest one."""
    return -(-tolerance_seconds // chunk_seconds)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    tolerance_seconds: int,
    values: Sequence[str],
    left_ts: str = "ts",
    right_ts: str = "ts",
    tiebreak: str | None = None,
    chunk_seconds: int = 86_400,
    matched_ts: str = "matched_ts",
) -> DataFrame:
    """``left`` with ``values`` and ``matched_ts`` of the latest right row of the same ``keys``.

    A right row serves a left row when ``right_ts <= left_ts < right_ts + tolerance``;
    of several the latest wins, at equal times the largest ``tiebreak``. Null keys
    equal null keys. Left rows without a match keep nulls, right rows without a
    time are left out, and left rows without a time match nothing.
    """
    own = [c for c in left.columns if c not in keys]
    rows = left.select(
        *keys,
        micros(left_ts).alias("_at"),
        F.lit(1).alias("_side"),
        F.lit(None).cast("bigint").alias("_tie"),
        F.struct(*[F.col(c) for c in own]).alias("_left"),
    ).withColumn("_chunk", chunk_of(F.col("_at"), chunk_seconds))
    tie = F.lit(None).cast("bigint") if tiebreak is None else F.col(tiebreak).cast("bigint")
    kept = [F.col(v) for v in values]
    facts = (
        right.where(F.col(right_ts).isNotNull())
        .select(
            *keys,
            F.col(right_ts).alias("_ts"),
            micros(right_ts).alias("_at"),
            F.lit(0).alias("_side"),
            tie.alias("_tie"),
            F.struct(*kept, F.col(right_ts).alias(matched_ts)).alias("_right"),
        )
        .withColumn("_chunk", chunk_of(F.col("_at"), chunk_seconds))
    )
    # Column by column: of fixed-width values this stays a hash aggregate, of a struct it would sort.
    order = sample_order("_ts", None if tiebreak is None else "_tie")
    last = facts.groupBy(*keys, "_chunk").agg(
        *[F.max_by(f"_right.{v}", order).alias(v) for v in values],
        F.max("_ts").alias(matched_ts),
        F.max("_at").alias("_at"),
        F.max_by("_tie", order).alias("_tie"),
    )
    facts = facts.drop("_ts")
    reach = F.sequence(F.col("_chunk") + 1, F.col("_chunk") + carries(chunk_seconds, tolerance_seconds))
    carried = last.withColumn("_chunk", F.explode(reach)).select(
        *keys, "_chunk", "_at", "_tie", F.struct(*values, matched_ts).alias("_right"), F.lit(0).alias("_side")
    )
    together = rows.unionByName(facts, allowMissingColumns=True).unionByName(carried, allowMissingColumns=True)
    upto = (
        Window.partitionBy(*keys, "_chunk")
        .orderBy("_at", "_side", "_tie")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    latest = F.last("_right", ignorenulls=True).over(upto)
    joined = together.withColumn("_found", latest).where(F.col("_side") == 1)
    fresh = F.col("_at") - micros(F.col(f"_found.{matched_ts}")) < F.lit(tolerance_seconds * _MILLION)
    found = F.when(fresh, F.col("_found"))
    return joined.select(*keys, "_left.*", *[found[v].alias(v) for v in (*values, matched_ts)])
