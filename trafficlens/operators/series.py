"""Ordered per-series operators that stay balanced when one series is huge.

A plain ``Window.partitionBy(series)`` sends a whole series to one task; if one
series holds a third of all rows, that task holds a third of the data. These
operators split each series into time chunks (whole ``chunk_unit``s since the
epoch, a ``bigint`` computed on the wall clock of ``ts``; no session time zone):

1. per-chunk summaries (a partial aggregation, so hot series are pre-reduced),
2. a window over the *chunk summaries* of a series (bounded by the number of
   chunks in the time range, not by rows),
3. a window per (series, chunk) over the rows, and a join of (2) back on
   (series, chunk). The rows side is already hash-partitioned on those keys by
   step 3, so only the small summary side is shuffled for the join.

The largest task then holds one chunk of one series. The chunk summaries and
the row windows both read the input (two scans of a columnar source); caching
or checkpointing the rows instead would cost a full write and read back, which
is dearer than a second pruned scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .keys import join_on_keys

_CHUNK = "_chunk"


def _order(ts: str, tiebreak: str | None) -> list[str]:
    return [ts] if tiebreak is None else [ts, tiebreak]


def _chunk(ts: str, chunk_unit: str) -> Column:
    """Chunk index: whole ``chunk_unit``s from the epoch to ``ts`` (non-decreasing in ``ts``)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff(chunk_unit.upper(), epoch, F.col(ts).cast("timestamp_ntz"))


def _join_on_keys(rows: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Null-safe equi-join of ``rows`` with ``summary`` on ``keys`` + chunk."""
    return join_on_keys(rows, summary, [*keys, _CHUNK])


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tiebreak: str | None,
    value: str,
    out: str,
    chunk_unit: str = "hour",
) -> DataFrame:
    """Add ``out`` = running sum of ``value`` per series ``keys`` in (ts, tiebreak) order."""
    rows = df.withColumn(_CHUNK, _chunk(ts, chunk_unit))
    sums = rows.groupBy(*keys, _CHUNK).agg(F.sum(value).alias("_chunk_sum"))
    earlier = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *keys, _CHUNK, F.coalesce(F.sum("_chunk_sum").over(earlier), F.lit(0)).alias("_offset")
    )
    upto = (
        Window.partitionBy(*keys, _CHUNK)
        .orderBy(*_order(ts, tiebreak))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = rows.withColumn("_local", F.sum(value).over(upto))
    joined = _join_on_keys(local, offsets, keys)
    return joined.withColumn(out, F.col("_offset") + F.col("_local")).drop(_CHUNK, "_offset", "_local")


_RN_BITS = 40  # row number inside a chunk; the chunk index goes above it


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tiebreak: str | None,
    value: str,
    out: str,
    chunk_unit: str = "hour",
    seq_out: str | None = None,
) -> DataFrame:
    """Add ``out`` = ``value`` of the previous row of the same series (null for the first row).

    With ``seq_out``, also a ``bigint`` that increases strictly with (ts, tiebreak)
    inside each series (chunk index, then row number in the chunk): a fixed-width
    ordering key, so later ``min_by``/``max_by`` stay hash aggregates.
    """
    rows = df.withColumn(_CHUNK, _chunk(ts, chunk_unit))
    within = Window.partitionBy(*keys, _CHUNK).orderBy(*_order(ts, tiebreak))
    local = rows.withColumn("_rn", F.row_number().over(within)).withColumn("_lag", F.lag(value).over(within))
    # Last value of each chunk, from the rows already clustered by (series, chunk):
    # no shuffle, and a bigint ordering key keeps it a hash aggregate.
    lasts = local.groupBy(*keys, _CHUNK).agg(F.max_by(value, "_rn").alias("_last"))
    carry = lasts.select(
        *keys, _CHUNK, F.lag("_last").over(Window.partitionBy(*keys).orderBy(_CHUNK)).alias("_carry")
    )
    joined = _join_on_keys(local, carry, keys)
    prev = F.when(F.col("_rn") == 1, F.col("_carry")).otherwise(F.col("_lag"))
    joined = joined.withColumn(out, prev)
    if seq_out:
        seq = F.shiftleft(F.col(_CHUNK), _RN_BITS) + F.col("_rn")
        joined = joined.withColumn(seq_out, seq)
    return joined.drop(_CHUNK, "_rn", "_lag", "_carry")
