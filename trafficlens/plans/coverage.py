"""Dataset coverage against an hourly calendar.

The expected dataset is every hour of ``days`` days from ``start`` (one dump per
hour). Missing hours are found from the *observed* hours only: per key, the
distinct observed hours are ordered and each jump between neighbours (or from
the calendar's edges) is expanded into the hours it skips. No calendar x keys
product is ever formed, the input is scanned once, and the window runs over
distinct hours (at most days x 24 per key), never over raw rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import hour_timestamp, with_day_hour


def _one_hour():
    return F.expr("INTERVAL 1 HOUR")


def _bounds(start: str | dt.date, days: int) -> tuple[dt.datetime, dt.datetime]:
    first = dt.datetime.combine(dt.date.fromisoformat(str(start)), dt.time())
    return first, first + dt.timedelta(days=days) - dt.timedelta(hours=1)


def _ntz(value: dt.datetime):
    """A ``timestamp_ntz`` literal (from text: a Python datetime literal would pass through the
    session time zone)."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def observed_hours(df: DataFrame, keys: Sequence[str] = (), day: str = "day", hour: str = "hour") -> DataFrame:
    """Distinct ``keys…, hour_ts`` seen in a frame carrying dump ``day``/``hour`` columns."""
    return df.select(*keys, hour_timestamp(day, hour).alias("hour_ts")).where(F.col("hour_ts").isNotNull()).distinct()


def _in_calendar(hours: DataFrame, start: str | dt.date, days: int, keys: Sequence[str]) -> DataFrame:
    """Distinct observed hours; those outside the calendar become the hour just before it.

    That mark keeps a key that was never seen inside the calendar.
    """
    first, last = _bounds(start, days)
    inside = F.col("hour_ts").between(_ntz(first), _ntz(last))
    hour = F.when(inside, F.col("hour_ts")).otherwise(_ntz(first - dt.timedelta(hours=1)))
    return hours.select(*keys, hour.alias("hour_ts")).distinct()


def coverage_gaps(hours: DataFrame, start: str | dt.date, days: int, keys: Sequence[str] = ()) -> DataFrame:
    """Calendar hours with no observation, per key: ``keys…, day, hour``.

    ``hours`` holds ``keys…, hour_ts`` (see :func:`observed_hours`). A key with hours
    only outside the calendar lacks every hour of it. One pass over the
    distinct observed hours: each hour emits the gap before it (from the previous
    hour of its key, or from the calendar start) and the last hour of a key also
    the gap after it, up to the calendar end.
    """
    first, last = _bounds(start, days)
    seen = _in_calendar(hours, start, days, keys)
    if not keys:
        # a sentinel just before the calendar, so an empty input reports every hour
        before_start = _ntz(first - dt.timedelta(hours=1))
        seen = seen.unionByName(hours.sparkSession.range(1).select(before_start.alias("hour_ts")))
    order = Window.partitionBy(*keys).orderBy("hour_ts")
    neighbours = seen.select(
        *keys, "hour_ts", F.lag("hour_ts").over(order).alias("_prev"), F.lead("hour_ts").over(order).alias("_next")
    )
    ts = F.col("hour_ts")
    gap_before = F.struct(
        F.coalesce(F.col("_prev") + _one_hour(), _ntz(first)).alias("s"), (ts - _one_hour()).alias("e")
    )
    gap_after = F.when(F.col("_next").isNull(), F.struct((ts + _one_hour()).alias("s"), _ntz(last).alias("e")))
    gaps = (
        neighbours.select(*keys, F.explode(F.array(gap_before, gap_after)).alias("g"))
        .where(F.col("g").isNotNull() & (F.col("g.s") <= F.col("g.e")))
    )
    missing = gaps.select(*keys, F.explode(F.sequence("g.s", "g.e", _one_hour())).alias("hour_ts"))
    return with_day_hour(missing).select(*keys, "day", "hour")


def coverage_summary(hours: DataFrame, start: str | dt.date, days: int, keys: Sequence[str] = ()) -> DataFrame:
    """``keys…, expected, present, missing, complete`` (present = distinct calendar hours seen)."""
    expected = days * 24
    seen = _in_calendar(hours, start, days, keys)
    first, _ = _bounds(start, days)
    present = F.count(F.when(F.col("hour_ts") >= _ntz(first), 1))
    counted = seen.groupBy(*keys).agg(present.alias("present"))
    return counted.select(
        *keys,
        F.lit(expected).cast("bigint").alias("expected"),
        "present",
        (F.lit(expected) - F.col("present")).cast("bigint").alias("missing"),
        (F.col("present") == expected).alias("complete"),
    )
