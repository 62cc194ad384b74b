"""Text and number forms of ``timestamp_ntz`` values, apart from the session time zone.

``date_format`` on a ``timestamp_ntz`` goes through the session time zone
(Spark casts it to a zoned timestamp first), so in a zone with daylight saving a
wall-clock time inside the spring gap would print one hour off. Field
extraction (``year``, ``hour``, …) reads the wall clock directly.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _pad(c: Column, width: int) -> Column:
    return F.lpad(c.cast("string"), width, "0")


def _col(ts: Column | str) -> Column:
    return F.col(ts) if isinstance(ts, str) else ts


def day_text(ts: Column | str) -> Column:
    """``yyyyMMdd``."""
    t = _col(ts)
    return F.concat(_pad(F.year(t), 4), _pad(F.month(t), 2), _pad(F.dayofmonth(t), 2))


def hour_text(ts: Column | str) -> Column:
    """``HH`` (00-23)."""
    return _pad(F.hour(_col(ts)), 2)


def month_text(ts: Column | str) -> Column:
    """``yyyy-MM``."""
    t = _col(ts)
    return F.concat(_pad(F.year(t), 4), F.lit("-"), _pad(F.month(t), 2))


def iso_seconds_text(ts: Column | str) -> Column:
    """``yyyy-MM-ddTHH:mm:ss``."""
    t = _col(ts)
    return F.concat(
        month_text(t), F.lit("-"), _pad(F.dayofmonth(t), 2), F.lit("T"),
        _pad(F.hour(t), 2), F.lit(":"), _pad(F.minute(t), 2), F.lit(":"), _pad(F.second(t), 2),
    )


def micros(ts: Column | str) -> Column:
    """Microseconds from the epoch to a wall-clock time, a ``bigint``."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, _col(ts).cast("timestamp_ntz"))


def from_micros(value: Column | str) -> Column:
    """The ``timestamp_ntz`` that lies ``value`` microseconds after the epoch."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = _col(value).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")
    return epoch + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def sample_order(ts: str, tiebreak: str | None) -> Column:
    """Sample order as one fixed-width value, so ``max_by`` stays a hash aggregate.

    Microseconds since the epoch times 2**64 plus the tie-break shifted to be
    non-negative: a ``decimal(38,0)`` that orders like (ts, tiebreak).
    """
    if tiebreak is None:
        return F.col(ts)
    wide = micros(ts).cast("decimal(18,0)") * F.lit(Decimal(1 << 64)).cast("decimal(20,0)")
    low = F.col(tiebreak).cast("bigint").cast("decimal(19,0)") + F.lit(Decimal(1 << 63)).cast("decimal(19,0)")
    return (wide.cast("decimal(38,0)") + low.cast("decimal(38,0)")).cast("decimal(38,0)")
