"""ANSI-safe ratio expressions."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def pct(part: Column, whole: Column, digits: int) -> Column:
    """``round(100 * part / whole, digits)``; null when ``whole`` is 0 or null (no ANSI error)."""
    return F.round(F.try_divide(F.lit(100.0) * part, whole), digits)


def share_of_total(col: str, digits: int = 3) -> Column:
    """Share of ``col`` in its column total, in percent.

    The total is a keyless window sum, so it is computed in the same pass as the
    rows (no separate action). A zero or null total counts as 1. Only use on a
    frame of bounded size (after a limit or on a small aggregate): a keyless
    window runs in one task.
    """
    total = F.sum(col).over(Window.partitionBy())
    denominator = F.coalesce(F.nullif(total, F.lit(0)), F.lit(1))
    return F.round(F.lit(100.0) * F.col(col) / denominator, digits)
