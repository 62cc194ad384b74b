"""Joins on group keys that keep null keys (``groupBy`` treats null as a group)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` with null-safe equality; the right side's key columns are dropped."""
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"_r_{k}")
    cond = [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])
