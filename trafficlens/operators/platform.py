"""Desktop / mobile split and the shared views aggregation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import MOBILE_PROJECTS


def add_platform(df: DataFrame, mobile_projects: Iterable[str] = MOBILE_PROJECTS) -> DataFrame:
    """``platform``: ``mobile`` for the mobile projects, ``desktop`` otherwise.

    Only meaningful after the project filter: any other project would count as desktop.
    """
    mobile = F.col("project").isin(*mobile_projects)
    return df.withColumn("platform", F.when(mobile, F.lit("mobile")).otherwise(F.lit("desktop")))


def _views_on(platform: str) -> Column:
    return F.when(F.col("platform") == platform, F.col("views")).otherwise(F.lit(0))


def platform_views(
    df: DataFrame, *keys: str | Column, total: str = "views", extra: Sequence[Column] = ()
) -> DataFrame:
    """Views per key with the desktop/mobile split, in one aggregation.

    Output: ``keys…, <total>, extra…, views_desktop, views_mobile`` (sums are bigint;
    a group without mobile rows has ``views_mobile = 0``, not null). Spark plans a
    partial aggregate before the shuffle, so a hot key costs one row per map task.
    """
    return df.groupBy(*keys).agg(
        F.sum("views").alias(total),
        *extra,
        F.sum(_views_on("desktop")).alias("views_desktop"),
        F.sum(_views_on("mobile")).alias("views_mobile"),
    )
