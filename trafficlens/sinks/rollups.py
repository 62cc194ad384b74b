"""Roll-ups of the landed page views: mergeable partial aggregates by date, refreshed as hours land.

Two tables under one path, both partitioned by ``date``:

* ``titles``: ``project, title, views`` of the allow-listed projects, uncleaned, so every
  title report (top pages, daily views of a title) can be merged from it;
* ``hours``: ``hour, project, views, month, days`` of the cleaned articles, where ``days``
  is a bitmap with the bit of the date's day. Bitmaps merge by ``or``, so the number of
  distinct days of any set of dates is a count of bits, at any level of merging.

Landing more hours of a date changes only that date's partitions: :func:`refresh_rollups`
reads the landed hours of the given dates and replaces those partitions, nothing else.
A month's report then reads a few rows per page and day in place of every dump.
"""

from __future__ import annotations

import datetime as dt
import posixpath
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import DEFAULT_PROJECTS
from ..functions.timefmt import month_text
from ..operators.filters import clean_pages, only_projects
from .landing import read_landed_pageviews
from .results import write_result

TITLES_SCHEMA = "project string, title string, views bigint, date date"
HOURS_SCHEMA = "hour int, project string, views bigint, month string, days bigint, date date"


def dates_of(pv: DataFrame) -> list[dt.date]:
    """The distinct dates of a frame, in order: as many as the calendar has, few for a landing."""
    rows = pv.select("date").where(F.col("date").isNotNull()).distinct().collect()
    return sorted(r["date"] for r in rows)


def _replace(df: DataFrame, path: str) -> int:
    return write_result(
        df, path, mode="overwrite", partition_by=["date"], options={"partitionOverwriteMode": "dynamic"}
    )


def refresh_rollups(
    spark: SparkSession,
    landed: str,
    path: str,
    dates: Sequence[dt.date],
    projects: Iterable[str] = DEFAULT_PROJECTS,
) -> None:
    """Recompute the roll-ups of ``dates`` from the landed table and replace their partitions.

    Only the folders of those dates are read. Each table is replaced by one write; if
    a refresh fails between the two, run it again: it depends on the landed table alone.
    """
    if not dates:
        return
    projects = tuple(projects)
    pv = read_landed_pageviews(spark, landed).where(F.col("date").isin(list(dates)))
    titles = only_projects(pv, projects).groupBy("date", "project", "title").agg(F.sum("views").alias("views"))
    _replace(titles.select("project", "title", "views", "date"), posixpath.join(path, "titles"))
    hours = clean_pages(pv, projects).groupBy("date", "hour", "project").agg(F.sum("views").alias("views"))
    bit = F.expr("shiftleft(1L, dayofmonth(date))")
    hours = hours.select("hour", "project", "views", month_text("date").alias("month"), bit.alias("days"), "date")
    _replace(hours, posixpath.join(path, "hours"))


def read_rolled_titles(spark: SparkSession, path: str) -> DataFrame:
    """``project, title, views, date``: page views by title and date, which the title reports take as they take page views."""
    return spark.read.schema(TITLES_SCHEMA).parquet(posixpath.join(path, "titles"))


def read_rolled_hours(spark: SparkSession, path: str) -> DataFrame:
    """``hour, project, views, month, days, date``: cleaned views by hour."""
    return spark.read.schema(HOURS_SCHEMA).parquet(posixpath.join(path, "hours"))
