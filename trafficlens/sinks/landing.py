"""Land parsed page views as Parquet, partitioned by date and hour.

One dump holds one hour, so one dump is one partition, and landing it again
replaces that partition (dynamic partition overwrite): nothing is lost and
nothing is counted twice, whichever hours a landing brings. Every scan task
already holds rows of few hours, so the write needs no shuffle. Rows are sorted
by title inside each task, which gives row groups tight min/max statistics on
``title``; a date or hour predicate prunes whole directories.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import PAGEVIEW_COLUMNS
from ..sources.pageviews import PAGEVIEW_SCHEMA
from .results import write_result


def land_pageviews(pv: DataFrame, path: str, balance: bool = False) -> int:
    """Write the typed page views under ``path/date=.../hour=.../``; returns rows written.

    Hours present in ``pv`` replace the same hours under ``path``; other hours
    stay. Land whole dumps: the rows of an hour must come in one call.

    ``balance`` adds a ``REBALANCE(date, hour)`` hint: one shuffle of the parsed
    rows, after which adaptive execution splits oversized partitions and merges
    small ones, so one huge dump (a single unsplittable gzip task) no longer
    makes one huge output file.
    """
    rows = pv.select(*PAGEVIEW_COLUMNS)
    if balance:
        rows = rows.hint("rebalance", "date", "hour")
    ordered = rows.sortWithinPartitions("date", "hour", "title")
    return write_result(
        ordered,
        path,
        fmt="parquet",
        mode="overwrite",
        partition_by=["date", "hour"],
        options={"partitionOverwriteMode": "dynamic"},
    )


def cluster_dates(
    spark: SparkSession, landed: str, path: str, dates: Sequence[dt.date] | None = None, titles_per_file: int = 1_000_000
) -> int:
    """Rewrite landed hours as ``path/date=.../``, clustered by title; returns rows written.

    The landed table has a file for each hour, and every one of them may hold a title.
    Here a date is cut into ranges of the title and sorted, so a title lookup reads
    the one or two row groups (and of those the pages) whose range holds it, and a
    month has tens of large files in place of hundreds of small ones; adaptive
    execution chooses their number by size. Bloom filters on ``title`` rule out
    titles that a range does not hold. Hour and project end the order, so even a title
    that fills a date is cut. ``dates`` (all when None) replace the same dates under ``path``.
    """
    pv = read_landed_pageviews(spark, landed)
    if dates is not None:
        pv = pv.where(F.col("date").isin(list(dates)))
    order = ["date", "title", "project", "hour"]
    ordered = pv.repartitionByRange(*order).sortWithinPartitions(*order)
    return write_result(
        ordered,
        path,
        fmt="parquet",
        mode="overwrite",
        partition_by=["date"],
        options={
            "partitionOverwriteMode": "dynamic",
            "parquet.bloom.filter.enabled#title": "true",
            "parquet.bloom.filter.expected.ndv#title": str(titles_per_file),
        },
    )


def read_landed_pageviews(spark: SparkSession, path: str) -> DataFrame:
    """The landed or clustered table with the page-view schema (``date``, and ``hour`` of the landed one, are partition columns)."""
    return spark.read.schema(PAGEVIEW_SCHEMA).parquet(path).select(*PAGEVIEW_COLUMNS)
