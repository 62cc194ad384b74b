"""The page-traffic reports: top pages, daily views of titles, hour-of-day profile.

Each report is one Spark job over the input. Totals that the shares need are
computed with a keyless window over the already-small result (top N rows, or 24
hours), so the input is never read twice.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import DEFAULT_PROJECTS, MOBILE_PROJECTS
from ..functions.ratios import pct, share_of_total
from ..operators.filters import clean_pages, expand_title_variants, match_title, only_projects
from ..operators.platform import add_platform, platform_views
from ..operators.semijoin import sieve

TOP_PAGES_COLUMNS = ("rank", "title", "views", "views_desktop", "views_mobile", "share_pct")
DAILY_COLUMNS = ("date", "views", "views_desktop", "views_mobile")
HOURLY_COLUMNS = (
    "hour",
    "views_total",
    "views_avg_day",
    "views_desktop",
    "views_mobile",
    "mobile_share_pct",
    "share_pct",
)


def views_by_title(
    pv: DataFrame,
    projects: Iterable[str] = DEFAULT_PROJECTS,
    mobile_projects: Iterable[str] = MOBILE_PROJECTS,
) -> DataFrame:
    """Cleaned article views per raw title (encoded spellings stay separate)."""
    return platform_views(add_platform(clean_pages(pv, projects), mobile_projects), "title")


def top_pages(
    pv: DataFrame,
    n: int = 100,
    projects: Iterable[str] = DEFAULT_PROJECTS,
    mobile_projects: Iterable[str] = MOBILE_PROJECTS,
) -> DataFrame:
    """The ``n`` most viewed articles with rank, platform split and share of the top-``n`` total.

    Plan: partial + final hash aggregate on ``title`` -> ``TakeOrderedAndProject``
    (per-partition top ``n``, then one merge of ``n`` x partitions rows) -> rank and
    share over those ``n`` rows in one task. Ties: views desc, then title asc;
    ranks are unique. ``n`` is a report size (hundreds to thousands of rows): the
    final merge and the rank window hold ``n`` rows in one task. A full ranking
    of every title is ``global_row_number(views_by_title(pv), [-F.col("views"), "title"])``,
    which stays distributed.
    """
    order = [F.desc("views"), F.asc("title")]
    top = views_by_title(pv, projects, mobile_projects).orderBy(*order).limit(n)
    return top.select(
        F.row_number().over(Window.orderBy(*order)).alias("rank"),
        "title",
        "views",
        "views_desktop",
        "views_mobile",
        share_of_total("views", 3).alias("share_pct"),
    ).orderBy("rank")


def title_daily(
    pv: DataFrame,
    title: str,
    projects: Iterable[str] = DEFAULT_PROJECTS,
    mobile_projects: Iterable[str] = MOBILE_PROJECTS,
) -> DataFrame:
    """Daily views of one title, raw and percent-encoded spellings merged.

    Namespace cleaning is not applied (the title is explicit). Only days with hits
    appear. The title predicate is an ``IN`` of two literals, pushed to Parquet.
    """
    hits = add_platform(match_title(only_projects(pv, projects), title), mobile_projects)
    return platform_views(hits, "date").select(*DAILY_COLUMNS).orderBy("date")


def requested_spellings(titles: DataFrame, title_col: str = "title") -> DataFrame:
    """``title, variant``: each requested title once with each of its spellings."""
    return expand_title_variants(titles.select(title_col).distinct(), title_col)


def titles_daily(
    pv: DataFrame,
    titles: DataFrame,
    title_col: str = "title",
    projects: Iterable[str] = DEFAULT_PROJECTS,
    mobile_projects: Iterable[str] = MOBILE_PROJECTS,
) -> DataFrame:
    """Daily views of many titles in one scan: ``title, date, views, views_desktop, views_mobile``.

    ``title`` is the requested spelling; its raw and encoded spellings are merged.
    One plan whatever the list's size: a bitmap of the hashed spellings (of bounded
    size, broadcast) lets only rows of requested titles pass, those are aggregated by
    (title, date, platform), which absorbs hot titles, and what is left meets the list
    in an exact join. Nothing of the other titles is shuffled. For dumps,
    ``read_pageviews(..., title_list=requested_spellings(titles))`` sieves the lines
    before they are parsed.
    """
    variants = requested_spellings(titles, title_col)
    pages = add_platform(only_projects(pv, projects), mobile_projects).select(
        F.col("title").alias("variant"), "date", "platform", "views"
    )
    pages = sieve(pages, F.col("variant"), variants, "variant")
    daily = pages.groupBy("variant", "date", "platform").agg(F.sum("views").alias("views"))
    hits = daily.join(variants, "variant")
    return platform_views(hits, "title", "date").select("title", *DAILY_COLUMNS)


def views_by_hour(
    pv: DataFrame,
    projects: Iterable[str] = DEFAULT_PROJECTS,
    mobile_projects: Iterable[str] = MOBILE_PROJECTS,
) -> DataFrame:
    """Cleaned views per hour of day with the platform split and ``n_days`` (distinct dates)."""
    pages = add_platform(clean_pages(pv, projects), mobile_projects)
    return platform_views(
        pages, "hour", total="views_total", extra=[F.count_distinct("date").alias("n_days")]
    )


def merged_hours(
    hours: DataFrame,
    projects: Iterable[str] = DEFAULT_PROJECTS,
    mobile_projects: Iterable[str] = MOBILE_PROJECTS,
) -> DataFrame:
    """The rows of :func:`views_by_hour`, merged from the hourly roll-up (:mod:`trafficlens.sinks.rollups`).

    Distinct days are counted from the merged bitmaps of each month; no distinct is taken.
    """
    pages = add_platform(only_projects(hours, projects), mobile_projects)
    by_month = platform_views(pages, "hour", "month", total="views_total", extra=[F.bit_or("days").alias("days")])
    return by_month.groupBy("hour").agg(
        F.sum("views_total").alias("views_total"),
        F.sum(F.bit_count("days")).alias("n_days"),
        F.sum("views_desktop").alias("views_desktop"),
        F.sum("views_mobile").alias("views_mobile"),
    )


def hourly_profile(
    pv: DataFrame,
    projects: Iterable[str] = DEFAULT_PROJECTS,
    mobile_projects: Iterable[str] = MOBILE_PROJECTS,
) -> DataFrame:
    """Hour-of-day traffic profile (UTC).

    ``views_avg_day`` divides by the number of distinct dates seen *in that hour*;
    ``share_pct`` is the hour's share of all cleaned views. The distinct count is
    planned as two partial aggregations, on (hour, date) then hour, so at most
    24 x days groups ever cross the network.
    """
    return profile_of_hours(views_by_hour(pv, projects, mobile_projects))


def profile_of_hours(by_hour: DataFrame) -> DataFrame:
    """The hour-of-day profile from the rows of :func:`views_by_hour` or :func:`merged_hours`."""
    return by_hour.select(
        "hour",
        "views_total",
        F.round(F.col("views_total") / F.greatest(F.col("n_days"), F.lit(1))).alias("views_avg_day"),
        "views_desktop",
        "views_mobile",
        pct(F.col("views_mobile"), F.col("views_total"), 2).alias("mobile_share_pct"),
        share_of_total("views_total", 3).alias("share_pct"),
    ).orderBy("hour")
