"""Page-traffic analytics on Spark: hourly page-view dumps, run statistics, metric samples.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark
expressions; none creates a session or holds a path.

    from trafficlens import read_pageviews, top_pages, title_daily, hourly_profile
"""

from .operators import add_platform, clean_pages, match_title, platform_views, unknown_titles
from .plans import (
    counter_rate,
    coverage_gaps,
    coverage_summary,
    hourly_profile,
    latest,
    latest_sum,
    observed_hours,
    run_ordinal,
    run_scaling,
    run_summary,
    sum_by_label,
    title_daily,
    titles_daily,
    top_pages,
)
from .sinks import RunContext, land_pageviews, read_landed_pageviews, write_result
from .sources import read_pageview_lines, read_pageviews, read_runs, read_titles

__version__ = "0.1.0"

__all__ = [
    "RunContext",
    "add_platform",
    "clean_pages",
    "counter_rate",
    "coverage_gaps",
    "coverage_summary",
    "hourly_profile",
    "land_pageviews",
    "latest",
    "latest_sum",
    "match_title",
    "observed_hours",
    "platform_views",
    "read_landed_pageviews",
    "read_pageview_lines",
    "read_pageviews",
    "read_runs",
    "read_titles",
    "run_ordinal",
    "run_scaling",
    "run_summary",
    "sum_by_label",
    "title_daily",
    "titles_daily",
    "top_pages",
    "unknown_titles",
    "write_result",
]
