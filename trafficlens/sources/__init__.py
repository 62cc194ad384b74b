"""Scans: page-view dumps, title lists, run manifests, calendars."""

from .health import dump_states, intact_dumps
from .pageviews import (
    PAGEVIEW_SCHEMA,
    file_hours,
    dump_count,
    dump_hours,
    hours_pattern,
    list_dumps,
    project_prefix_filter,
    title_substring_filter,
    input_file_count,
    line_status,
    malformed_counts,
    pageview_glob,
    parse_pageview_lines,
    read_pageview_lines,
    read_pageviews,
)
from .tables import (
    RUNS_SCHEMA,
    calendar_spanning,
    clean_titles,
    hour_timestamp,
    hourly_calendar,
    job_family,
    read_committed_runs,
    read_runs,
    read_titles,
    with_day_hour,
    with_family,
)

__all__ = [
    "PAGEVIEW_SCHEMA",
    "RUNS_SCHEMA",
    "calendar_spanning",
    "clean_titles",
    "file_hours",
    "dump_count",
    "dump_hours",
    "dump_states",
    "hours_pattern",
    "intact_dumps",
    "list_dumps",
    "project_prefix_filter",
    "title_substring_filter",
    "hour_timestamp",
    "hourly_calendar",
    "input_file_count",
    "job_family",
    "line_status",
    "malformed_counts",
    "pageview_glob",
    "parse_pageview_lines",
    "read_pageview_lines",
    "read_pageviews",
    "read_committed_runs",
    "read_runs",
    "read_titles",
    "with_day_hour",
    "with_family",
]
