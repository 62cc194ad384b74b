"""Sinks: result files with observed counts, Parquet landing, run manifest and context."""

from ..functions.csvformat import CSV_OPTIONS
from .landing import cluster_dates, land_pageviews, read_landed_pageviews
from .manifest import RunContext, RunRecord, append_run, compact_runs, write_meta
from .results import claim_folder, name_single_part, observe_rows, path_exists, read_result_csv, write_result
from .rollups import dates_of, read_rolled_hours, read_rolled_titles, refresh_rollups

__all__ = [
    "CSV_OPTIONS",
    "RunContext",
    "RunRecord",
    "append_run",
    "claim_folder",
    "cluster_dates",
    "compact_runs",
    "dates_of",
    "land_pageviews",
    "name_single_part",
    "observe_rows",
    "path_exists",
    "read_landed_pageviews",
    "read_result_csv",
    "read_rolled_hours",
    "read_rolled_titles",
    "refresh_rollups",
    "write_meta",
    "write_result",
]
