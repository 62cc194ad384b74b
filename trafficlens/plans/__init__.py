"""User-facing reports: page traffic, coverage, run statistics, metric samples."""

from .coverage import coverage_gaps, coverage_summary, observed_hours
from .instant import extrapolated_rate, extrapolated_rate_sum, instant_at, instant_sum, instant_values
from .metrics import counter_rate, label_matches, latest, latest_sum, reduce_series, sum_by_label, sum_of_two
from .runs import run_families, run_ordinal, run_scaling, run_summary
from .traffic import (
    hourly_profile,
    merged_hours,
    profile_of_hours,
    requested_spellings,
    title_daily,
    titles_daily,
    top_pages,
    views_by_hour,
    views_by_title,
)

__all__ = [
    "counter_rate",
    "coverage_gaps",
    "coverage_summary",
    "extrapolated_rate",
    "extrapolated_rate_sum",
    "hourly_profile",
    "instant_at",
    "instant_sum",
    "instant_values",
    "label_matches",
    "latest",
    "latest_sum",
    "merged_hours",
    "observed_hours",
    "profile_of_hours",
    "reduce_series",
    "requested_spellings",
    "run_families",
    "run_ordinal",
    "run_scaling",
    "run_summary",
    "sum_by_label",
    "sum_of_two",
    "title_daily",
    "titles_daily",
    "top_pages",
    "views_by_hour",
    "views_by_title",
]
