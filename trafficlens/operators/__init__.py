"""Reusable row, aggregate and window operators."""

from .asof import asof_join
from .filters import (
    check_titles,
    clean_pages,
    drop_empty_titles,
    drop_home_pages,
    drop_namespaces,
    expand_title_variants,
    match_title,
    only_projects,
    unknown_titles,
)
from .platform import add_platform, platform_views
from .quantiles import group_median
from .ranking import global_row_number, run_number
from .series import previous_value, running_total
from .semijoin import sieve

__all__ = [
    "add_platform",
    "asof_join",
    "check_titles",
    "clean_pages",
    "drop_empty_titles",
    "drop_home_pages",
    "drop_namespaces",
    "expand_title_variants",
    "global_row_number",
    "group_median",
    "match_title",
    "only_projects",
    "platform_views",
    "previous_value",
    "run_number",
    "running_total",
    "sieve",
    "unknown_titles",
]
