"""Column expressions and fixed values."""

from .constants import (
    DEFAULT_PROJECTS,
    FILENAME_PATTERN,
    HOME_PAGES,
    MOBILE_PROJECTS,
    NAMESPACE_PREFIXES,
    PAGEVIEW_COLUMNS,
    RUNS_COLUMNS,
)
from .encoding import percent_encode, quote_title, title_spellings, title_variants
from .patterns import anchored, home_page_titles, namespace_regex
from .ratios import pct, share_of_total

__all__ = [
    "DEFAULT_PROJECTS",
    "FILENAME_PATTERN",
    "HOME_PAGES",
    "MOBILE_PROJECTS",
    "NAMESPACE_PREFIXES",
    "PAGEVIEW_COLUMNS",
    "RUNS_COLUMNS",
    "anchored",
    "home_page_titles",
    "namespace_regex",
    "pct",
    "percent_encode",
    "quote_title",
    "share_of_total",
    "title_variants",
    "title_spellings",
]
