"""Title patterns built from the fixed lists."""

from __future__ import annotations

from functools import lru_cache

from .constants import HOME_PAGES, NAMESPACE_PREFIXES, NAMESPACE_SEPARATOR, TALK_PREFIX
from .encoding import regex_literal, title_spellings


@lru_cache(maxsize=None)
def namespace_regex() -> str:
    """Anchored pattern for titles that live in a namespace.

    A title is a namespace page when it starts with one of the prefixes (raw or
    percent-encoded) directly followed by the separator, or with the talk prefix
    followed by any run of characters other than ``:`` and ``%`` and then the
    separator. The second rule deliberately stops at ``%``: an encoded talk page
    such as ``Discussion_Wikip%C3%A9dia:X`` is *not* matched, as in the original
    cleaning rules.
    """
    prefixes = "|".join(regex_literal(s) for p in NAMESPACE_PREFIXES for s in title_spellings(p))
    # The text of the next pattern is fixed by the cleaning rules.
    talk = regex_literal(TALK_PREFIX) + "[^:%]*" + NAMESPACE_SEPARATOR
    named = "(?:" + prefixes + ")" + NAMESPACE_SEPARATOR
    return "^(?:" + talk + "|" + named + ")"


@lru_cache(maxsize=None)
def home_page_titles() -> tuple[str, ...]:
    """Home and search page titles with their encoded forms."""
    return tuple(spelling for page in HOME_PAGES for spelling in title_spellings(page))


def anchored(pattern: str) -> str:
    """Full-match form of a label pattern (label matchers are fully anchored)."""
    return "^(?:" + pattern + ")$"
