"""Percent-encoding of titles, on the driver (constants) and data-side (columns).

Dumps carry a title either raw (``Sagrada_Família``) or fully percent-encoded
with upper-case hex and no "safe" characters (``Sagrada_Fam%C3%ADlia``).

Spark's ``url_encode`` is HTML-form encoding (``java.net.URLEncoder``): it turns a
space into ``+``, keeps ``*`` and encodes ``~``. Strict percent-encoding does the
opposite on those three characters, so the column form repairs them. Any ``+``
in ``url_encode`` output stems from a space (a literal ``+`` becomes ``%2B``),
which makes the repair exact.
"""

from __future__ import annotations

import re
from urllib.parse import quote

from pyspark.sql import Column
from pyspark.sql import functions as F

_REGEX_SPECIAL = re.compile(r"([.^$*+?()\[\]{}|\\])")


def quote_title(value: str) -> str:
    """Strict percent-encoding of one title (UTF-8, upper-case hex, nothing safe)."""
    return quote(value, safe="")


def title_spellings(title: str) -> list[str]:
    """The spellings a dump may use for ``title``: raw and fully percent-encoded."""
    return sorted({title, quote_title(title)})


def regex_literal(value: str) -> str:
    """Escape regex metacharacters so ``value`` matches itself (Java and RE2 alike)."""
    return _REGEX_SPECIAL.sub(r"\\\1", value)


def percent_encode(col: Column | str) -> Column:
    """Data-side strict percent-encoding of a string column (JVM, codegen)."""
    c = F.col(col) if isinstance(col, str) else col
    form = F.url_encode(c)
    form = F.replace(form, F.lit("+"), F.lit("%20"))
    form = F.replace(form, F.lit("*"), F.lit("%2A"))
    return F.replace(form, F.lit("%7E"), F.lit("~"))


def title_variants(col: Column | str) -> Column:
    """Array of the distinct spellings of a title: raw and percent-encoded."""
    c = F.col(col) if isinstance(col, str) else col
    return F.array_distinct(F.array(c, percent_encode(c)))
