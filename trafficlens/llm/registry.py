"""The queries of this subpackage, and the SQL of those that DuckDB can run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import op2_bpe
from .classlm import op4_classlm
from .decontamination import op10_decontamination
from .filteraudit import OP12_SQL, op12_filteraudit
from .fingerprints import op7_fingerprints
from .licenses import OP8_SQL, op8_licenses
from .neardup import op9_neardup
from .quality import op1_quality
from .sharding import op6_sharding
from .toxicity import op5_toxicity
from .urlfilter import op13_urlfilter
from .vectorcodes import OP11_SQL, op11_vectorcodes
from .warc import OP3_SQL, op3_warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": op1_quality,
        "op2_bpe": op2_bpe,
        "op3_warc": op3_warc,
        "op4_classlm": op4_classlm,
        "op5_toxicity": op5_toxicity,
        "op6_sharding": op6_sharding,
        "op7_fingerprints": op7_fingerprints,
        "op8_licenses": op8_licenses,
        "op9_neardup": op9_neardup,
        "op10_decontamination": op10_decontamination,
        "op11_vectorcodes": op11_vectorcodes,
        "op12_filteraudit": op12_filteraudit,
        "op13_urlfilter": op13_urlfilter,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_warc": OP3_SQL,
        "op8_licenses": OP8_SQL,
        "op11_vectorcodes": OP11_SQL,
        "op12_filteraudit": OP12_SQL,
    }
