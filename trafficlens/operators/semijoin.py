"""A sieve of hashed keys: drop rows whose key cannot be in a list, before parsing and before any shuffle.

The list becomes a bitmap of BITS hashed bits, one row for each 64-bit word that
has a bit: at most WORDS rows of 16 bytes, whatever the list's length, so it may
be broadcast. A row passes when its key's bit is set. No listed key is ever
dropped; a few others pass (the list's length over BITS of them), so the exact
join still follows, over few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 1 << 21
BITS = 64 * WORDS


def _place(key: Column) -> tuple[Column, Column]:
    """Word and bit of a key."""
    bit = F.pmod(F.xxhash64(key), F.lit(BITS))
    return F.shiftright(bit, 6), bit.bitwiseAND(F.lit(63)).cast("int")


def sieve_words(listed: DataFrame, column: str) -> DataFrame:
    """The bitmap ``_word, _bits`` of a column's values; WORDS rows at most, from a partial aggregation."""
    word, bit = _place(F.col(column))
    marks = listed.select(word.alias("_word"), bit.alias("_bit"), F.lit(1).cast("bigint").alias("_one"))
    marks = marks.select("_word", F.expr("shiftleft(_one, _bit)").alias("_mark"))
    return marks.groupBy("_word").agg(F.bit_or("_mark").alias("_bits"))


def sieve(df: DataFrame, key: Column, listed: DataFrame, column: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be among the values of ``listed``'s ``column``."""
    word, bit = _place(key)
    marked = df.withColumn("_word", word).withColumn("_bit", bit)
    kept = marked.join(F.broadcast(sieve_words(listed, column)), "_word")
    return kept.where(F.expr("shiftrightunsigned(_bits, _bit) & 1L = 1L")).select(*df.columns)
