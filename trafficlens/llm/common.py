"""Helpers shared by the operators: reading tables, shared scratch tables, sizes."""

from __future__ import annotations

import ctypes
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.session import shared_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """``df`` written once as Parquet in the session's shared folder and read back.

    Cuts the lineage in a place every executor can read, so a lost executor costs
    no recomputation of what came before.
    """
    spark = df.sparkSession
    path = shared_path(spark, "llm", name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


ROWS_AT_ONCE = 256


def row_slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Arrow batches in slices of ``rows``; when they end, the worker's free memory goes back to the system.

    Python workers are reused, so what one stage freed would otherwise still
    count against the next one.
    """
    try:
        for batch in batches:
            for first in range(0, batch.num_rows, rows):
                yield batch.slice(first, rows)
    finally:
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def fold(value: Column, modulus: int) -> Column:
    """crc32 of a value's text, modulo ``modulus`` (the fold rule of the contracts)."""
    return F.crc32(value.cast("string").cast("binary")) % F.lit(modulus)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


SIEVE_WORDS = 1 << 21  # largest sieve: 64-bit words, 16 bytes a row


def sieve(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose bigint ``column`` may be among the bigints of ``ids``' only column.

    A bitmap of hashed ids, one row per word and SIEVE_WORDS rows at most, is
    broadcast. It keeps every id and few others, so a join that follows shuffles
    little; with more ids than it can tell apart it keeps more rows and the join
    still decides.
    """
    words = 1 << min(max(10, ids.count().bit_length()), SIEVE_WORDS.bit_length() - 1)

    def place(value: Column) -> tuple[Column, Column]:
        h = F.xxhash64(value)
        return F.pmod(h, F.lit(words)), F.shiftright(h, 40).bitwiseAND(F.lit(63)).cast("int")

    word, bit = place(F.col(ids.columns[0]))
    bits = ids.select(word.alias("__word"), F.expr("1L").alias("one"), bit.alias("bit"))
    bits = bits.select("__word", F.expr("shiftleft(one, bit)").alias("mark"))
    bitmap = bits.groupBy("__word").agg(F.bit_or("mark").alias("__bits"))
    word, bit = place(F.col(column))
    kept = df.withColumn("__word", word).withColumn("__bit", bit).join(F.broadcast(bitmap), "__word")
    return kept.where(F.expr("shiftrightunsigned(__bits, __bit) & 1L = 1L")).select(*df.columns)


def pieces(rows: int, per_piece: int) -> int:
    """How many pieces of about ``per_piece`` rows, at least one."""
    return max(1, math.ceil(rows / per_piece))
