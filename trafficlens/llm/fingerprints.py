"""Homomorphic multiset fingerprints of documents.

Every paragraph is hashed to a wide vector of signed 16-bit values; a document's
fingerprint is the sum of its paragraphs' vectors modulo 2**32. The sum does
not depend on the order of paragraphs, and a paragraph is inserted or deleted by
adding or subtracting its vector. Because the values are centred on zero, the
cosine of two sums estimates how many paragraphs two documents share (error
about 1 / sqrt(lanes)). Everything is a DataFrame expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, text_or_empty

HASHES = 16  # 64-bit hashes of a paragraph, four lanes each
LANES = 4 * HASHES
MODULUS = 1 << 32
HALF = 1 << 31
#: Paragraphs end at a line break, or where a sentence ends before white space.
PARAGRAPH_END = r"\n+|(?<=[.!?])\s+"

SEGMENTS = 64  # approximate quantiles of doc_id that steer the runs
ROWS_PER_RUN = 2_000
BLOCK = 4_096  # runs of a segment that one task puts in order


def paragraphs(text: Column) -> Column:
    """Non-blank paragraphs of a text."""
    return F.filter(F.split(text, PARAGRAPH_END), lambda p: F.trim(p) != "")


def paragraph_vector(paragraph: Column) -> Column:
    """Signed 16-bit lanes hashed from one paragraph."""
    hashes = F.array(*[F.xxhash64(F.lit(seed), paragraph) for seed in range(HASHES)])
    low = F.lit(0xFFFF)
    return F.flatten(
        F.transform(
            hashes,
            lambda h: F.array(
                *[F.shiftrightunsigned(h, 16 * k).bitwiseAND(low) - F.lit(1 << 15) for k in range(4)]
            ),
        )
    )


def fingerprint_lanes(text: Column) -> Column:
    """The fingerprint as an array of ``LANES`` values in [0, 2**32)."""
    zero = F.array_repeat(F.lit(0).cast("bigint"), LANES)
    return F.aggregate(paragraphs(text), zero, lambda acc, p: insert(acc, paragraph_vector(p)))


def insert(lanes: Column, other: Column) -> Column:
    """Fingerprint of the union of two multisets of paragraphs."""
    return F.zip_with(lanes, other, lambda a, b: F.pmod(a + b, F.lit(MODULUS)))


def delete(lanes: Column, other: Column) -> Column:
    """Fingerprint after taking out the paragraphs of ``other``."""
    return F.zip_with(lanes, other, lambda a, b: F.pmod(a - b, F.lit(MODULUS)))


def as_string(lanes: Column) -> Column:
    """Lanes as fixed-width lowercase hex."""
    return F.lower(F.array_join(F.transform(lanes, lambda v: F.lpad(F.hex(v), 8, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Cosine of two fingerprints, 0 when negative; 1 exactly when they are equal."""

    def centred(v: Column) -> Column:
        return F.when(v >= HALF, v - MODULUS).otherwise(v).cast("double")

    def total(lanes: Column) -> Column:
        return F.aggregate(lanes, F.lit(0.0), lambda acc, v: acc + v)

    dot = total(F.zip_with(a, b, lambda x, y: centred(x) * centred(y)))
    norms = F.sqrt(total(F.transform(a, lambda x: centred(x) * centred(x)))) * F.sqrt(
        total(F.transform(b, lambda x: centred(x) * centred(x)))
    )
    cosine = F.when(norms > 0, dot / norms).otherwise(F.lit(0.0))
    return F.when(a == b, F.lit(1.0)).otherwise(F.least(F.greatest(cosine, F.lit(0.0)), F.lit(1.0)))


def _runs(docs: DataFrame) -> tuple[Column, Column]:
    """Two columns that cut doc_id order into runs of about ROWS_PER_RUN rows, both rising with doc_id.

    Approximate quantiles (a fixed number, whatever the table) adapt the run
    width to the spread of the ids; a null doc_id comes below all others.
    """
    steps = [k / SEGMENTS for k in range(SEGMENTS + 1)]
    seen = docs.agg(
        F.count("doc_id").alias("rows"), F.percentile_approx("doc_id", steps, 10_000).alias("at")
    ).first()
    at = sorted(set(seen["at"] or [0]))
    per_segment = max(1, seen["rows"] // max(1, len(at) - 1) // ROWS_PER_RUN)
    widths = [max(1, (b - a) // per_segment) for a, b in zip(at, at[1:])] + [max(1, at[-1] - at[0] + 1)]
    lows = F.array(*[F.lit(int(v)).cast("bigint") for v in at])
    wide = F.array(*[F.lit(int(v)).cast("bigint") for v in widths])
    passed = F.greatest(F.size(F.filter(lows, lambda low: low <= F.col("doc_id"))), F.lit(1))
    segment = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(passed)
    place = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(
        F.floor((F.col("doc_id") - F.element_at(lows, passed)) / F.element_at(wide, passed))
    )
    return segment, place.cast("bigint")


def _below(runs: DataFrame) -> DataFrame:
    """(segment, place, below): of each run the next one by falling (segment, place); after the last comes the first.

    Inside a segment runs are grouped in blocks of at most BLOCK places; a run's next is
    found in its block, else in the segment's next block, else in the next segment.
    So a task orders BLOCK runs, or the blocks of one segment, or the segments, whose
    number is fixed.
    """
    here = F.struct("segment", "place")
    rows = runs.withColumn("block", F.floor(F.col("place") / BLOCK))
    inside = Window.partitionBy("segment", "block").orderBy(F.desc("place"))
    blocks = rows.groupBy("segment", "block").agg(F.max("place").alias("place"))
    across = Window.partitionBy("segment").orderBy(F.desc("block"))
    next_block = blocks.select("segment", "block", F.lead(here).over(across).alias("next_block"))
    segments = blocks.groupBy("segment").agg(F.max("place").alias("place"))
    down = Window.orderBy(F.desc("segment"))
    top = F.first(here).over(down.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    next_segment = segments.select("segment", F.coalesce(F.lead(here).over(down), top).alias("next_segment"))
    return (
        rows.withColumn("next_run", F.lead(here).over(inside))
        .join(next_block, ["segment", "block"])
        .join(F.broadcast(next_segment), "segment")  # SEGMENTS + 1 rows at most
        .select("segment", "place", F.coalesce("next_run", "next_block", "next_segment").alias("below"))
    )


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, own, next_text, next_own): the text and fingerprint of each row and of the next by descending doc_id.

    The last row's next is the first. One shuffle of the texts, by run; a fingerprint
    is taken before it and led with the text, not taken again. Only the first row of
    each run travels to the run before it. Rows with one doc_id follow each other by
    the hash of their text.
    """
    segment, place = _runs(docs)
    frame = docs.select("doc_id", text_or_empty().alias("text"), segment.alias("segment"), place.alias("place"))
    order = [F.desc_nulls_last("doc_id"), F.desc(F.xxhash64("text"))]
    run = Window.partitionBy("segment", "place").orderBy(*order)
    heads = frame.withColumn("n", F.row_number().over(run)).where("n = 1").select(
        F.col("segment").alias("head_segment"), F.col("place").alias("head_place"), F.col("text").alias("head_text")
    )
    below = _below(frame.groupBy("segment", "place").agg(F.count(F.lit(1)).alias("rows")).select("segment", "place"))
    first_below = below.join(
        heads, (F.col("below.segment") == F.col("head_segment")) & (F.col("below.place") == F.col("head_place"))
    ).select("segment", "place", "head_text", fingerprint_lanes(F.col("head_text")).alias("head_own"))
    taken = frame.withColumn("own", fingerprint_lanes(F.col("text")))
    return (
        taken.withColumn("following", F.lead("text").over(run))
        .withColumn("following_own", F.lead("own").over(run))
        .join(first_below, ["segment", "place"])
        .select(
            "doc_id",
            "text",
            "own",
            F.coalesce("following", "head_text").alias("next_text"),
            F.coalesce("following_own", "head_own").alias("next_own"),
        )
    )


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A null
    text counts as empty; a text without paragraphs has the zero fingerprint.
    The edited text keeps the first half and takes the second from the start of
    the next document by descending doc_id. A single row is its own next.
    Repeated rows are fingerprinted separately. An empty table gives no rows.
    """
    pairs = with_next(docs)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    frame = pairs.select("doc_id", n.cast("bigint").alias("n_chars"), edited.alias("edited"), "own", "next_own")
    frame = frame.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "own",
        fingerprint_lanes(F.col("edited")).alias("changed"),
        "next_own",
    )
    return frame.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_string(F.col("own")).alias("fingerprint"),
        as_string(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))
