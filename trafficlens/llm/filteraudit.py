"""Filter interaction audit: wide packed counters over the fail masks of all documents.

Five filters give every document a mask of the filters it fails. What such a
document does in each of the 600 (order, step) places - is kept, is removed
there, is redundant there - depends on its mask alone, so every mask has one big
integer: 600 fields of FIELD_BITS bits for each outcome, and one for each filter
that alone would remove it. The integers of a part's documents are added; a field
is wide enough for any number of rows, so no sum carries into its neighbour and
all counts of all orders are read off the total at the end.

Equal masks are counted before they are added (a mask's integer times its count),
and everything is partially aggregated before it is shuffled: a text that a third
of all documents share, or a part that holds most of them, is a few rows a task.
Only a 128-bit digest of a text travels, never the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import row_slices, table, text_or_empty

FILTERS = "ABCDE"
FEW_WORDS = 100
DISTINCT_PERCENT = 80
UPPER_PERCENT = 10
SYMBOLS = "#$%&*|"
FIELD_BITS = 64
ORDERS = tuple("".join(p) for p in permutations(FILTERS))
PLACES = len(ORDERS) * len(FILTERS)
OUTCOMES = ("kept", "removed", "redundant")

_SYMBOL = re.compile(f"[{re.escape(SYMBOLS)}]")
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def own_mask(text: str) -> int:
    """Filters A to D that a whole text fails, as bits 0 to 3."""
    data = text.encode("utf-8")
    words = data.split()  # bytes split at \\x20 and \\x09 to \\x0D only
    upper = len(data) - len(data.translate(None, _UPPER))
    return (
        (len(words) < FEW_WORDS)
        | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
        | (100 * upper > UPPER_PERCENT * len(text)) << 2
        | (_SYMBOL.search(text) is not None) << 3
    )


@cache
def wide_counters() -> tuple[int, ...]:
    """The big integer of each mask: field outcome * PLACES + order * 5 + step, then one field a filter for unique fails."""
    bit = {name: 1 << k for k, name in enumerate(FILTERS)}
    found = []
    for mask in range(1 << len(FILTERS)):
        fields = [0] * (len(OUTCOMES) * PLACES + len(FILTERS))
        for number, order in enumerate(ORDERS):
            gone = False
            for step, name in enumerate(order):
                place = number * len(FILTERS) + step
                fails = bool(mask & bit[name])
                fields[place] = not (gone or fails)
                fields[PLACES + place] = fails and not gone
                fields[2 * PLACES + place] = fails and gone
                gone = gone or fails
        for k in range(len(FILTERS)):
            fields[len(OUTCOMES) * PLACES + k] = mask == 1 << k
        found.append(int.from_bytes(np.array(fields, "<u8").tobytes(), "little"))
    return tuple(found)


def unpacked(total: int) -> np.ndarray:
    """The fields of a sum of wide counters."""
    size = (len(OUTCOMES) * PLACES + len(FILTERS)) * FIELD_BITS // 8
    return np.frombuffer(total.to_bytes(size, "little"), "<u8").astype(np.int64)


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, digest): filters A to D of every whole text, and 128 bits of its hash."""
    slim = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text_or_empty().alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches):
            texts = batch.column(2).to_pylist()
            digests = [hashlib.blake2b(text.encode("utf-8"), digest_size=16).digest() for text in texts]
            columns = [pa.array([own_mask(text) for text in texts], pa.int32()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], ["doc_id", "part", "mask", "digest"])

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(measure, f"doc_id {kind}, part string, mask int, digest binary")


def mask_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): documents by all five filters and labels.

    Filter E needs the smallest doc_id of each text. Rows are first counted by
    (text, part, labels, doc_id), then by text, part and labels with the smallest
    doc_id and its count, so a very common text is never gathered in one task.
    """
    flags = (
        labels.groupBy("doc_id")
        .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
        .where("doc_id is not null")
    )
    own = [F.coalesce(name, F.lit(False)).alias(name) for name in ("good", "toxic")]
    known = rows.join(flags, "doc_id", "left").select("doc_id", "part", "mask", "digest", *own)
    group = ["digest", "mask", "part", "good", "toxic"]
    by_id = known.groupBy(*group, "doc_id").agg(F.count(F.lit(1)).alias("n"))
    by_text = by_id.groupBy(*group).agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("first"),
        F.min_by("n", "doc_id").alias("first_n"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
    )
    earliest = by_text.withColumn("least", F.min("first").over(Window.partitionBy("digest")))
    passing = F.col("nameless") + F.when(F.col("first") == F.col("least"), F.col("first_n")).otherwise(0)
    both = F.array(
        F.struct(F.col("mask").alias("mask"), passing.alias("n")),
        F.struct((F.col("mask") + (1 << FILTERS.index("E"))).alias("mask"), (F.col("n") - passing).alias("n")),
    )
    split = earliest.select("part", "good", "toxic", F.inline(both))
    return split.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).where("n > 0")


def audit_rows(counts: pd.DataFrame) -> pd.DataFrame:
    """The 600 rows of one part from its counts by mask and labels (128 rows at most)."""
    table_ = wide_counters()
    total = good = toxic = 0
    for mask, is_good, is_toxic, n in zip(counts["mask"], counts["good"], counts["toxic"], counts["n"]):
        packed = int(n) * table_[mask]
        total += packed
        good += packed if is_good else 0
        toxic += packed if is_toxic else 0
    # No field of the sum exceeds the number of rows, so none carries into the next.
    assert int(counts["n"].sum()) < 1 << (FIELD_BITS - 1)
    fields = unpacked(total)
    kept, removed, redundant = fields[: len(OUTCOMES) * PLACES].reshape(len(OUTCOMES), PLACES)
    place = slice(PLACES, 2 * PLACES)
    at = np.array([FILTERS.index(name) for order in ORDERS for name in order])
    shapley = np.array([removed[at == k].sum() for k in range(len(FILTERS))], np.int64)
    return pd.DataFrame(
        {
            "part": counts["part"].iloc[0],
            "filter_order": np.repeat(ORDERS, len(FILTERS)),
            "step": np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS)),
            "kept": kept,
            "removed": removed,
            "redundant": redundant,
            "unique_fails": fields[len(OUTCOMES) * PLACES :][at],
            "good_lost": unpacked(good)[place],
            "toxic_lost": unpacked(toxic)[place],
            "shapley": shapley[at],
        }
    )


AUDIT_SCHEMA = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
    "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
)


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each filter does at each step of all 120 orders, by part: 600 rows a part.

    ``docs`` needs doc_id, text and lang, ``labels`` doc_id, quality and toxic; other
    columns are ignored. A null lang is the part of the empty string, a null text is
    empty and so equal to other empty texts. A document is good (toxic) when some
    label row of its doc_id says so, and counts once. Rows that repeat a doc_id are
    each counted, and don't make each other copies; a null doc_id is smaller than
    none and larger than none. An empty table has no parts and gives no rows.
    """
    counts = mask_counts(measured(docs), labels)
    return counts.groupBy("part").applyInPandas(audit_rows, AUDIT_SCHEMA)


def op12_filteraudit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# ---------------------------------------------------------------------- SQL --

_MASK_SQL = """
d as (select doc_id, coalesce(text, '') as t, coalesce(lang, '') as part from documents),
w as (select *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') as words from d),
flags as (select doc_id, max(coalesce(cast(quality = 1 as int), 0)) as good, max(coalesce(cast(toxic = 1 as int), 0)) as toxic
          from labels group by doc_id),
m as materialized (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
         cast(len(words) < 100 as int)
         + 2 * cast(100 * len(list_distinct(words)) < 80 * len(words) as int)
         + 4 * cast(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) as int)
         + 8 * cast(regexp_matches(t, '[#$%&*|]') as int)
         + 16 * cast(coalesce(w.doc_id > min(w.doc_id) over (partition by t), false) as int) as fails
  from w left join flags on flags.doc_id = w.doc_id),
c as materialized (select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from m group by all),
f(name, bit) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o as (select a.name || b.name || c.name || d.name || e.name as filter_order,
             [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
      from f a, f b, f c, f d, f e
      where a.bit + b.bit + c.bit + d.bit + e.bit = 31 and a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s as (select filter_order, cast(step as int) as step, bits[step] as bit, coalesce(list_sum(bits[1:step - 1]), 0) as earlier
      from o, range(1, 6) r(step)),
x as materialized (
  select part, filter_order, step, bit,
         coalesce(sum(n) filter (fails & (earlier | bit) = 0), 0) as kept,
         coalesce(sum(n) filter (fails & bit <> 0 and fails & earlier = 0), 0) as removed,
         coalesce(sum(n) filter (fails & bit <> 0 and fails & earlier <> 0), 0) as redundant,
         coalesce(sum(n) filter (fails = bit), 0) as unique_fails,
         coalesce(sum(good) filter (fails & bit <> 0 and fails & earlier = 0), 0) as good_lost,
         coalesce(sum(toxic) filter (fails & bit <> 0 and fails & earlier = 0), 0) as toxic_lost
  from (select part, fails, n, good, toxic, filter_order, step, bit, cast(earlier as int) as earlier from c cross join s)
  group by all)
"""

OP12_SQL = (
    f"with {_MASK_SQL} select part, filter_order, step, "
    + ", ".join(f"cast({name} as bigint) as {name}" for name in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))
    + ", cast(sum(removed) over (partition by part, bit) as bigint) as shapley from x"
)
