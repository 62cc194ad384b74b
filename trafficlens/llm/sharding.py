"""Minimax contiguous sharding: the smallest capacity that fits ordered atomic groups into N shards.

Rows with equal texts form one atomic group; groups are ordered by the 64-bit
hash of their text. The capacity is binary-searched over the ordered sizes with
a greedy check. The driver never sees one row per group: it sees a histogram
over hash ranges of bounded length, finds the ranges in which a cut could still
fall, and asks for a finer histogram of those ranges only, until every such
range holds a single group. Then the cuts are exact and are literals of the
final projection: no join assigns rows to shards.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pieces, text_or_empty, written

FIRST_BITS = 12  # the first histogram has at most 4,096 ranges
MORE_BITS = 6  # every refined range becomes at most 64 ranges
ROWS_PER_RUN = 50_000  # rows numbered together when slots are given


@dataclass(frozen=True)
class Range:
    """A hash range [start, start + 2**width): bytes, number of groups, largest group."""

    start: int
    width: int
    size: int
    groups: int
    largest: int

    @property
    def atomic(self) -> bool:
        return self.groups == 1 or self.width == 0


def greedy(ranges: list[Range], capacity: int, shards: int, split: bool) -> list[float] | None:
    """Positions (range index plus used share) of the cuts, or None when more shards are needed.

    ``split`` fills shards to the brim by dividing ranges of several groups, a
    lower bound for any real cut; otherwise every range is atomic, an upper bound.
    """
    cuts: list[float] = []
    room = capacity
    for k, r in enumerate(ranges):
        divisible = split and not r.atomic
        if (r.largest if divisible else r.size) > capacity:
            return None
        left = r.size
        while left > room:
            used = room if divisible else 0
            left -= used
            cuts.append(k + (r.size - left) / r.size)
            if len(cuts) >= shards:
                return None
            room = capacity
        room -= left
    return cuts


def smallest(ranges: list[Range], shards: int, split: bool) -> int:
    """The smallest capacity for which the greedy check succeeds."""
    low, high = 0, sum(r.size for r in ranges)
    while high - low > 1:
        middle = (low + high) // 2
        if greedy(ranges, middle, shards, split) is None:
            low = middle
        else:
            high = middle
    return high


def early_cuts(ranges: list[Range], capacity: int, shards: int) -> list[int]:
    """Range index at or before which each real greedy cut at ``capacity`` falls at the earliest."""
    cuts: list[int] = []
    room = capacity
    for k, r in enumerate(ranges):
        if r.size > room:
            cuts.append(k)
            room = capacity
            if len(cuts) >= shards - 1:
                return cuts
        room = max(0, room - r.size)
    return cuts


def undecided(ranges: list[Range], shards: int, low: int, high: int) -> set[int]:
    """Ranges of several groups that a cut could divide for some capacity in [low, high]."""
    late = greedy(ranges, high, shards, True) or []
    early = early_cuts(ranges, low, shards)
    found: set[int] = set()
    for i in range(shards - 1):
        first = early[i] if i < len(early) else len(ranges)
        last = int(late[i]) if i < len(late) else len(ranges) - 1
        found.update(k for k in range(first, last + 1) if not ranges[k].atomic)
    return found


def _histogram(groups: DataFrame, wanted: list[Range] | None, width: int) -> list[Range]:
    """Sizes by hash range of ``width`` bits; only inside ``wanted`` when given.

    At most 2**FIRST_BITS rows, or 2**MORE_BITS for each wanted range.
    """
    frame = groups
    if wanted is not None:
        prefix = F.shiftright("key", wanted[0].width)
        frame = frame.where(prefix.isin([r.start >> r.width for r in wanted]))
    rows = (
        frame.groupBy(F.shiftright("key", width).alias("part"))
        .agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("groups"), F.max("size").alias("largest"))
        .collect()
    )
    return [Range(r["part"] << width, width, int(r["size"]), r["groups"], int(r["largest"])) for r in rows]


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """Capacity and the hash keys at which shards 1, 2, ... begin, over groups (key bigint, size bigint).

    Keys must be distinct. No rows give capacity 0 and no cuts; fewer cuts than
    ``shards - 1`` leave the last shards empty.
    """
    width = 64 - FIRST_BITS
    ranges = sorted(_histogram(groups, None, width), key=lambda r: r.start)
    if not ranges:
        return 0, []
    while True:
        low, high = smallest(ranges, shards, True), smallest(ranges, shards, False)
        open_ranges = undecided(ranges, shards, low, high)
        if not open_ranges:
            break
        widest = max(ranges[k].width for k in open_ranges)
        chosen = [ranges[k] for k in sorted(open_ranges) if ranges[k].width == widest]
        finer = _histogram(groups, chosen, max(0, widest - MORE_BITS))
        gone = {r.start for r in chosen}
        kept = [r for r in ranges if not (r.width == widest and r.start in gone)]
        ranges = sorted(kept + finer, key=lambda r: r.start)
    cuts = greedy(ranges, high, shards, False) or []
    return high, [ranges[int(c)].start for c in cuts]


def shard_of(key: Column, cuts: Iterable[int]) -> Column:
    """Shard number of a key: how many cuts lie at or before it."""
    total = F.lit(0)
    for cut in cuts:
        total = total + (key >= F.lit(cut)).cast("int")
    return total


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Assign every row to one of ``shards`` contiguous runs of text groups with sizes near equal.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Returns
    doc_id, size (UTF-8 bytes + 1; a null text has none), text_crc32, shard and
    slot (0, 1, ... within a shard, ordered by key run and doc_id). A null text
    counts as its own group next to the empty text's key; equal texts never
    part, so a group larger than the mean decides the capacity. Repeated rows
    each get a slot. An empty table gives no rows.
    """
    slim = written(
        docs.select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
            F.crc32(text_or_empty().cast("binary")).alias("text_crc32"),
            F.xxhash64(F.col("text")).alias("key"),
        ),
        "shard_rows",
    )
    groups = written(slim.groupBy("key").agg(F.sum("size").alias("size")), "shard_groups")
    _, cuts = minimax_cuts(groups, shards)
    runs = pieces(slim.count(), ROWS_PER_RUN)
    placed = slim.withColumn("shard", shard_of(F.col("key"), cuts)).withColumn(
        "run", F.pmod(F.xxhash64("doc_id", "key"), F.lit(runs)).cast("int")
    )
    counts = placed.groupBy("shard", "run").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "run").orderBy("doc_id", "key")
    numbered = placed.withColumn("at", F.row_number().over(inside) - 1)
    return numbered.join(offsets, ["shard", "run"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("at")).cast("bigint").alias("slot")
    )


def op6_sharding(spark, sf_dir: str) -> DataFrame:
    from .common import table

    out = shard_documents(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
