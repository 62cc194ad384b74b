"""Near-duplicates by ProbMinHash over weighted five-word shingles, banding and exact verification.

A shingle of weight w sends arrivals of a Poisson process of rate w to random
registers; a register keeps the shingle that arrives first, and a shingle stops
once its next arrival is later than every register's first. Two documents agree in
a register with probability equal to the probability Jaccard of their weighted
shingles. Documents that agree in all registers of a band share a bucket. A text
that repeats a shingle also has the bands of its plain set, all rates 1, so pairs
that are near by plain Jaccard meet however often a line repeats.

Documents with equal weighted shingles are one node. Buckets of up to
SMALL_BUCKET nodes give all their pairs; larger ones are first linked to their
least node, and what that leaves in different components is compared block by
block, so no bucket needs a large task and pairs of a large bucket are never
written out. Every candidate is verified on its shingles. Classes are the
connected components of the verified links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import row_slices, sieve, table, text_or_empty, written
from .components import components

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 10  # a pair of similarity 0.8 meets in some band with probability 0.97, one of 0.9 with 1 - 1e-6
REGISTERS = BANDS * ROWS
SMALL_BUCKET = 24
BLOCK = 64
ELEMENTS_AT_ONCE = 30_000
REMEMBERED = 200_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.array([pow(0xD6E8FEB86659FD93, k, 1 << 64) for k in range(1, 33)], np.uint64)


class WordHashes(dict):
    """64-bit hash by word."""

    def __missing__(self, word: str) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8"))
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def shingles(text: str, known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct five-word shingles of a lower-cased text and their counts; fewer words make one shingle."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    span = min(SHINGLE, len(words))
    total = np.zeros(len(words) - span + 1, np.uint64)
    for k in range(span):
        total += h[k : len(h) - span + 1 + k] * _POWERS[k]
    return np.unique(mixed(total), return_counts=True)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """ProbMinHash registers (documents, REGISTERS) of non-empty weighted sets."""
    many = len(sets)
    first = np.full(many * REGISTERS, np.inf)
    holder = np.zeros(many * REGISTERS, np.uint64)
    sizes = np.array([len(s) for s, _ in sets])
    owner = np.repeat(np.arange(many), sizes)
    element = np.concatenate([s for s, _ in sets])
    rate = np.concatenate([c for _, c in sets]).astype(np.float64)
    time = np.zeros(len(element))
    # Small sets need many arrivals of each element: several are drawn in one go.
    together = int(np.clip(2 * REGISTERS // max(1, int(np.median(sizes))), 1, 16))
    drawn = 0
    while len(element):
        numbers = np.arange(drawn, drawn + together, dtype=np.uint64) * _STEP
        drawn += together
        random = mixed(element[:, None] + numbers[None, :])
        gaps = -np.log(((random >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate[:, None]
        arrivals = time[:, None] + np.cumsum(gaps, axis=1)
        latest = first.reshape(many, REGISTERS).max(axis=1)
        early = arrivals < latest[owner][:, None]
        which, _ = np.nonzero(early)
        when = arrivals[early]
        at = owner[which] * REGISTERS + (mixed(random[early] ^ _STEP) % np.uint64(REGISTERS)).astype(np.int64)
        np.minimum.at(first, at, when)
        won = first[at] == when
        holder[at[won]] = element[which[won]]
        time = arrivals[:, -1]
        latest = first.reshape(many, REGISTERS).max(axis=1)
        alive = time < latest[owner]
        owner, element, rate, time = owner[alive], element[alive], rate[alive], time[alive]
    return holder.reshape(many, REGISTERS)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One 64-bit key per document and band, different for every band."""
    parts = registers.reshape(len(registers), BANDS, ROWS)
    folded = (mixed(parts) * _POWERS[:ROWS]).sum(axis=2, dtype=np.uint64)
    return mixed(folded + np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP).view(np.int64)


def document_signatures(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text_hash, a, b, n, bands, shingles, weights) of every whole text.

    ``a`` and ``b`` are a 128-bit hash of the weighted shingles and ``n`` their
    number; ``shingles`` are 32-bit values in rising order, ``weights`` their
    counts or null when all are 1. A text without words has no bands.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for part in row_slices(batches, 512):
            if len(known) > REMEMBERED:
                known.clear()
            sets = [shingles(text, known) for text in part.column(3).to_pylist()]
            bands: list = [[] for _ in sets]
            # (document, set): the weighted set of each and, where a shingle repeats, the plain one.
            tasks = [(i, one) for i, one in enumerate(sets) if len(one[0])]
            tasks += [(i, (s, np.ones_like(c))) for i, (s, c) in tasks if c.max() > 1]
            order = sorted(range(len(tasks)), key=lambda k: len(tasks[k][1][0]))
            group, held = [], 0
            for i in chain(order, [None]):
                if group and (i is None or held + len(tasks[i][1][0]) > ELEMENTS_AT_ONCE):
                    for k, keys in zip(group, band_keys(signatures([tasks[k][1] for k in group]))):
                        j = tasks[k][0]
                        bands[j] = np.union1d(bands[j], keys) if len(bands[j]) else keys
                    group, held = [], 0
                if i is not None:
                    group.append(i)
                    held += len(tasks[i][1][0])
            bags, packed, weights = [], [], []
            for s, c in sets:
                counted = mixed(s + c.astype(np.uint64) * _STEP)
                bags.append((counted.sum(dtype=np.uint64), mixed(counted).sum(dtype=np.uint64)))
                small = (s >> np.uint64(32)).astype("<u4")  # s rises, so its upper half does
                packed.append(small.tobytes())
                weights.append(None if not len(c) or c.max() == 1 else c.astype("<u4").tobytes())
            a, b = (np.array(x, np.uint64).view(np.int64) for x in zip(*bags))
            yield pa.RecordBatch.from_arrays(
                [
                    *part.columns[:3],
                    pa.array(a),
                    pa.array(b),
                    pa.array([len(s) for s, _ in sets], pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(packed, pa.binary()),
                    pa.array(weights, pa.binary()),
                ],
                ["row", "doc_id", "text_hash", "a", "b", "n", "bands", "shingles", "weights"],
            )

    slim = docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.xxhash64(text_or_empty()).alias("text_hash"),
        text_or_empty().alias("text"),
    )
    kind = slim.schema["doc_id"].dataType.simpleString()
    schema = (
        f"row bigint, doc_id {kind}, text_hash bigint, a bigint, b bigint, n bigint, "
        "bands array<bigint>, shingles binary, weights binary"
    )
    return slim.mapInArrow(sign, schema)


def similarity(s: np.ndarray, c: np.ndarray, t: np.ndarray, d: np.ndarray) -> float:
    """The larger of the Jaccard and the probability Jaccard of two weighted sets with rising members."""
    both, at_s, at_t = np.intersect1d(s, t, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    plain = len(both) / (len(s) + len(t) - len(both))
    if c.max() == 1 and d.max() == 1:
        return plain
    x, y = c[at_s].astype(np.float64), d[at_t].astype(np.float64)
    # A shingle of one side only has ratio infinity (x alone) or zero (y alone).
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    ratio = x / y
    x_from = c.sum() - x.sum() + np.cumsum(x[::-1])[::-1]
    y_until = d.sum() - y.sum() + np.append(0.0, np.cumsum(y)[:-1])
    same = np.searchsorted(ratio, ratio, "left")  # ties count with the larger side
    return max(plain, float((1.0 / (x_from[same] / x + y_until[same] / y)).sum()))


def _weighted(packed: bytes, weights: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    s = np.frombuffer(packed, "<u4")
    c = np.ones(len(s), np.uint32) if weights is None else np.frombuffer(weights, "<u4")
    if len(s) > 1 and (s[1:] == s[:-1]).any():
        s, where = np.unique(s, return_index=True)
        c = np.add.reduceat(c, where)
    return s, c


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (u, v) pairs whose similarity reaches SIMILARITY; ``sets`` has node, shingles and weights.

    A node with very many partners is split by adaptive execution: both joins are
    plain equi-joins of which it may divide the side of the pairs.
    """
    left = sets.select(F.col("node").alias("u"), F.col("shingles").alias("s"), F.col("weights").alias("c"))
    right = sets.select(F.col("node").alias("v"), F.col("shingles").alias("t"), F.col("weights").alias("d"))
    joined = pairs.join(left, "u").join(right, "v").select("u", "v", "s", "c", "t", "d")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches, 512):
            columns = [batch.column(k).to_pylist() for k in range(2, 6)]
            good = [similarity(*_weighted(s, c), *_weighted(t, d)) >= SIMILARITY for s, c, t, d in zip(*columns)]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["u", "v"]).filter(pa.array(good, pa.bool_()))

    return joined.mapInArrow(check, "u bigint, v bigint")


def _compare_blocks(mixed_members: DataFrame, sets: DataFrame) -> DataFrame:
    """Verified links between components inside large buckets, block pair by block pair."""
    sizes = mixed_members.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    # Written, so that the join has a plain shuffle on both sides and a large bucket's rows can be divided.
    sizes = written(sizes, "neardup_sizes")
    placed = mixed_members.join(sizes, "bucket").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "bucket",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "block",
        "node",
        "component",
    )

    def compare(group: pa.Table) -> pa.Table:
        columns = {name: group.column(name).to_pylist() for name in group.column_names}
        within = columns["i"][0] == columns["j"][0]
        sets_ = [_weighted(s, c) for s, c in zip(columns["shingles"], columns["weights"])]
        part = dict(enumerate(columns["component"]))
        block, node = columns["block"], columns["node"]
        found = []
        for x in range(len(node)):
            for y in range(x + 1, len(node)):
                if part[x] == part[y] or (not within and block[x] == block[y]):
                    continue
                if similarity(*sets_[x], *sets_[y]) >= SIMILARITY:
                    found.append((node[x], node[y]))
                    gone, stays = part[y], part[x]
                    part = {k: stays if p == gone else p for k, p in part.items()}
        u, v = zip(*found) if found else ((), ())
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return dealt.join(sets, "node").groupBy("bucket", "i", "j").applyInArrow(compare, "u bigint, v bigint")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Class of every document row.

    ``docs`` needs doc_id and text; other columns are ignored. Returns row,
    doc_id, text_hash, class_id (the least doc_id of the class), class_size, the
    text's node and the class's least node ``component``. Texts that differ in case or
    white space only are equal; null and wordless texts are equal to each other;
    repeated rows share a class. A class of rows without doc_id has class_id
    null. An empty table gives no rows.
    """
    signed = written(document_signatures(docs), "neardup_signatures")
    nodes = written(
        signed.groupBy("a", "b", "n").agg(
            F.min("row").alias("node"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")
        ),
        "neardup_nodes",
    )
    own = signed.join(nodes.select(F.col("node").alias("row")), "row", "left_semi")
    spread = written(own.select(F.col("row").alias("node"), F.explode("bands").alias("bucket")), "neardup_bands")
    counted = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("u"))
    shared = written(counted.where("size > 1"), "neardup_buckets")
    members = sieve(spread, "bucket", shared.select("bucket")).join(shared, "bucket")
    members = written(members, "neardup_members")

    small = members.where(F.col("size") <= SMALL_BUCKET).select("bucket", "node")
    paired = small.select("bucket", F.col("node").alias("u")).join(
        small.select("bucket", F.col("node").alias("v")), "bucket"
    )
    large = members.where(F.col("size") > SMALL_BUCKET)
    starred = large.where("u <> node").select("u", F.col("node").alias("v"))
    pairs = written(paired.where("u < v").select("u", "v").union(starred).distinct(), "neardup_pairs")
    involved = written(pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct(), "neardup_involved")
    sets = signed.select(F.col("row").alias("node"), "shingles", "weights")
    sets = written(sieve(sets, "node", involved), "neardup_sets")
    links = written(verified(pairs, sets), "neardup_links")
    found = components(links)

    # Large buckets that hold more than one component still owe comparisons.
    placed = large.select("bucket", "node").join(found, "node", "left")
    placed = written(placed.withColumn("component", F.coalesce("component", "node")), "neardup_large")
    uneven = (
        placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    )
    owing = placed.join(written(uneven.select("bucket"), "neardup_uneven"), "bucket", "left_semi")
    if not owing.isEmpty():
        more = written(_compare_blocks(owing, sets), "neardup_links")
        found = components(links.union(more))

    classed = nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    classed = written(classed, "neardup_classes")
    totals = classed.groupBy("component").agg(F.min("least").alias("class_id"), F.sum("copies").alias("class_size"))
    totals = written(totals, "neardup_totals")  # as above: a large component's rows can be divided
    labelled = classed.join(totals, "component").select("a", "b", "n", "node", "component", "class_id", "class_size")
    return signed.select("row", "doc_id", "text_hash", "a", "b", "n").join(labelled, ["a", "b", "n"]).drop("a", "b", "n")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each near-duplicate class: the least doc_id, then the least text hash; all columns stay.

    Rows without doc_id come last. A kept row is found again by doc_id and the
    hash of its text; where rows repeat under both, one of them stays.
    """
    classes = near_duplicates(docs.select("doc_id", "text"))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    best = classes.groupBy("component", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows"))
    best = best.groupBy("component").agg(F.min_by(F.struct("doc_id", "text_hash", "rows"), rank).alias("best"))
    kept = best.groupBy(F.col("best.doc_id").alias("__doc"), F.col("best.text_hash").alias("__kept")).agg(
        F.max("best.rows").alias("__rows")
    )
    kept = written(kept, "neardup_kept")
    keyed = docs.withColumn("__hash", F.xxhash64(text_or_empty()))
    same = keyed["doc_id"].eqNullSafe(F.col("__doc")) & (keyed["__hash"] == F.col("__kept"))
    once = keyed.join(kept.where("__rows = 1"), same, "left_semi")
    repeated = kept.where("__rows > 1")
    if not repeated.isEmpty():
        once = once.unionByName(keyed.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "__hash"]))
    return once.select(*docs.columns)


def op9_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")
