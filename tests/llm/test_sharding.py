import random

from pyspark.sql import functions as F

from trafficlens.llm.sharding import greedy, minimax_cuts, op6_sharding, Range, shard_documents, smallest

SF = "/root/testdata/sf0.001"


def brute_capacity(sizes, shards):
    """Smallest capacity over all contiguous partitions, by dynamic programming."""
    best = [0] + [float("inf")] * len(sizes)
    for _ in range(shards):
        best = [
            min([best[j]] + [max(best[i], sum(sizes[i:j])) for i in range(j)]) for j in range(len(sizes) + 1)
        ]
    return best[-1]


def test_capacity_is_the_smallest_feasible(spark):
    rng = random.Random(3)
    for shards in (1, 2, 3, 5):
        keys = [rng.getrandbits(64) - 2**63 for _ in range(14)]
        sizes = [rng.choice([1, 2, 3, 40, 7]) for _ in keys]
        groups = spark.createDataFrame(list(zip(keys, sizes)), "key bigint, size bigint")
        capacity, cuts = minimax_cuts(groups, shards)
        ordered = [s for _, s in sorted(zip(keys, sizes))]
        assert capacity == brute_capacity(ordered, shards)
        loads = [0] * shards
        for k, s in zip(keys, sizes):
            loads[sum(k >= c for c in cuts)] += s
        assert max(loads) == capacity


def test_clustered_keys_are_refined_to_single_groups(spark):
    # All keys share their upper bits, so the first histograms hold one range only.
    rng = random.Random(5)
    keys = list(range(1_000_000, 1_000_300))
    sizes = [rng.randrange(1, 50) for _ in keys]
    capacity, cuts = minimax_cuts(spark.createDataFrame(list(zip(keys, sizes)), "key bigint, size bigint"), 16)
    ranges = [Range(k, 0, s, 1, s) for k, s in zip(keys, sizes)]
    assert capacity == smallest(ranges, 16, False) and len(cuts) <= 15
    assert greedy(ranges, capacity - 1, 16, False) is None


def test_rows_slots_and_atomic_groups(spark):
    out = op6_sharding(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert out.count() == docs.count()
    for row in out.groupBy("shard").agg(F.min("slot"), F.max("slot"), F.countDistinct("slot"), F.count("*")).collect():
        assert row[1] == 0 and row[2] == row[4] - 1 and row[3] == row[4]
    split = out.join(docs, "doc_id").groupBy("text").agg(F.countDistinct("shard").alias("n")).where("n > 1")
    assert split.count() == 0
    assert {r["law"] for r in out.collect()} == {"bytes"}


def test_odd_rows(spark, odd_docs):
    rows = shard_documents(odd_docs, 4).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[2]["size"] == 1 and by_id[2]["text_crc32"] == 0 and by_id[9]["size"] == 50_001
    assert shard_documents(odd_docs.limit(0), 4).count() == 0
