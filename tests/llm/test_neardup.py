import random
from collections import defaultdict

import numpy as np
import pytest

from trafficlens.llm import neardup as nd
from trafficlens.llm.components import components

SF = "/root/testdata/sf0.01"


def probability_jaccard(x, y):
    """By its definition, over dicts of weights."""
    union = set(x) | set(y)
    both = set(x) & set(y)
    return sum(1 / sum(max(x.get(q, 0) / x[d], y.get(q, 0) / y[d]) for q in union) for d in both)


def sorted_set(rng, values, top):
    values = np.sort(np.array(values, np.uint64))
    return values, rng.integers(1, top + 1, len(values))


@pytest.mark.parametrize("top", [1, 4])
def test_registers_estimate_probability_jaccard(top):
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 2**63, 600).tolist()
    for shared in (380, 300, 150):
        s, c = sorted_set(rng, pool[:400], top)
        t, d = sorted_set(rng, pool[400 - shared : 800 - shared], top)
        want = probability_jaccard(dict(zip(s.tolist(), c)), dict(zip(t.tolist(), d)))
        got = nd.signatures([(s, c), (t, d)])
        assert abs((got[0] == got[1]).mean() - want) < 4 * np.sqrt(0.25 / nd.REGISTERS)
        plain = len(set(s.tolist()) & set(t.tolist())) / len(set(s.tolist()) | set(t.tolist()))
        assert np.isclose(nd.similarity(s, c, t, d), max(plain, want))


def test_registers_do_not_depend_on_the_batch():
    rng = np.random.default_rng(5)
    sets = [sorted_set(rng, rng.integers(0, 2**63, n).tolist(), 3) for n in (1, 3, 40, 700)]
    together = nd.signatures(sets)
    for k, one in enumerate(sets):
        assert (nd.signatures([one])[0] == together[k]).all()


def brute_links(docs):
    known = nd.WordHashes()
    sets = {i: nd.shingles(t or "", known) for i, t in docs}
    ids = sorted(sets)
    small = [(nd._weighted((s >> np.uint64(32)).astype("<u4").tobytes(), c.astype("<u4").tobytes())) for s, c in map(sets.get, ids)]
    return [
        (ids[a], ids[b])
        for a in range(len(ids))
        for b in range(a + 1, len(ids))
        if len(small[a][0]) and len(small[b][0]) and nd.similarity(*small[a], *small[b]) >= nd.SIMILARITY
    ]


def classes_of(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def test_query_matches_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    links = brute_links(docs)
    want = classes_of([i for i, _ in docs], links)
    got = {r["doc_id"]: r["class_id"] for r in nd.op9_neardup(spark, SF).collect()}
    assert len(got) == len(docs)
    assert sum(got[a] == got[b] for a, b in links) >= 0.95 * len(links)
    assert sum(got[i] == want[i] for i in got) >= 0.99 * len(got)


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(nd, "SMALL_BUCKET", 3)
    monkeypatch.setattr(nd, "BLOCK", 4)
    rng = random.Random(6)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    docs = []
    for k in range(60):
        words = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 4])):
            words[rng.randrange(len(words))] = f"v{rng.randrange(10**6)}"
        docs.append((k, " ".join(words)))
    links = brute_links(docs)
    got = {r["doc_id"]: r["class_id"] for r in nd.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert sum(got[a] == got[b] for a, b in links) >= 0.97 * len(links)


def test_components(spark):
    rng = random.Random(7)
    pairs = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    pairs += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    want = classes_of({x for p in pairs for x in p}, pairs)
    found = components(spark.createDataFrame(pairs, "u bigint, v bigint")).collect()
    got = {r["node"]: r["component"] for r in found}
    assert len(found) == len(got) and got == {i: c for i, c in want.items() if i in got}
    assert set(got) == {x for a, b in pairs if a != b for x in (a, b)}


def test_odd_rows(spark, odd_docs):
    rows = nd.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    classes = defaultdict(set)
    for r in rows:
        classes[r["class_id"]].add(r["doc_id"])
    assert classes[2] == {2, 3, 7} and classes[5] == {5} and classes[None] == {None}
    kept = nd.keep_one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    texts = sorted((r["doc_id"] or -1, r["text"] or "") for r in kept.collect())
    assert [i for i, _ in texts] == [-1, 1, 2, 4, 5, 5, 8, 9] and texts[4][1] != texts[5][1]
    assert nd.near_duplicates(odd_docs.limit(0)).count() == 0


def test_pairs_near_by_plain_jaccard_only(spark):
    rng = random.Random(10)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    docs = []
    for k in range(20):
        base, line, other = words(204), words(10), words(10)
        docs.append((4 * k, " ".join(base)))
        docs.append((4 * k + 1, " ".join(base + line * 20)))
        both = words(204)
        docs.append((4 * k + 2, " ".join(both + line * 20)))
        docs.append((4 * k + 3, " ".join(both + other * 3)))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r["doc_id"]: r["class_id"] for r in nd.near_duplicates(frame).collect()}
    want = classes_of([i for i, _ in docs], brute_links(docs))
    assert sum(want[i] != i for i in want) >= 30
    assert sum(got[i] == want[i] for i in got) >= 0.97 * len(got)


def test_recall_of_isolated_pairs_at_the_bound():
    """Two texts with no third copy, at similarities just above 0.8: the share that meets in some band."""
    import numpy as np

    from trafficlens.llm import neardup as nd

    rng = np.random.default_rng(17)
    met = {}
    for similarity in (0.80, 0.82, 0.85, 0.9):
        pairs = 600
        sets = []
        for k in range(pairs):
            n = int(rng.integers(60, 400))
            shared = int(round(similarity * 2 * n / (1 + similarity)))
            members = rng.integers(0, 1 << 63, 2 * n - shared, dtype=np.int64).astype(np.uint64)
            ones = lambda s: (np.sort(s), np.ones(len(s), np.int64))
            sets += [ones(members[:n]), ones(members[n - shared :])]
        keys = nd.band_keys(nd.signatures(sets))
        met[similarity] = np.mean([(keys[2 * k] == keys[2 * k + 1]).any() for k in range(pairs)])
    print("isolated pairs that meet, by similarity:", met)
    assert met[0.80] >= 0.94 and met[0.82] >= 0.97 and met[0.85] >= 0.99 and met[0.9] == 1.0
