import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from trafficlens.llm import classlm as lm

SF = "/root/testdata/sf0.01"
WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def test_counts_and_base_score_match_brute_force(spark):
    docs = {r["doc_id"]: words(r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    train = {i for i in docs if zlib.crc32(str(i).encode()) % 10}
    counts = Counter(w for i in train for w in docs[i])
    total, distinct = sum(counts.values()) + len(train), len(counts) + 1
    rows = lm.op4_classlm(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        w = docs[r["doc_id"]]
        base = sum(math.log10((c + 0.1) / (total + 0.1 * (distinct + 1))) for c in [counts[x] for x in w] + [len(train)])
        assert r["held_out"] == (r["doc_id"] not in train) and r["train_tokens"] == total
        assert (r["n_tokens"], r["n_known"]) == (len(w) + 1, sum(x in counts for x in w) + 1)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert math.isfinite(r["score"]) and r["score"] < 0
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_scores_follow_from_classes_and_counts(spark, monkeypatch):
    monkeypatch.setattr(lm, "MIN_COUNT", 2)
    texts = ["a b a b a c", "b a c a b", "c c a b d", "a e"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    chunks = lm.encode_chunks(docs, F.lit(False))
    found = {r["word"]: r for r in lm.exchange_classes(lm.vocabulary(chunks)).collect()}
    count = Counter(w for t in texts for w in t.split())
    assert {w: r["c"] for w, r in found.items()} == dict(count)
    kind = {w: r["class"] for w, r in found.items()}
    assert kind["d"] == kind["e"] == lm.RARE and lm.RARE not in (kind["a"], kind["b"], kind["c"])
    width = lm.CLASSES + 2
    pairs = np.zeros((width, width))
    lines = [[lm.EDGE, *(kind[w] for w in t.split()), lm.EDGE] for t in texts]
    for line in lines:
        for a, b in zip(line, line[1:]):
            pairs[a, b] += 1
    moves, size = lm.smoothed(pairs), Counter(k for line in lines for k in line[1:])
    for r in lm.score_texts(docs, F.lit(False)).collect():
        line, own = lines[r["doc_id"]], texts[r["doc_id"]].split()
        want = sum(moves[a, b] for a, b in zip(line, line[1:]))
        for w in own:
            rare = kind[w] == lm.RARE
            want += math.log10((count[w] + 0.1) / (size[lm.RARE] + 0.1 * 3) if rare else count[w] / size[kind[w]])
        assert math.isclose(r["score"], want, rel_tol=1e-9)


def test_exchange_separates_contexts():
    rng = np.random.default_rng(3)
    profiles = rng.dirichlet(np.full(lm.CODES, 0.2), 3) * 200
    vectors = rng.poisson(profiles[np.arange(90) % 3]).astype(np.float32)
    seeds = np.full((lm.CLASSES, lm.CODES), -0.09)
    seeds[:3] = vectors[:3]
    matrices = [seeds]
    for _ in range(3):
        current = lm.assign(vectors, np.arange(90) % 2, matrices)
        matrix = np.zeros((lm.CLASSES, lm.CODES))
        np.add.at(matrix, current, vectors)
        matrices.append(matrix)
    current = lm.assign(vectors, np.arange(90) % 2, matrices)
    assert all(len(set(current[k::3])) == 1 for k in range(3)) and len(set(current)) == 3


def test_chunks_do_not_change_scores(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = F.col("doc_id") % 7 == 0
    one = {r["doc_id"]: r for r in lm.score_texts(docs, held).collect()}
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 500)
    for r in lm.score_texts(docs.repartition(5), held).collect():
        assert r["n_known"] == one[r["doc_id"]]["n_known"]
        assert math.isclose(r["base_score"], one[r["doc_id"]]["base_score"], rel_tol=1e-9)
        assert math.isclose(r["score"], one[r["doc_id"]]["score"], rel_tol=1e-6)


def test_odd_rows(spark, odd_docs):
    rows = lm.score_texts(odd_docs, F.coalesce(F.col("doc_id") == 4, F.lit(False))).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[2]["n_tokens"] == by_id[3]["n_tokens"] == by_id[7]["n_tokens"] == 1
    assert by_id[4]["held_out"] and by_id[4]["n_tokens"] == 32_001
    assert all(math.isfinite(r["score"]) for r in rows)
    untrained = lm.score_texts(odd_docs, F.lit(True)).collect()
    assert {r["train_tokens"] for r in untrained} == {0} and all(math.isfinite(r["score"]) for r in untrained)
    assert lm.score_texts(odd_docs.limit(0), F.lit(False)).count() == 0
