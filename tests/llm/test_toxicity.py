import numpy as np
import pytest

from trafficlens.llm import toxicity as tx

SF = "/root/testdata/sf0.01"


def test_gradient_matches_differences():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) + rng.standard_normal(v.shape) * 0.1 for k, v in tx.new_parameters().items()}
    x = rng.standard_normal((5, 2 * tx.SIDE))
    ids, mask = rng.integers(0, 5, (6, 3)), np.ones((6, 3))
    mask[4:, 1] = 0
    y, w = np.array([1.0, 0, 1]), np.ones(3)

    def loss():
        ahead, back = tx.gate_shares(p, x)
        logit = tx.window_logits(p, ahead, back, ids, mask)
        return float((np.log1p(np.exp(logit)) - y * logit).mean())

    g = tx.gradient(p, x, ids, mask, y, w)
    for name in ("out", "weigh", "look", "state_ahead", "state_back", "bias_back", "in_ahead", "in_back"):
        at = tuple(0 for _ in p[name].shape)
        kept = p[name][at]
        p[name][at] = kept + 1e-3
        up = loss()
        p[name][at] = kept - 1e-3
        down = loss()
        p[name][at] = kept
        assert np.isclose((up - down) / 2e-3, g[name][at], rtol=2e-2, atol=1e-5)


def test_windows_overlap_and_cover():
    sizes = np.array([0, 1, 32, 33, 100])
    starts, ends, owner = tx.windows_of(sizes)
    begin = np.cumsum(sizes) - sizes
    for k, n in enumerate(sizes):
        own = [(s - begin[k], e - begin[k]) for s, e, o in zip(starts, ends, owner) if o == k]
        assert own[0][0] == 0 and own[-1][1] == n
        assert all(b[0] < a[1] for a, b in zip(own, own[1:]))


def test_a_toxic_word_anywhere_counts():
    rng = np.random.default_rng(2)
    clean = ["".join(rng.choice(list("abcdefgh"), 4)) for _ in range(300)]
    texts, labels = [], []
    for k in range(240):
        words = list(rng.choice(clean, 60))
        if k % 2:
            words[rng.integers(60)] = rng.choice(["zorkus", "zorkel", "zorkan", "zorkit"])
        texts.append(" ".join(words))
        labels.append(k % 2)
    p = tx.train_toxicity(texts, labels)
    probe = [" ".join(rng.choice(clean, 900)) for _ in range(20)]
    marked = [t + " zorkan " + " ".join(rng.choice(clean, 300)) for t in probe]
    known = tx.Words(p)
    assert (tx.score_texts(p, marked, known) > 0).mean() >= 0.9
    assert (tx.score_texts(p, probe, known) < 0).mean() >= 0.9


def test_scores_do_not_depend_on_batches():
    p = tx.new_parameters()
    texts = ["a b c " * 40, "", "word " * 500, "x"]
    together = tx.score_texts(p, texts, tx.Words(p))
    alone = [tx.score_texts(p, [t], tx.Words(p))[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-5)


def test_query(spark):
    rows = tx.op5_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    right = np.mean([r["predicted"] == r["toxic"] for r in rows])
    assert right > 0.93 and all(0 <= r["score"] <= 1 for r in rows)


@pytest.mark.parametrize("labelled", [True, False])
def test_odd_rows(spark, odd_docs, labelled):
    labels = spark.createDataFrame([(1, 1), (4, 0), (5, None), (None, 1)], "doc_id bigint, toxic int")
    rows = tx.classify_toxicity(odd_docs, labels if labelled else labels.limit(0)).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    if not labelled:
        assert {r["score"] for r in rows} == {0.5}
    assert tx.classify_toxicity(odd_docs.limit(0), labels).count() == 0


def plain_input(p, word):
    """A word's vector and the mean of its trigrams' vectors, trigram by trigram."""
    word = word.strip(tx._EDGES) or word
    data, m = b"^" + word.encode("utf-8") + b"$$", (1 << 32) - 1
    rows = []
    for a, b, c in zip(data, data[1:], data[2:]):
        h = (a * 0x9E3779B1 ^ b * 0x85EBCA77 ^ c * 0xC2B2AE3D) & m
        rows.append(((h ^ h >> 15) * 0x27D4EB2F & m) >> 19)
    own = p["words"][tx.word_row(word)]
    return np.concatenate([own, np.mean([p["trigrams"][r] for r in rows], axis=0)]).astype(np.float64)


def plain_logit(p, text):
    """The worst of all windows of a text: a GRU each way, attention and the output, one word after the other."""
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    words, h = text.lower().split(), tx.HIDDEN
    worst, first = -np.inf, 0
    while True:
        inputs = [plain_input(p, w) for w in words[first : first + tx.WINDOW]]
        states = {}
        for way, order in (("ahead", range(len(inputs))), ("back", reversed(range(len(inputs))))):
            state = np.zeros(h)
            for t in order:
                gates = inputs[t] @ p[f"in_{way}"] + p[f"bias_{way}"]
                own = state @ p[f"state_{way}"]
                z, r = sigmoid(gates[:h] + own[:h]), sigmoid(gates[h : 2 * h] + own[h : 2 * h])
                fresh = np.tanh(gates[2 * h :] + r * own[2 * h :])
                state = z * state + (1 - z) * fresh
                states[way, t] = state
        both = [np.concatenate([states["ahead", t], states["back", t]]) for t in range(len(inputs))]
        looks = np.array([np.tanh(s @ p["look"] + p["look_bias"]) @ p["weigh"] for s in both])
        share = np.exp(looks - looks.max()) if both else looks
        pooled = sum((w * s for w, s in zip(share / share.sum(), both)), np.zeros(2 * h)) if both else np.zeros(2 * h)
        worst = max(worst, pooled @ p["out"] + p["out_bias"][0])
        if first + tx.WINDOW >= len(words):
            return worst
        first += tx.STRIDE


def test_scores_equal_a_plain_network_over_all_windows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    texts = [r["text"] or "" for r in docs if len(r["text"] or "") < 4000][:40] + ["", " \n", "one", "w " * 33, "w " * 32, "...", "é " * 57]
    p = tx.new_parameters(3)
    p["out_bias"][:] = 0.25
    got = tx.score_texts(p, texts, tx.Words(p))
    assert np.allclose(got, [plain_logit(p, t) for t in texts], atol=2e-4)


def test_without_a_model_every_row_is_kept(spark, odd_docs):
    labels = spark.createDataFrame([(1, 0), (4, 0), (5, None), (None, 1)], "doc_id bigint, toxic int")
    for known in (labels, labels.limit(0)):
        assert tx.keep_clean(odd_docs, known).count() == odd_docs.count()
    assert tx.keep_clean(odd_docs.limit(0), labels).count() == 0


def test_training_rows_come_from_the_documents_at_hand(spark, monkeypatch):
    """Rows are limited after the join and the length filter, and a repeated id doesn't grow the sample."""
    monkeypatch.setattr(tx, "TRAIN_ROWS", 5)
    monkeypatch.setattr(tx, "TRAIN_BYTES", 100)
    docs = [(k, f"text {k}" if k % 2 else "long " * 50) for k in range(60)] + [(7, "text 7")] * 500 + [(7, "other 7")]
    labels = [(k, k % 3 // 2) for k in range(0, 5000)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    texts, known = tx.training_texts(d, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    assert len(texts) == len(set(texts)) == 10 and sum(known) == 5 and all(len(t) < 100 for t in texts)
    by_text = {t: labels[i][1] for i, t in docs}
    assert [by_text[t] for t in texts] == known
