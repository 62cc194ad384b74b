"""Toxicity scores from a bidirectional gated recurrent network with attention pooling.

A word enters as a hashed word vector next to the mean of its hashed character
trigram vectors. Two recurrent passes read a window of WINDOW words, attention
pools their states and a logistic gives the window's score; windows overlap and
cover the whole text, and a document has the score of its worst window.

Training is plain numpy on the driver over a bounded sample (TRAIN_ROWS labelled
documents of each class, at most TRAIN_BYTES long). A document's label says only
that some window is toxic, so each round trains on the windows that the model
of the round before scores highest. Scoring runs in the executors over
all windows of all texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, row_slices, table, text_or_empty

WINDOW, STRIDE = 32, 24
HIDDEN, SIDE = 8, 8  # units per direction; width of word and character vectors
WORD_ROWS, TRIGRAM_ROWS = 1 << 14, 1 << 13
TRAIN_ROWS = 1_500  # labelled documents of each class
TRAIN_BYTES = 64_000
ROUNDS, BATCH, RATE = 8, 128, 0.01
WINDOWS_AT_ONCE = 2_048
REMEMBERED = 100_000  # distinct words a Python worker remembers before it starts afresh
_EDGES = ".,;:!?\"'()[]"


def word_row(word: str) -> int:
    return xxhash.xxh32_intdigest(word.encode("utf-8")) % WORD_ROWS


def trigram_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams of ``^word$`` for all words, and where each word's begin."""
    data = [b"^" + w.encode("utf-8") + b"$$" for w in words]
    sizes = np.fromiter(map(len, data), np.int64, len(data))
    raw = np.frombuffer(b"".join(data), np.uint8).astype(np.uint32)
    mixed = raw[:-2] * np.uint32(0x9E3779B1) ^ raw[1:-1] * np.uint32(0x85EBCA77) ^ raw[2:] * np.uint32(0xC2B2AE3D)
    mixed = (mixed ^ mixed >> np.uint32(15)) * np.uint32(0x27D4EB2F)
    rows = (mixed >> np.uint32(19)).astype(np.int64)  # 13 bits
    ends = np.cumsum(sizes)
    starts = ends - sizes
    keep = np.ones(len(raw), bool)
    keep[ends - 1] = keep[ends - 2] = False
    return rows[keep[: len(rows)]], starts - 2 * np.arange(len(words))


def windows_of(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every window over texts laid end to end."""
    counts = np.maximum(1, -(-(sizes - (WINDOW - STRIDE)) // STRIDE))
    owner = np.repeat(np.arange(len(sizes)), counts)
    ends = np.cumsum(sizes)
    first = np.cumsum(counts) - counts
    starts = (ends - sizes)[owner] + (np.arange(len(owner)) - first[owner]) * STRIDE
    return starts, np.minimum(starts + WINDOW, ends[owner]), owner


def new_parameters(seed: int = 7) -> dict[str, np.ndarray]:
    random = np.random.default_rng(seed)
    wide, gates = 2 * SIDE, 3 * HIDDEN

    def drawn(*shape: int, scale: float) -> np.ndarray:
        return (random.standard_normal(shape) * scale).astype(np.float32)

    p = {"words": drawn(WORD_ROWS, SIDE, scale=0.05), "trigrams": drawn(TRIGRAM_ROWS, SIDE, scale=0.05)}
    for way in ("ahead", "back"):
        p[f"in_{way}"] = drawn(wide, gates, scale=0.3)
        p[f"state_{way}"] = drawn(HIDDEN, gates, scale=0.3)
        p[f"bias_{way}"] = np.zeros(gates, np.float32)
    p |= {
        "look": drawn(2 * HIDDEN, HIDDEN, scale=0.3),
        "look_bias": np.zeros(HIDDEN, np.float32),
        "weigh": drawn(HIDDEN, scale=0.3),
        "out": drawn(2 * HIDDEN, scale=0.3),
        "out_bias": np.zeros(1, np.float32),
    }
    return p


def word_inputs(p: dict[str, np.ndarray], words: list[str]) -> np.ndarray:
    """The input vector of each word: its own and the mean of its trigrams'."""
    own = p["words"][[word_row(w) for w in words]]
    rows, starts = trigram_rows(words)
    counts = np.diff(np.append(starts, len(rows)))
    spelled = np.add.reduceat(p["trigrams"][rows], starts, axis=0) / counts[:, None].astype(np.float32)
    return np.hstack([own, spelled])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1.0)


def recur(gates: np.ndarray, state: np.ndarray, mask: np.ndarray, backwards: bool, keep: list | None = None) -> np.ndarray:
    """States (time, windows, HIDDEN) of one direction; ``gates`` are the inputs' shares (time, windows, 3 HIDDEN)."""
    steps, many, _ = gates.shape
    h = np.zeros((many, HIDDEN), np.float32)
    states = np.empty((steps, many, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1) if backwards else range(steps):
        own = h @ state
        both = _sigmoid(gates[t, :, : 2 * HIDDEN] + own[:, : 2 * HIDDEN])
        z, r = both[:, :HIDDEN], both[:, HIDDEN:]
        fresh = np.tanh(gates[t, :, 2 * HIDDEN :] + r * own[:, 2 * HIDDEN :])
        if keep is not None:
            keep.append((t, h, z, r, fresh, own[:, 2 * HIDDEN :]))
        h = h + mask[t][:, None] * (1.0 - z) * (fresh - h)
        states[t] = h
    return states


def pool(p: dict[str, np.ndarray], states: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, ...]:
    """Attention over time: logits, and what the gradient needs."""
    seen = np.tanh(states @ p["look"] + p["look_bias"])
    weight = np.where(mask > 0, seen @ p["weigh"], np.float32(-1e9))
    weight = np.exp(weight - weight.max(axis=0))
    weight /= weight.sum(axis=0)
    pooled = (weight[:, :, None] * states).sum(axis=0)
    return pooled @ p["out"] + p["out_bias"][0], pooled, weight, seen


def window_logits(p: dict[str, np.ndarray], ahead: np.ndarray, back: np.ndarray, ids: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Logits of windows of word numbers (time, windows); ``ahead`` and ``back`` are the words' gate shares."""
    states = np.concatenate(
        [recur(ahead[ids], p["state_ahead"], mask, False), recur(back[ids], p["state_back"], mask, True)], axis=2
    )
    return pool(p, states, mask)[0]


def laid_out(numbers: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(time, windows) word numbers and mask of the given windows."""
    at = starts[None, :] + np.arange(WINDOW)[:, None]
    mask = at < ends[None, :]
    if not len(numbers):
        return np.zeros(at.shape, np.int64), mask.astype(np.float32)
    return numbers[np.minimum(at, len(numbers) - 1)], mask.astype(np.float32)


def gate_shares(p: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return x @ p["in_ahead"] + p["bias_ahead"], x @ p["in_back"] + p["bias_back"]


def score_texts(p: dict[str, np.ndarray], texts: list[str], known: Words) -> np.ndarray:
    """Largest window score of each text; texts without words score as an empty window."""
    numbers, sizes = known.numbers(texts)
    starts, ends, owner = windows_of(sizes)
    best = np.full(len(texts), -np.inf, np.float32)
    for k in range(0, len(starts), WINDOWS_AT_ONCE):
        part = slice(k, k + WINDOWS_AT_ONCE)
        ids, mask = laid_out(numbers, starts[part], ends[part])
        np.maximum.at(best, owner[part], window_logits(p, known.ahead, known.back, ids, mask))
    return best


class Words:
    """Numbers of the words seen, and their gate shares in tables that double when full."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p, self.known = p, {}
        # Row 0 belongs to no word; empty windows point to it.
        self.ahead, self.back = (np.zeros((1 << 14, 3 * HIDDEN), np.float32) for _ in range(2))
        self.rows = 1

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > REMEMBERED:
            self.known, self.rows = {}, 1
        split = [text.lower().split() for text in texts]
        fresh = list({w for words in split for w in words}.difference(self.known))
        if fresh:
            first, self.rows = self.rows, self.rows + len(fresh)
            while self.rows > len(self.ahead):
                self.ahead, self.back = (np.concatenate([t, np.zeros_like(t)]) for t in (self.ahead, self.back))
            shares = gate_shares(self.p, word_inputs(self.p, [w.strip(_EDGES) or w for w in fresh]))
            self.ahead[first : self.rows], self.back[first : self.rows] = shares
            self.known.update(zip(fresh, range(first, self.rows)))
        look = self.known.__getitem__
        flat = np.fromiter((look(w) for words in split for w in words), np.int64)
        return flat, np.fromiter(map(len, split), np.int64, len(split))


def gradient(p: dict[str, np.ndarray], x: np.ndarray, ids: np.ndarray, mask: np.ndarray, label: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient of the weighted cross entropy; "x" is the gradient at the word inputs."""
    ahead, back = gate_shares(p, x)
    kept_ahead, kept_back = [], []
    gates = {"ahead": ahead[ids], "back": back[ids]}
    states = np.concatenate(
        [
            recur(gates["ahead"], p["state_ahead"], mask, False, kept_ahead),
            recur(gates["back"], p["state_back"], mask, True, kept_back),
        ],
        axis=2,
    )
    logits, pooled, attention, seen = pool(p, states, mask)
    d_logit = (_sigmoid(logits) - label) * weight / len(label)
    g = {"out": pooled.T @ d_logit, "out_bias": np.array([d_logit.sum()], np.float32)}
    d_pooled = d_logit[:, None] * p["out"]
    d_states = attention[:, :, None] * d_pooled[None]
    d_attention = (states * d_pooled[None]).sum(axis=2)
    d_weight = attention * (d_attention - (attention * d_attention).sum(axis=0))
    g["weigh"] = np.einsum("tn,tnh->h", d_weight, seen)
    d_seen = d_weight[:, :, None] * p["weigh"] * (1 - seen * seen)
    g["look"] = np.einsum("tns,tnh->sh", states, d_seen)
    g["look_bias"] = d_seen.sum(axis=(0, 1))
    d_states = d_states + d_seen @ p["look"].T
    d_x = np.zeros_like(x)
    for way, kept, cut in (("ahead", kept_ahead, slice(0, HIDDEN)), ("back", kept_back, slice(HIDDEN, None))):
        state = p[f"state_{way}"]
        d_gates, d_state = np.zeros_like(gates[way]), np.zeros_like(state)
        d_h = np.zeros((len(label), HIDDEN), np.float32)
        for t, h, z, r, fresh, own in reversed(kept):
            d_h = d_h + d_states[t][:, cut]
            moved = mask[t][:, None] * d_h
            d_fresh = moved * (1 - z) * (1 - fresh * fresh)
            d_z = moved * (h - fresh) * z * (1 - z)
            d_r = d_fresh * own * r * (1 - r)
            d_gates[t] = np.hstack([d_z, d_r, d_fresh])
            d_own = np.hstack([d_z, d_r, d_fresh * r])
            d_state += h.T @ d_own
            d_h = d_h - moved * (1 - z) + d_own @ state.T
        g[f"state_{way}"], g[f"bias_{way}"] = d_state, d_gates.sum(axis=(0, 1))
        at_words = np.zeros((len(x), 3 * HIDDEN), np.float32)
        np.add.at(at_words, ids.ravel(), d_gates.reshape(-1, 3 * HIDDEN))
        g[f"in_{way}"] = x.T @ at_words
        d_x += at_words @ p[f"in_{way}"].T
    g["x"] = d_x
    return g


def _log_odds(toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
    """Smoothed log ratio of two count tables, about -1..1."""
    smooth = 2.0
    ratio = np.log((toxic + smooth) / (toxic.sum() + smooth * len(toxic)))
    return np.clip((ratio - np.log((clean + smooth) / (clean.sum() + smooth * len(clean)))) / 4.0, -1, 1)


def train_toxicity(texts: list[str], labels: list[int], seed: int = 7) -> dict[str, np.ndarray]:
    """Fit the network; without texts of both classes the parameters stay as drawn, with output 0."""
    p = new_parameters(seed)
    y = np.array(labels, np.float32)
    if not len(y) or y.min() == y.max():
        p["out"][:], p["out_bias"][:] = 0, 0
        return p
    number: dict[str, int] = {}
    numbered = [
        np.array([number.setdefault(w.strip(_EDGES) or w, len(number)) for w in text.lower().split()], np.int64)
        for text in texts
    ]
    words = list(number) or [""]
    flat = np.concatenate(numbered)
    sizes = np.fromiter(map(len, numbered), np.int64, len(numbered))
    del number, numbered
    starts, ends, owner = windows_of(sizes)
    word_rows = np.array([word_row(w) for w in words])
    rows, first = trigram_rows(words)
    counts = np.diff(np.append(first, len(rows)))
    word_of = np.repeat(np.arange(len(words)), counts)

    # The first column starts as the log odds of the word and of its trigrams, by documents and by tokens.
    once = np.unique(np.repeat(np.arange(len(sizes)), sizes) * len(words) + flat)
    in_docs = [np.bincount(word_rows[(once % len(words))[y[once // len(words)] == k]], minlength=WORD_ROWS) for k in (0, 1)]
    tokens = [np.bincount((once % len(words))[y[once // len(words)] == k], minlength=len(words)) for k in (0, 1)]
    in_trigrams = [np.bincount(rows, weights=tokens[k][word_of], minlength=TRIGRAM_ROWS) for k in (0, 1)]
    p["words"][:, 0] = _log_odds(in_docs[1], in_docs[0])
    p["trigrams"][:, 0] = _log_odds(in_trigrams[1], in_trigrams[0])

    def inputs(some: np.ndarray) -> np.ndarray:
        own = p["words"][word_rows[some]]
        at = [np.arange(first[k], first[k] + counts[k]) for k in some]
        spelled = np.add.reduceat(p["trigrams"][rows[np.concatenate(at)]], np.cumsum(counts[some]) - counts[some], axis=0)
        return np.hstack([own, spelled / counts[some][:, None].astype(np.float32)])

    def everything(made) -> list[np.ndarray]:
        """``made`` of the inputs of all words, block by block."""
        return [made(inputs(np.arange(k, min(k + 10_000, len(words))))) for k in range(0, len(words), 10_000)]

    leaning = np.concatenate(everything(lambda x: x[:, [0, SIDE]].sum(axis=1)))
    strongest = np.array([leaning[flat[a:b]].max() if b > a else -9.0 for a, b in zip(starts, ends)])
    random = np.random.default_rng(seed)
    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in p.items()}
    step = 0
    balance = np.where(y > 0, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum()))).astype(np.float32)
    for turn in range(ROUNDS):
        if turn:
            ahead, back = map(np.concatenate, zip(*everything(lambda x: gate_shares(p, x))))
            for k in range(0, len(starts), WINDOWS_AT_ONCE):
                part = slice(k, k + WINDOWS_AT_ONCE)
                ids, mask = laid_out(flat, starts[part], ends[part])
                strongest[part] = window_logits(p, ahead, back, ids, mask)
        order = np.lexsort((-strongest, owner))
        rank = np.arange(len(order)) - np.searchsorted(owner[order], owner[order])
        # Of a toxic text the strongest window, of a clean one the three strongest and a random one.
        picked = order[(rank == 0) | ((y[owner[order]] == 0) & ((rank < 3) | (random.random(len(order)) < 0.05)))]
        random.shuffle(picked)
        for k in range(0, len(picked), BATCH):
            some = picked[k : k + BATCH]
            ids, mask = laid_out(flat, starts[some], ends[some])
            used, local = np.unique(ids, return_inverse=True)
            g = gradient(p, inputs(used), local.reshape(ids.shape), mask, y[owner[some]], balance[owner[some]])
            d_x = g.pop("x")
            g["words"], g["trigrams"] = np.zeros_like(p["words"]), np.zeros_like(p["trigrams"])
            np.add.at(g["words"], word_rows[used], d_x[:, :SIDE])
            spread = np.repeat(d_x[:, SIDE:] / counts[used][:, None], counts[used], axis=0)
            np.add.at(g["trigrams"], rows[np.concatenate([np.arange(first[w], first[w] + counts[w]) for w in used])], spread)
            step += 1
            for name, value in g.items():
                m, v = moment[name]
                m += 0.1 * (value - m)
                v += 0.001 * (value * value - v)
                p[name] -= (RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return p


def training_texts(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> tuple[list[str], list[int]]:
    """At most TRAIN_ROWS texts of each class, chosen by a hash of doc_id, of at most TRAIN_BYTES bytes each.

    The rows are chosen among the labelled ones of ``docs`` that are short enough, by
    id and hash of the text; only the chosen texts are then read, each distinct one of
    an id once, so what the driver gets is bounded however often an id repeats.
    """
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("label")).where("label in (0, 1)")
    known = known.where(fold(F.col("doc_id"), folds) != held).distinct()
    short = docs.where(F.octet_length("text") <= TRAIN_BYTES)
    hashed = short.select("doc_id", F.xxhash64("text").alias("h"))
    labelled = hashed.join(known, "doc_id").distinct()
    chosen = []
    for label in (0, 1):
        rows = labelled.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id", "h").limit(TRAIN_ROWS)
        chosen += [(r["doc_id"], r["h"], r["label"]) for r in rows.collect()]
    if not chosen:
        return [], []
    wanted = short.where(F.col("doc_id").isin(list({i for i, _, _ in chosen}))).select("doc_id", "text", F.xxhash64("text").alias("h"))
    wanted = wanted.where(F.col("h").isin(list({h for _, h, _ in chosen})))
    texts = {(r["doc_id"], r["h"]): r["text"] for r in wanted.groupBy("doc_id", "h").agg(F.min("text").alias("text")).collect()}
    found = sorted((i, texts[i, h], label) for i, h, label in chosen)
    return [text for _, text, _ in found], [label for _, _, label in found]


def score_toxicity(docs: DataFrame, parameters: dict[str, np.ndarray]) -> DataFrame:
    """(doc_id, score) of every whole text; null counts as empty, repeated rows are scored separately."""
    shared = docs.sparkSession.sparkContext.broadcast(parameters)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words(shared.value)
        for part in row_slices(batches):
            logits = score_texts(known.p, part.column(1).to_pylist(), known)
            scores = 1.0 / (1.0 + np.exp(-np.clip(logits.astype(np.float64), -30, 30)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores)], ["doc_id", "score"])

    slim = docs.select("doc_id", text_or_empty().alias("text"))
    return slim.mapInArrow(score, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, score double")


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows scored 0.5 or more; all columns stay, repeated rows are judged alike.

    Without training texts of both classes there is no model, and every row is kept.
    Null and empty texts are scored as one empty window; an empty table gives no rows.
    Other columns pass through whatever their names.
    """
    texts, known_labels = training_texts(docs, labels)
    if len(set(known_labels)) < 2:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(train_toxicity(texts, known_labels))
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words(shared.value)
        for part in row_slices(batches):
            texts = [text or "" for text in part.column(at).to_pylist()]
            yield part.filter(pa.array(score_texts(known.p, texts, known) < 0))

    return docs.mapInArrow(keep, docs.schema)


def classify_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every document's toxicity.

    ``docs`` needs doc_id and text, ``labels`` doc_id and toxic; other columns
    are ignored. Returns doc_id, held_out, score and predicted. Empty texts are
    scored as one empty window. Without labels of both classes every score is
    0.5; an empty table gives no rows.
    """
    parameters = train_toxicity(*training_texts(docs, labels))
    return score_toxicity(docs, parameters).select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
