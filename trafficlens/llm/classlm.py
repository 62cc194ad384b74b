"""Brown class-based bigram model: exchange clustering of words, class transitions, word emissions.

The texts are read once and written as word numbers in chunks, each chunk with a
dictionary of its distinct words; from then on a word travels once per chunk and
not once per token. A word's evidence for its class is how often every hashed
context stands before and after it in training texts. Exchange rounds run over
that table: half of the words (by a hash) move to the class whose contexts
explain theirs best, with their own counts taken out of the class they are in;
only the class-by-context matrix, of fixed size, comes to the driver. Words seen
fewer than MIN_COUNT times form one class together with unknown words.

Counts, vocabulary and classes cover all training texts; nothing is sampled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, row_slices, table, text_or_empty, written

CLASSES = 64  # classes of frequent words
RARE, EDGE = CLASSES, CLASSES + 1  # rare and unknown words; begin and end of a text
MIN_COUNT = 5
CONTEXTS = 63  # hashed neighbours on each side, besides the edge of the text
SIDE = CONTEXTS + 1
CODES = 2 * SIDE
ROUNDS = 4
CHUNK_TOKENS = 6_000_000
COUNT_BITS = 9  # of a packed context count; the context code has the other 7
PRIOR = 20.0  # weight of the class frequency in a transition row
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


class Numbers(dict):
    """Number of each word in order of first sight, with its hashed context."""

    def __init__(self):
        super().__init__()
        self.contexts: list[int] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.contexts.append(zlib.crc32(word) % CONTEXTS)
        return number


def tokens(text: str) -> list[bytes]:
    """Words of a text, A-Z lowered, split at ASCII white space."""
    return text.encode("utf-8").translate(_LOWER).split()


def packed_contexts(word: np.ndarray, code: np.ndarray, count: np.ndarray, words: int) -> tuple[bytes, np.ndarray]:
    """Contexts as 16-bit values by word, and the byte at which each word's begin.

    A count too large for its bits is spread over several values.
    """
    most = (1 << COUNT_BITS) - 1
    times = -(-count // most)
    value = np.full(int(times.sum()), most, np.int64)
    value[np.cumsum(times) - 1] = count - (times - 1) * most
    packed = (np.repeat(code, times) << COUNT_BITS | value).astype("<u2")
    first = np.searchsorted(np.repeat(word, times), np.arange(words + 1)) * 2
    return packed.tobytes(), first


def pack_ids(ids: np.ndarray) -> bytes:
    """Numbers below 2**32 as four planes of bytes: the upper planes are nearly empty and compress away."""
    return np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unpack_ids(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def context_counts(numbers: Numbers, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of (word, context code) over training texts: words, codes and counts, by word."""
    if not texts:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    # An edge mark stands before and after every text.
    edge = np.array([len(numbers)], np.int32)
    padded = np.concatenate([part for t in texts for part in (edge, t)] + [edge])
    code = np.append(np.array(numbers.contexts, np.uint8), np.uint8(CONTEXTS))[padded]
    inner = padded[1:-1] != edge[0]
    wide = np.int32 if (len(numbers) + 1) * CODES < 1 << 31 else np.int64
    found = []
    # One side at a time: the keys of a side are the largest arrays of a chunk.
    for neighbours, first in ((code[:-2], 0), (code[2:], SIDE)):
        keys = padded[1:-1][inner].astype(wide)
        keys *= CODES
        keys += neighbours[inner]
        keys += first
        keys.sort()
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        found.append((keys[starts], np.diff(np.append(starts, len(keys)))))
    keys, counts = (np.concatenate(part) for part in zip(*found))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    return keys // CODES, keys % CODES, counts[order]


def encode_chunks(docs: DataFrame, held: Column) -> DataFrame:
    """Word numbers of every text (kind 0) and the dictionary of every chunk (kind 1), in one table.

    A chunk is a run of texts of one task of about CHUNK_TOKENS tokens. Dictionary
    rows carry the word's count in training texts and its context counts.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 24
        numbers, train, lengths = Numbers(), [], 0
        for part in row_slices(batches, 512):
            ids = [np.fromiter(map(numbers.__getitem__, w), np.int32) for w in map(tokens, part.column(2).to_pylist())]
            flags = part.column(1).to_pylist()
            train += [t for t, flag in zip(ids, flags) if not flag]
            lengths += sum(map(len, ids)) + len(ids)
            yield rows(part.num_rows, kind=np.zeros(len(ids), np.int32), chunk=np.full(len(ids), chunk), doc_id=part.column(0), held=part.column(1), ids=[pack_ids(t) for t in ids])
            if lengths >= CHUNK_TOKENS:
                yield from dictionary(chunk, numbers, train)
                chunk, numbers, train, lengths = chunk + 1, Numbers(), [], 0
        yield from dictionary(chunk, numbers, train)

    def dictionary(chunk: int, numbers: Numbers, train: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        packed, first = packed_contexts(*context_counts(numbers, train), len(numbers))
        total = np.bincount(np.concatenate(train), minlength=len(numbers)) if train else np.zeros(len(numbers), np.int64)
        words = list(numbers)
        for k in range(0, len(words), 50_000):
            some = words[k : k + 50_000]
            n = len(some)
            context = pa.Array.from_buffers(
                pa.binary(), n, [None, pa.py_buffer(first[k : k + n + 1].astype(np.int32).tobytes()), pa.py_buffer(packed)]
            )
            yield rows(n, kind=np.ones(n, np.int32), chunk=np.full(n, chunk), word=some, number=np.arange(k, k + n, dtype=np.int32), n=total[k : k + n], context=context)

    def rows(count: int, **columns) -> pa.RecordBatch:
        made = []
        for field in arrow:
            value = columns.get(field.name)
            if value is None:
                value = pa.nulls(count, field.type)
            elif field.name == "word":
                value = pa.array(value, pa.binary()).cast(pa.string())
            elif not isinstance(value, pa.Array):
                value = pa.array(value, field.type)
            made.append(value)
        return pa.RecordBatch.from_arrays(made, schema=arrow)

    slim = docs.select("doc_id", held.alias("held"), text_or_empty().alias("text"))
    kind = slim.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = pa.schema(
        [("kind", pa.int32()), ("chunk", pa.int64()), ("doc_id", to_arrow_type(kind)), ("held", pa.bool_())]
        + [("ids", pa.binary()), ("word", pa.string()), ("number", pa.int32()), ("n", pa.int64()), ("context", pa.binary())]
    )
    schema = (
        f"kind int, chunk bigint, doc_id {kind.simpleString()}, held boolean, ids binary, "
        "word string, number int, n bigint, context binary"
    )
    return written(slim.mapInArrow(encode, schema), "lm_chunks", "kind")


def _packed(vectors: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    codes, counts = [], []
    for v in vectors:
        at = np.flatnonzero(v)
        codes.append(at.astype(np.uint8).tobytes())
        counts.append(v[at].astype("<f4").tobytes())
    return codes, counts


def _dense(codes: list[bytes], counts: list[bytes]) -> np.ndarray:
    sizes = np.fromiter(map(len, codes), np.int64, len(codes))
    out = np.zeros((len(codes), CODES), np.float32)
    out[np.repeat(np.arange(len(codes)), sizes), np.frombuffer(b"".join(codes), np.uint8)] = np.frombuffer(
        b"".join(counts), "<f4"
    )
    return out


def vocabulary(chunks: DataFrame) -> DataFrame:
    """(word, c, codes, counts): training count of every word, contexts of those seen MIN_COUNT times.

    The rows of one word are one per chunk at most and are summed as they stream by.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_word, kept_n, kept = None, 0, np.zeros(CODES)
        for batch in batches:
            words = batch.column(0).to_numpy(zero_copy_only=False)
            n = batch.column(1).to_numpy()
            fresh = np.append(True, words[1:] != words[:-1]) if len(words) else np.zeros(0, bool)
            if not len(words):
                continue
            starts = np.flatnonzero(fresh)
            group = np.cumsum(fresh) - 1
            total = np.add.reduceat(n, starts)
            blobs = batch.column(2).to_pylist()
            sizes = np.fromiter((len(b) // 2 for b in blobs), np.int64, len(blobs))
            entry = np.frombuffer(b"".join(blobs), "<u2").astype(np.int64)
            names = words[starts]
            last = len(starts) - 1
            carries = kept_word is not None and names[0] == kept_word
            if kept_word is not None and not carries:
                yield out([kept_word], np.array([kept_n]), kept[None])
            wanted = total >= MIN_COUNT
            wanted[0] |= carries
            wanted[last] = True
            place = np.where(wanted, np.cumsum(wanted) - 1, -1)
            vectors = np.zeros((int(wanted.sum()), CODES))
            at = place[np.repeat(group, sizes)]
            some = at >= 0
            np.add.at(
                vectors,
                (at[some], entry[some] >> COUNT_BITS),
                (entry[some] & ((1 << COUNT_BITS) - 1)).astype(np.float64),
            )
            if carries:
                total[0] += kept_n
                vectors[0] += kept
            kept_word, kept_n, kept = names[last], int(total[last]), vectors[-1].copy()
            full = np.zeros((last, CODES)) if last <= 20_000 else None
            for k in range(0, last, 20_000):
                stop = min(last, k + 20_000)
                block = full[: stop - k] if full is not None else np.zeros((stop - k, CODES))
                use = np.flatnonzero(place[k:stop] >= 0)
                block[use] = vectors[place[k:stop][use]]
                yield out(names[k:stop], total[k:stop], block)
        if kept_word is not None:
            yield out([kept_word], np.array([kept_n]), kept[None])

    def out(words, n: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
        frequent = n >= MIN_COUNT
        codes, counts = [None] * len(n), [None] * len(n)
        for k, a, b in zip(np.flatnonzero(frequent), *_packed(vectors[frequent])):
            codes[k], counts[k] = a, b
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array(n, pa.int64()), pa.array(codes, pa.binary()), pa.array(counts, pa.binary())],
            ["word", "c", "codes", "counts"],
        )

    rows = chunks.where("kind = 1").select("word", "n", "context")
    dealt = rows.repartition("word").sortWithinPartitions("word")
    return written(dealt.mapInArrow(merge, "word string, c bigint, codes binary, counts binary"), "lm_vocabulary")


def assign(vectors: np.ndarray, halves: np.ndarray, matrices: list[np.ndarray]) -> np.ndarray:
    """Class of each word after the rounds so far; the first matrix holds the seeds' contexts."""
    current = np.zeros(len(vectors), np.int64)
    for turn, matrix in enumerate(matrices):
        smooth = matrix + 0.1
        total = smooth.sum(axis=1)
        gain = vectors @ (np.log(smooth) - np.log(total)[:, None]).T.astype(np.float32)
        if turn == 0:
            current = gain.argmax(axis=1)
            continue
        # In its own class a word's counts are taken out before they are explained.
        rest = np.maximum(smooth[current] - vectors, 0.1)
        own = (vectors * (np.log(rest) - np.log(rest.sum(axis=1))[:, None])).sum(axis=1)
        gain[np.arange(len(vectors)), current] = own
        moves = halves == turn % 2
        current = np.where(moves, gain.argmax(axis=1), current)
    return current


def exchange_classes(words: DataFrame) -> DataFrame:
    """(word, c, class): classes of all words after ROUNDS rounds, started from the CLASSES most frequent words."""
    frequent = words.where(F.col("codes").isNotNull())
    seeds = frequent.orderBy(F.desc("c"), "word").limit(CLASSES).collect()
    matrix = np.zeros((CLASSES, CODES))
    if seeds:
        found = _dense([r["codes"] for r in seeds], [r["counts"] for r in seeds]).astype(np.float64)
        # On one scale, so that a frequent seed is no likelier than another.
        matrix[: len(found)] = found / found.sum(axis=1, keepdims=True) * 1e4
        matrix[len(found) :] = -0.09
    matrices = [matrix]

    def classes_of(batch: pa.RecordBatch, history: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        vectors = _dense(batch.column("codes").to_pylist(), batch.column("counts").to_pylist())
        halves = np.fromiter((zlib.crc32(w.encode()) >> 7 & 1 for w in batch.column("word").to_pylist()), np.int64)
        return vectors, assign(vectors, halves, history)

    for _ in range(ROUNDS):
        history = list(matrices)

        def gather(batches: Iterator[pa.RecordBatch], history=history) -> Iterator[pa.RecordBatch]:
            total = np.zeros((CLASSES, CODES))
            for batch in batches:
                vectors, current = classes_of(batch, history)
                np.add.at(total, current, vectors)
            at = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at[0]), pa.array(at[1]), pa.array(total[at])], ["k", "code", "n"])

        sums = frequent.mapInArrow(gather, "k bigint, code bigint, n double").groupBy("k", "code").agg(F.sum("n").alias("n"))
        matrix = np.zeros((CLASSES, CODES))
        for row in sums.collect():  # at most CLASSES * CODES rows
            matrix[row["k"], row["code"]] = row["n"]
        matrices.append(matrix)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = np.full(batch.num_rows, RARE, np.int32)
            known = np.flatnonzero(~np.array(batch.column("codes").is_null()))
            if len(known):
                number[known] = classes_of(batch.take(pa.array(known)), matrices)[1]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("c"), pa.array(number)], ["word", "c", "class"])

    return words.mapInArrow(place, "word string, c bigint, class int")


def class_sequences(chunks: DataFrame, classes: DataFrame, train_texts: int) -> DataFrame:
    """Per text: counts, sums of log counts, and the sequence of its words' classes."""
    found = chunks.where("kind = 1").select("chunk", "number", "word").join(classes, "word").select("chunk", "number", "c", "class")
    kind = chunks.schema["doc_id"].dataType.simpleString()

    def look_up(texts: pa.Table, words: pa.Table) -> pa.Table:
        size = words.num_rows
        number = words.column("number").to_numpy()
        c, k = np.zeros(size, np.int64), np.zeros(size, np.uint8)
        c[number], k[number] = words.column("c").to_numpy(), words.column("class").to_numpy()
        base = np.log10(c + 0.1)
        emits = np.where(k == RARE, base, np.log10(np.maximum(c, 1)))
        ends = np.log10(train_texts + 0.1)
        out = {name: [] for name in ("n_tokens", "n_known", "base", "emits", "classes")}
        for blob in texts.column("ids").to_pylist():
            ids = unpack_ids(blob)
            out["n_tokens"].append(len(ids) + 1)
            out["n_known"].append(int((c[ids] > 0).sum()) + (train_texts > 0))
            out["base"].append(float(base[ids].sum() + ends))
            out["emits"].append(float(emits[ids].sum()))
            out["classes"].append(k[ids].tobytes())
        return pa.table({"doc_id": texts.column("doc_id"), "held": texts.column("held"), **out})

    texts = chunks.where("kind = 0").select("chunk", "doc_id", "held", "ids")
    schema = f"doc_id {kind}, held boolean, n_tokens bigint, n_known bigint, base double, emits double, classes binary"
    found = found.withColumnRenamed("chunk", "part")
    return written(texts.groupBy("chunk").cogroup(found.groupBy("part")).applyInArrow(look_up, schema), "lm_classes")


def transitions(sequences: DataFrame) -> np.ndarray:
    """Counts of class pairs in training texts, edges included: a matrix of fixed size."""
    width = CLASSES + 2

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width * width, np.int64)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                k = np.concatenate([[EDGE], np.frombuffer(blob, np.uint8), [EDGE]]).astype(np.int64)
                total += np.bincount(k[:-1] * width + k[1:], minlength=width * width)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pair", "n"])

    counted = sequences.where("not held").select("classes").mapInArrow(pairs, "pair bigint, n bigint")
    matrix = np.zeros(width * width)
    for row in counted.groupBy("pair").agg(F.sum("n").alias("n")).collect():  # at most width * width rows
        matrix[row["pair"]] = row["n"]
    return matrix.reshape(width, width)


def smoothed(pairs: np.ndarray) -> np.ndarray:
    """log10 of the transition probabilities: rows backed off to the class frequencies."""
    frequency = pairs.sum(axis=0) + 0.5
    frequency /= frequency.sum()
    return np.log10((pairs + PRIOR * frequency) / (pairs.sum(axis=1, keepdims=True) + PRIOR))


def score_texts(docs: DataFrame, held: Column) -> DataFrame:
    """Score every text with the model learnt from the rows that are not ``held``.

    ``docs`` needs doc_id and text; other columns are ignored. Returns doc_id,
    held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity.
    A null text is empty and has the end as its only token; repeated rows are
    scored separately and each counts in training. Without training texts all
    words are unknown. An empty table gives no rows.
    """
    chunks = encode_chunks(docs, held)
    words = vocabulary(chunks)
    train_texts = chunks.where("kind = 0 and not held").count()
    totals = words.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("tokens"),
        F.count(F.when(F.col("c") > 0, 1)).alias("words"),
        F.count(F.when((F.col("c") > 0) & (F.col("c") < MIN_COUNT), 1)).alias("rare"),
    ).first()
    train_tokens = int(totals["tokens"]) + train_texts
    distinct = int(totals["words"]) + (train_texts > 0)
    sequences = class_sequences(chunks, exchange_classes(words), train_texts)
    pairs = transitions(sequences)
    moves = smoothed(pairs)
    size = pairs.sum(axis=0)
    # log10 of what a word's count is divided by; the end is the only word of its class.
    divisor = np.log10(np.maximum(size, 1))
    divisor[RARE] = np.log10(size[RARE] + 0.1 * (int(totals["rare"]) + 1))
    divisor[EDGE] = 0.0
    cost = moves - divisor[None, :]
    floor = float(np.log10(train_tokens + 0.1 * (distinct + 1)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            emits = batch.column("emits").to_numpy()
            total = np.zeros(batch.num_rows)
            for row, blob in enumerate(batch.column("classes").to_pylist()):
                k = np.concatenate([[EDGE], np.frombuffer(blob, np.uint8), [EDGE]]).astype(np.int64)
                total[row] = cost[k[:-1], k[1:]].sum() + emits[row]
            n = batch.column("n_tokens").to_numpy()
            base = batch.column("base").to_numpy() - n * floor
            columns = [batch.column(name) for name in ("doc_id", "held", "n_tokens", "n_known")]
            more = [pa.array(np.full(len(n), train_tokens)), pa.array(base), pa.array(total), pa.array(10 ** (-total / n))]
            yield pa.RecordBatch.from_arrays([*columns, *more], names)

    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]
    kind = sequences.schema["doc_id"].dataType.simpleString()
    return sequences.mapInArrow(
        score,
        f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double, perplexity double",
    )


def op4_classlm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(fold(F.col("doc_id"), 10) == 0, F.lit(False))
    return score_texts(table(spark, sf_dir, "documents"), held)
