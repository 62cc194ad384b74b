"""Byte-level BPE encoding and decoding with a two-tier lookup.

A pre-token that is itself a vocabulary entry is resolved by a minimal perfect
hash (one displacement, one slot, one comparison). Every other pre-token is
merged by a heap of candidate pairs over a linked list of its bytes, lowest rank
first and leftmost among equals. The tables are built once on the driver from
the rank file and broadcast; their size is that of the vocabulary.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import row_slices, table, text_or_empty

#: Distinct pre-tokens a Python worker remembers before it starts afresh.
REMEMBERED = 300_000
LONGEST_REMEMBERED = 256  # bytes of a pre-token that is remembered at all, so that the memory has a bound in bytes
BATCH_BYTES = 2 << 20  # ids per Arrow batch sent back


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    return [ranks[k] for k in range(len(ranks))]


def _slot(h: int, displacement: int, n: int) -> int:
    return ((h >> 17) ^ (displacement * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFF)) % n


def perfect_hash(keys: list[bytes]) -> tuple[list[int], list[int]]:
    """Displacements by bucket and key number by slot: a minimal perfect hash of distinct keys.

    Crowded buckets are placed first by trying displacements; a bucket of one
    key stores the number of a free slot (as its negative) instead.
    """
    n = len(keys)
    buckets: dict[int, list[int]] = {}
    hashes = [xxhash.xxh3_64_intdigest(key) for key in keys]
    for number, h in enumerate(hashes):
        buckets.setdefault(h % n, []).append(number)
    displacements, owners = [0] * n, [-1] * n
    free = n - 1
    for bucket, numbers in sorted(buckets.items(), key=lambda item: -len(item[1])):
        if len(numbers) == 1:
            while owners[free] >= 0:
                free -= 1
            owners[free] = numbers[0]
            displacements[bucket] = -free - 1
            continue
        displacement = 0
        while True:
            slots = [_slot(hashes[k], displacement, n) for k in numbers]
            if len(set(slots)) == len(slots) and all(owners[s] < 0 for s in slots):
                break
            displacement += 1
        displacements[bucket] = displacement
        for k, s in zip(numbers, slots):
            owners[s] = k
    return displacements, owners


def merge_bytes(piece: bytes, rank_of: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token by repeated merging of the lowest-ranked adjacent pair."""
    n = len(piece)
    end = list(range(1, n + 1))  # end[i]: where the live node that starts at i ends; 0 once merged away
    before = list(range(-1, n - 1))
    get = rank_of.get
    heap = []
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            heap.append((rank, i, i + 2))
    heapq.heapify(heap)
    while heap:
        _, start, stop = heapq.heappop(heap)
        middle = end[start]
        if not middle or middle >= n or end[middle] != stop or middle >= stop:
            continue
        end[start], end[middle] = stop, 0
        if stop < n:
            before[stop] = start
            rank = get(piece[start : end[stop]])
            if rank is not None:
                heapq.heappush(heap, (rank, start, end[stop]))
        left = before[start]
        if left >= 0:
            rank = get(piece[left:stop])
            if rank is not None:
                heapq.heappush(heap, (rank, left, stop))
    ids, i = [], 0
    while i < n:
        ids.append(rank_of[piece[i : end[i]]])
        i = end[i]
    return ids


class PreTokens(dict):
    """Packed little-endian ids by pre-token, resolved on first sight."""

    def __init__(self, tokens: list[bytes], displacements: list[int], owners: list[int]):
        super().__init__()
        self.tokens, self.displacements, self.owners = tokens, displacements, owners
        self.rank_of = {token: rank for rank, token in enumerate(tokens)}

    def whole(self, piece: bytes) -> int:
        """Rank of a piece that is a vocabulary entry, else -1."""
        n = len(self.tokens)
        h = xxhash.xxh3_64_intdigest(piece)
        displacement = self.displacements[h % n]
        slot = -displacement - 1 if displacement < 0 else _slot(h, displacement, n)
        rank = self.owners[slot]
        return rank if self.tokens[rank] == piece else -1

    def __missing__(self, word: str) -> bytes:
        piece = word.encode("utf-8")
        rank = self.whole(piece)
        ids = [rank] if rank >= 0 else merge_bytes(piece, self.rank_of)
        packed = np.array(ids, "<u4").tobytes()
        if len(piece) <= LONGEST_REMEMBERED:
            self[word] = packed
        return packed


def encode_text(text: str, find, known: PreTokens) -> bytes:
    if len(known) > REMEMBERED:
        known.clear()
    return b"".join(map(known.__getitem__, find(text)))


def speller(tokens: list[bytes]):
    """A function from packed ids to the bytes that they stand for."""
    spelled = tokens.__getitem__
    return lambda ids: b"".join(map(spelled, np.frombuffer(ids, "<u4").tolist()))


def encode_documents(
    docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = (), decode: bool = False
) -> DataFrame:
    """(doc_id, kept columns, ids): token ids of every whole text as little-endian unsigned 32-bit integers.

    ``docs`` needs ``doc_id`` and ``text``; of its other columns only those in
    ``keep`` stay. A null or empty text has empty ids. Repeated rows are encoded
    separately. No special tokens are recognised: their spelling is ordinary text.
    With ``decode`` the bytes that the ids stand for follow as ``decoded``, as
    :func:`decode_documents` gives them, without a second pass of the ids through Python.
    """
    tokens = read_ranks(path)
    shared = docs.sparkSession.sparkContext.broadcast((tokens, *perfect_hash(tokens)))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, find = PreTokens(*shared.value), regex.compile(pattern).findall
        spell = speller(known.tokens)
        for batch in row_slices(batches):
            for part, packed in _sized(batch, 0, lambda text: encode_text(text, find, known)):
                made = [packed, list(map(spell, packed))] if decode else [packed]
                columns = [pa.array(values, pa.binary()) for values in made]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *columns], names)

    slim = docs.select(text_or_empty().alias("__whole_text"), "doc_id", *keep)
    names = ["doc_id", *keep, "ids", *(["decoded"] if decode else [])]
    return slim.mapInArrow(encode, _schema(slim, ["doc_id", *keep], "ids binary" + ", decoded binary" * decode))


def _schema(frame: DataFrame, names: list[str], more: str) -> str:
    return ", ".join(f"`{n}` {frame.schema[n].dataType.simpleString()}" for n in names) + ", " + more


def _sized(batch: pa.RecordBatch, at: int, convert) -> Iterable[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of a batch with column ``at`` converted, each of about BATCH_BYTES at most."""
    first, held, packed = 0, 0, []
    column = batch.column(at)
    for k in range(batch.num_rows):
        packed.append(convert(column[k].as_py()))
        held += len(packed[-1])
        if held >= BATCH_BYTES:
            yield batch.slice(first, k + 1 - first), packed
            first, held, packed = k + 1, 0, []
    if packed:
        yield batch.slice(first), packed


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with a column of the bytes that its column ``ids`` stands for, ``decoded``."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_ranks(path))
    at = encoded.columns.index("ids")
    names = [*encoded.columns, "decoded"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spell = speller(shared.value)
        for batch in row_slices(batches):
            for part, decoded in _sized(batch, at, spell):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(decoded, pa.binary())], names)

    return encoded.mapInArrow(decode, _schema(encoded, encoded.columns, "decoded binary"))


def digests() -> list:
    """n_tokens, ids_sha256 and decoded_sha256 of an encoded and decoded frame."""
    return [
        F.floor(F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    ]


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    both = encode_documents(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, decode=True)
    return both.select("doc_id", *digests())
