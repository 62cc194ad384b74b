"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

The CGK random walk reads a sequence of words: at every step it writes the word
under its pointer and moves on or stays, by a random bit of that word and step.
Two sequences a few edits apart fall back in step, so their written sequences
have a small Hamming distance. A table of the LSH compares SAMPLES positions of
the written sequence; TABLES tables with walks of their own, and three anchors
inside each item, give the recall. A window starts at every word of every text,
and a walk never leaves an item-sized window: an item of n words is looked up
with the deepest walk of at most n steps. Items of at most 25 words have the
first anchor only, and a walk needs whole words; what walks miss is found by
pieces of characters: all pieces of every item are looked up at every character
of every text, and pieces that put the item's start in nearly the same place vote
for it, wherever in the item the edits are. Windows that agree with an item in one
table, or that have the votes, are verified by exact edit distance on characters.

The benchmark is the query set. It is read in blocks of at most BLOCK_BYTES,
each broadcast on its own; documents are scanned once for each block, never shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pieces, row_slices, table, text_or_empty

TABLES = 10
SAMPLES = 6  # positions compared by a table, one in each equal part of the walk
DEPTHS = (24, 18, 12, 6, 3, 1)  # steps of a walk, by the words an item has
SIMILARITY = 0.8  # 1 - edit distance / characters of the item
REPEATS = 4  # places of one piece that an item keeps: a run of one character would otherwise match itself everywhere
MATCHES_AT_ONCE = 1 << 20  # votes held in memory together
TINY = 24  # items of fewer characters: one of the pieces between the allowed edits must be whole, so one vote is enough
BLOCK_BYTES = 8 << 20
DOCS_AT_ONCE = 128
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def normal(text: str) -> list[bytes]:
    """Words of a text, lower case, split at ASCII white space."""
    return text.lower().encode("utf-8").split()


def plain(text: str) -> str:
    """The words of a text with one space between them."""
    return b" ".join(normal(text)).decode("utf-8")


_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True
#: A random value for every byte at every place (modulo 64) of a word.
_BYTES = np.random.default_rng(11).integers(0, 1 << 64, (64, 256), np.uint64).ravel()


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash of every word of all texts, the number of words of each, and where each text's words begin."""
    data = [text.lower().encode("utf-8") for text in texts]
    raw = np.frombuffer(b" " + b" ".join(data) + b" ", np.uint8)
    space = _SPACE[raw]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    inside = np.flatnonzero(~space)
    lengths = ends - starts
    place = np.arange(len(inside)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    values = _BYTES[(place & 63) << 8 | raw[inside]]
    hashes = np.add.reduceat(values, np.cumsum(lengths) - lengths) if len(lengths) else np.zeros(0, np.uint64)
    text_ends = np.cumsum([len(d) + 1 for d in data]) + 1
    first = np.searchsorted(starts, np.append(1, text_ends))
    return hashes | np.uint64(1), np.diff(first), first[:-1]


def sampled_steps(depth: int) -> list[list[int]]:
    """Sampled steps of every table for walks of ``depth`` steps, rising."""
    random = np.random.default_rng(depth)
    parts = np.array_split(np.arange(depth), min(SAMPLES, depth))
    return [[int(random.choice(part)) for part in parts] for _ in range(TABLES)]


def walk_bits(hashes: np.ndarray, number: int) -> np.ndarray:
    """Random bits of each word in table ``number``: bit 16 + j decides step j."""
    mixed = (hashes ^ hashes >> np.uint64(29)) * np.uint64(int(_ODD[0]) * (2 * number + 1) % (1 << 64))
    return mixed ^ mixed >> np.uint64(32)


def walk_keys(hashes: np.ndarray, bits: np.ndarray, at: np.ndarray, step: int, steps: list[int]) -> np.ndarray:
    """Keys of walks that stand at ``at`` before step ``step``, from the words written at ``steps``."""
    at = at.copy()
    key = np.zeros(len(at), np.uint64)
    for k, wanted in enumerate(steps):
        while step < wanted:
            at += (bits[at] >> np.uint64(16 + step)).astype(np.int64) & 1
            step += 1
        key += hashes[at] * _ODD[k]
    return key


def build_index(items: list[tuple[object, str]]) -> dict:
    """Keys of every item by walk depth and table, as plain arrays."""
    hashes, sizes, starts = padded_hashes([text for _, text in items])
    entries = defaultdict(list)
    for number, n in enumerate(sizes.tolist()):
        for offset in sorted({0, n // 3, 2 * n // 3}):
            left = n - offset
            if left >= min(n, DEPTHS[1]) and left:
                entries[next(d for d in DEPTHS if d <= left)].append((number, offset))
    due = [defaultdict(list) for _ in range(TABLES)]
    for depth, rows in entries.items():
        number, offset = np.array(rows).T
        at = starts[number] + offset
        for t, steps in enumerate(sampled_steps(depth)):
            bits = walk_bits(hashes, t)
            first = walk_keys(hashes, bits, at, 0, steps[:1])
            keys = walk_keys(hashes, bits, at, 0, steps)
            order = np.argsort(keys, kind="stable")
            due[t][steps[0]].append((steps, _present(first, 16), _present(keys, 20), keys[order], number[order], offset[order]))
    texts = [plain(text) for _, text in items]
    return {
        "ids": [i for i, _ in items],
        "texts": texts,
        "pieces": piece_index(texts),
        "words": sizes.tolist(),
        "due": [dict(steps) for steps in due],
    }


def _present(keys: np.ndarray, bits: int) -> np.ndarray:
    """Which values the upper bits of some key have."""
    table = np.zeros(1 << bits, bool)
    table[(keys >> np.uint64(64 - bits)).astype(np.int64)] = True
    return table


def padded_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes with a walk's length of zeros behind every text; sizes and begins of the texts."""
    words, sizes, first = word_hashes(texts)
    pad = DEPTHS[0]
    begins = first + pad * np.arange(len(texts))
    hashes = np.zeros(len(words) + pad * max(1, len(texts)), np.uint64)
    hashes[np.arange(len(words)) + np.repeat(begins - first, sizes)] = words
    return hashes, sizes, begins


def candidates(hashes: np.ndarray, starts: np.ndarray, index: dict) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (window start of the whole item, item number) that agree in some table."""
    found = []
    for t, due in enumerate(index["due"]):
        bits = walk_bits(hashes, t)
        at = starts.copy()
        for step in range(max(due, default=-1) + 1):
            if step in due:
                prefix = (hashes[at] * _ODD[0] >> np.uint64(48)).astype(np.int64)
                some = np.flatnonzero(np.logical_or.reduce([first for _, first, *_ in due[step]])[prefix])
            for steps, first, whole, keys, number, offset in due.get(step, ()):
                here = some[first[prefix[some]]]
                key = walk_keys(hashes, bits, at[here], step, steps)
                likely = np.flatnonzero(whole[(key >> np.uint64(44)).astype(np.int64)])
                low, high = np.searchsorted(keys, key[likely], "left"), np.searchsorted(keys, key[likely], "right")
                many = high - low
                entry = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())
                where = np.repeat(starts[here[likely]], many)
                found.append(np.column_stack([where - offset[entry], number[entry]]))
            at += (bits[at] >> np.uint64(16 + step)).astype(np.int64) & 1
    both = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
    return both[:, 0], both[:, 1]


def allowed(length: int) -> int:
    """Edits an item of ``length`` characters may have."""
    return int((1 - SIMILARITY) * length + 1e-9)


def piece_rule(length: int) -> tuple[int, int]:
    """Characters of a piece, and votes needed, for an item of ``length`` characters."""
    if length < TINY:
        return max(1, length // (allowed(length) + 1)), 1
    return (6, 2) if length < 64 else (8, max(length // 20, 4))


def piece_hashes(text: str, size: int) -> np.ndarray:
    """64-bit hash of the ``size`` characters at every place of ``text``."""
    code = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    code = (code + np.uint64(1)) * _ODD[1]
    code ^= code >> np.uint64(31)
    total = np.zeros(max(0, len(code) - size + 1), np.uint64)
    for k in range(size):
        total *= _ODD[2]
        total += code[k : k + len(total)]
    total ^= total >> np.uint64(29)
    total *= _ODD[0]
    return total ^ total >> np.uint64(32)


def kept_places(hashes: np.ndarray) -> np.ndarray:
    """Places of an item's pieces, of a piece with more than REPEATS places REPEATS spread ones with the first and last."""
    order = np.argsort(hashes, kind="stable")
    begins = np.flatnonzero(np.append(True, hashes[order][1:] != hashes[order][:-1])) if len(order) else order
    counts = np.diff(np.append(begins, len(order)))
    if not len(order) or counts.max() <= REPEATS:
        return np.arange(len(hashes))
    spread = [b + np.unique(np.linspace(0, c - 1, min(c, REPEATS)).astype(np.int64)) for b, c in zip(begins, counts)]
    return np.sort(order[np.concatenate(spread)])


def piece_index(texts: list[str]) -> dict:
    """The pieces of all items by size, in order of their hashes, with item number and place.

    An item that leaves out places of repeated pieces needs as much fewer votes.
    """
    rules = [piece_rule(len(text)) for text in texts]
    rows = defaultdict(list)
    votes = []
    for number, (text, (size, need)) in enumerate(zip(texts, rules)):
        hashes = piece_hashes(text, size)
        places = kept_places(hashes)
        rows[size].append((hashes[places], places, number))
        votes.append(max(min(need, 2), -(-need * len(places) // max(1, len(hashes)))))
    tables = {}
    for size, parts in rows.items():
        keys = np.concatenate([k for k, _, _ in parts])
        number = np.repeat(np.array([n for _, _, n in parts], np.int64), [len(k) for k, _, _ in parts])
        place = np.concatenate([p for _, p, _ in parts])
        order = np.argsort(keys, kind="stable")
        keys, number, place = keys[order], number[order], place[order]
        bits = max(16, len(keys).bit_length() + 3)
        filled = np.zeros(1 << bits, bool)
        filled[(keys >> np.uint64(64 - bits)).astype(np.int64)] = True
        rank = np.append(0, np.cumsum(keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        ends = np.cumsum(np.bincount(rank))[rank] if len(keys) else rank
        # Equal keys stand in order of their items, so (rank, item) rises.
        tables[size] = (bits, filled, keys, ends, number, place, rank << 32 | number)
    lengths = np.array([len(text) for text in texts], np.int64)
    drift = np.array([max(8, allowed(len(text)) // 2) for text in texts], np.int64)
    return {"tables": tables, "length": lengths, "drift": drift, "votes": np.array(votes, np.int64)}


def _slices(at: np.ndarray, many: np.ndarray, reach: int) -> Iterator[slice]:
    """Runs of places with about MATCHES_AT_ONCE matches or 2 x ``reach`` characters, each from ``reach`` before the last one's end."""
    until = np.cumsum(many)
    begin = 0
    while begin < len(at):
        full = np.searchsorted(until, until[begin] - many[begin] + MATCHES_AT_ONCE, "right")
        end = max(int(full), int(np.searchsorted(at, at[begin] + 2 * reach, "right")))
        yield slice(begin, end)
        if end >= len(at):
            return
        begin = int(np.searchsorted(at, at[end] - reach, "left"))


def _by_items(at, low, high, ranked: np.ndarray, first: int, last: int) -> Iterator[tuple]:
    """The matches of some places, halved by item number while there are more than MATCHES_AT_ONCE."""
    some = np.flatnonzero(high > low)
    at, low, high = at[some], low[some], high[some]
    if (high - low).sum() <= MATCHES_AT_ONCE or last - first <= 1:
        yield at, low, high
        return
    middle = (first + last) // 2
    cut = np.searchsorted(ranked, (ranked[low] >> 32 << 32) | middle)
    cut = np.clip(cut, low, high)
    yield from _by_items(at, low, cut, ranked, first, middle)
    yield from _by_items(at, cut, high, ranked, middle, last)


def voted(texts: list[str], index: dict) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, first, last): the item may start in the text about the characters first to last.

    ``texts`` are plain. A run of places each within the item's drift (half the allowed edits) of
    the one before is one candidate. Votes are taken slice by slice, so memory is bounded
    whatever repeats in texts and items; a candidate near a slice's end may come twice.
    """
    lengths, drift, votes = index["length"], index["drift"], index["votes"]
    joined = "\n".join(texts)  # no piece of an item has a line break
    begins = np.cumsum([0] + [len(text) + 1 for text in texts])[:-1]
    gap = int((lengths + drift).max(initial=0)) + 1
    spread = begins + np.arange(len(texts)) * gap
    mask = (1 << 40) - 1
    for size, (bits, filled, keys, ends, number, place, ranked) in index["tables"].items():
        if not len(keys):
            continue
        hashes = piece_hashes(joined, size)
        at = np.flatnonzero(filled[(hashes >> np.uint64(64 - bits)).astype(np.int64)])
        low = np.minimum(np.searchsorted(keys, hashes[at], "left"), len(keys) - 1)
        some = np.flatnonzero(keys[low] == hashes[at])
        at, low = at[some], low[some]
        high = ends[low]
        parts = (
            part
            for s in _slices(at, high - low, gap + size)
            for part in _by_items(at[s], low[s], high[s], ranked, 0, len(lengths))
        )
        for here, begin, end in parts:
            many = end - begin
            entry = np.repeat(begin - (np.cumsum(many) - many), many) + np.arange(many.sum())
            here = np.repeat(here, many)
            # Texts are gap characters apart, so a start before its text is told from one in the text before.
            owner = np.searchsorted(begins, here, "right")
            vote = np.sort((number[entry] << 40) + here + owner * gap - place[entry])
            item = vote >> 40
            last = np.arange(len(vote)) + votes[item] - 1
            full = np.flatnonzero(last < len(vote))
            full = full[vote[last[full]] - vote[full] <= drift[item[full]]]
            if not len(full):
                continue
            start, item, until = vote[full], item[full], vote[last[full]]
            cut = np.flatnonzero(start[1:] - start[:-1] > drift[item[1:]]) + 1
            head, tail = np.append(0, cut), np.append(cut, len(start)) - 1
            text = np.searchsorted(spread, start[head] & mask, "right") - 1
            shift = spread[text] + gap
            yield from zip(
                text.tolist(), item[head].tolist(), ((start[head] & mask) - shift).tolist(), ((until[tail] & mask) - shift).tolist()
            )


def triples(text: str) -> np.ndarray:
    """Three characters at every place of ``text`` as one number."""
    code = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    return code[:-2] | code[1:-1] << np.uint64(21) | code[2:] << np.uint64(42)


def possible(pattern: str, region: str, lead: int, shifts: int) -> bool:
    """Whether ``pattern`` can be within its allowed edits at shifts 0 to ``shifts`` - 1, the region standing ``lead`` characters in.

    An edit changes three triples at most, so the others stand in the region
    within these shifts: no match is refused.
    """
    least = len(pattern) - 2 - 3 * allowed(len(pattern))
    if least <= 0 or shifts * len(pattern) > MATCHES_AT_ONCE or pattern in region:
        return True
    want = triples(pattern)
    have = np.zeros(len(want) + shifts - 1, np.uint64)
    some = triples(region)[: max(0, len(have) - lead)]
    have[lead : lead + len(some)] = some
    windows = np.lib.stride_tricks.sliding_window_view(have, shifts)
    return int((windows == want[:, None]).any(axis=1).sum()) >= least


def best_distance(pattern: str, text: str) -> int:
    """Smallest edit distance between ``pattern`` and any substring of ``text``."""
    return best_match(pattern, text)[0]


def best_match(pattern: str, text: str) -> tuple[int, int]:
    """Smallest edit distance of any substring of ``text``, by bit-parallel columns, and where the first such one begins.

    The begin is the item's length before its end, so it is off by at most the distance.
    """
    where_exact = text.find(pattern)
    if where_exact >= 0:
        return 0, where_exact
    m, end = len(pattern), 0
    where = defaultdict(int)
    for k, c in enumerate(pattern):
        where[c] |= 1 << k
    full, last = (1 << m) - 1, 1 << (m - 1)
    more, less, score, best = full, 0, m, m
    for k, c in enumerate(text, 1):
        same = where.get(c, 0)
        vertical = same | less
        across = (((same & more) + more) ^ more) | same
        up = less | (full & ~(across | more))
        down = more & across
        score += bool(up & last) - bool(down & last)
        if score < best:
            best, end = score, k
        up, down = up << 1 & full, down << 1 & full
        more = down | (full & ~(vertical | up))
        less = up & vertical
    return best, max(0, end - m)


def least_match(pattern: str, text: str, known: tuple[int, int]) -> tuple[int, int]:
    """The least distance and its begin in the whole ``text``, given a match ``known``.

    A match of fewer than d edits leaves one of d parts of the pattern intact, near
    the part's place; only around such parts distances are taken.
    """
    parts = known[0]
    if not parts:
        return 0, text.find(pattern)
    edges = [len(pattern) * k // parts for k in range(parts + 1)]
    regions = []
    for a, b in zip(edges, edges[1:]):
        at = text.find(pattern[a:b]) if b > a else -1
        while at >= 0:
            regions.append((max(0, at - a - parts), at - a + len(pattern) + parts))
            at = text.find(pattern[a:b], at + 1)
    joined: list[tuple[int, int]] = []
    for begin, end in sorted(regions):
        if joined and begin <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(joined[-1][1], end))
        else:
            joined.append((begin, end))
    best = known
    for begin, end in joined:
        distance, at = best_match(pattern, text[begin:end])
        if distance < best[0]:
            best = distance, begin + at
    return best


def matches(texts: list[str], index: dict, least: bool = True) -> list[list[tuple[int, int, int]]]:
    """For each text its verified items: (item number, distance, word at which the match begins).

    ``least`` gives each item's least distance in the whole text; else the first match found is
    enough. A begin is the item's length before the match's end.
    """
    whole = [plain(text) for text in texts]
    found: list[dict[int, tuple[int, int]]] = [{} for _ in texts]
    for doc, k, first, last in _likely(texts, whole, index):
        if k in found[doc]:
            continue
        pattern = index["texts"][k]
        slack = allowed(len(pattern))
        begin = max(0, first - slack)
        region = whole[doc][begin : max(0, last + len(pattern) + 2 * slack)]
        if len(region) < len(pattern) - slack or not possible(
            pattern, region, max(0, slack - first), last - first + 2 * slack + 1
        ):
            continue
        distance, at = best_match(pattern, region)
        if distance <= slack:
            found[doc][k] = (distance, begin + at)
    for doc, hits in enumerate(found):
        for k, known in hits.items():
            if least:
                known = least_match(index["texts"][k], whole[doc], known)
            hits[k] = known[0], whole[doc].count(" ", 0, max(0, known[1]))
    return [[(k, *v) for k, v in sorted(one.items())] for one in found]


def _likely(texts: list[str], whole: list[str], index: dict) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, first, last) of the windows that agree in a table of the walks, and of those with the votes.

    A window is given by the characters of the plain text between which the item may start.
    """
    hashes, sizes, begins = padded_hashes(texts)
    starts = np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    where, item = candidates(hashes, starts, index)
    places: dict[int, np.ndarray] = {}
    # An anchor deep in an item may put the item's start before the text: the text before is tried, then this one.
    owner = np.searchsorted(begins, where + DEPTHS[0] // 2, "right") - 1
    for o, w, k in zip(owner.tolist(), where.tolist(), item.tolist()):
        for doc in {max(0, o), min(len(texts) - 1, max(0, o) + 1)}:
            words = int(sizes[doc])
            if not words:
                continue
            if doc not in places:  # where each word of the plain text begins
                code = np.frombuffer(whole[doc].encode("utf-32-le", "surrogatepass"), "<u4")
                places[doc] = np.append(np.append(0, np.flatnonzero(code == 32) + 1), len(whole[doc]) + 1)
            first = w - int(begins[doc])
            slack = index["words"][k] // 4 + 2
            if first - slack >= words or first + index["words"][k] + slack <= 0:
                continue
            low, high = min(max(0, first - slack), words - 1), min(max(0, first + slack), words - 1)
            yield doc, k, int(places[doc][low]), int(places[doc][high])
    yield from voted(whole, index["pieces"])


def benchmark_blocks(benchmark: DataFrame) -> Iterator[list[tuple[object, str]]]:
    """The items with words, in blocks of about BLOCK_BYTES, each collected on its own."""
    items = benchmark.select("item_id", text_or_empty().alias("text")).where(F.trim("text") != "")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    blocks = pieces(int(total), BLOCK_BYTES)
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield [(r["item_id"], r["text"]) for r in part.orderBy("item_id", "text").collect()]


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document row and benchmark item found in it.

    ``docs`` needs doc_id and text, ``benchmark`` item_id and text; other columns
    are ignored. Returns doc_id, item_id, distance (characters, the least in the
    whole text), similarity and first_word (the word an item's length before the match's end). Null and empty texts hold nothing, items without words are
    found nowhere, repeated rows are reported separately, items with equal texts
    are each reported. Empty tables give no rows.
    """
    spark = docs.sparkSession
    slim = docs.select("doc_id", text_or_empty().alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_kind}, distance int, similarity double, first_word bigint"
    out = spark.createDataFrame([], schema)
    for items in benchmark_blocks(benchmark):
        shared = spark.sparkContext.broadcast(build_index(items))

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for part in row_slices(batches, DOCS_AT_ONCE):
                found = matches(part.column(1).to_pylist(), index)
                rows = [(d, *hit) for d, hits in enumerate(found) for hit in hits]
                if not rows:
                    continue
                row, item, distance, first = map(list, zip(*rows))
                near = [1 - x / len(index["texts"][i]) for x, i in zip(distance, item)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(row)),
                        pa.array([index["ids"][i] for i in item]),
                        pa.array(distance, pa.int32()),
                        pa.array(near, pa.float64()),
                        pa.array(first, pa.int64()),
                    ],
                    ["doc_id", "item_id", "distance", "similarity", "first_word"],
                )

        out = out.unionByName(slim.mapInArrow(find, schema))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows in which a benchmark item is found; all columns stay.

    Null and empty texts are kept, repeated rows are judged alike; an empty benchmark
    keeps all rows, an empty table gives no rows. Other columns pass through whatever their names.
    """
    spark = docs.sparkSession
    at = docs.columns.index("text")
    for items in benchmark_blocks(benchmark):
        shared = spark.sparkContext.broadcast(build_index(items))

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for part in row_slices(batches, DOCS_AT_ONCE):
                texts = [t or "" for t in part.column(at).to_pylist()]
                yield part.filter(pa.array([not hits for hits in matches(texts, index, least=False)], pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
