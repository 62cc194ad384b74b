"""Vector code compression: product codes by k-means with Drake-Hamerly adaptive distance bounds.

A vector's components become integers; it is cut into PARTS consecutive parts,
and every part position has a codebook of at most ENTRIES entries. Between the
rounds each part keeps its ``b + 1`` closest entries, an upper bound on the
distance to the first, a lower bound on the distance to each other one, and one
outer lower bound for all entries that are not kept. When the codebooks move,
bounds move by at most the entries' drift. A part whose upper bound stays under
all lower bounds keeps its entry without a distance being taken. In the others
only the entries up to the first bound that lies above are compared, by exact
integer squared distances; where none does, all entries are. Bounds are rounded
outwards, so a case is only settled by them when it is strict, and every tie is
decided in integers, to the lower index. ``b`` starts at a quarter of the entries
and shrinks to what the uncertain parts of the last round have used.

Rows never meet: a round is one map over the stored state and one sum per part
position and entry. The state is a Parquet table in the shared folder, replaced
by the next round's, so a lost executor repeats at most its share of one round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.session import shared_path

from .common import row_slices, table

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
LARGEST = 1 << 24  # scaled components from here on are refused, and more than WIDEST of them: squared distances must fit a long
WIDEST = 8191
FAR = 1e30  # lower bound of no entry
COVERED = 0.99  # share of the uncertain parts that the kept bounds should serve
ROWS_AT_ONCE = 4096


@dataclass(frozen=True)
class Codebooks:
    """Entries by part position (parts, entries, width), and how far each moved in the last round."""

    entries: np.ndarray
    drift: np.ndarray

    def moved(self, sums: dict[tuple[int, int], tuple[int, list[int]]]) -> Codebooks:
        """Entries replaced by floor(sum / count) of their parts; an unused entry stays."""
        after = self.entries.copy()
        for (part, entry), (count, total) in sums.items():
            after[part, entry] = [s // count for s in total]
        return Codebooks(after, np.sqrt(((after - self.entries) ** 2).sum(axis=2).astype(np.float64)))

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


# ------------------------------------------------------------------ vectors --


def _fixed(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as an Arrow binary array."""
    rows = np.ascontiguousarray(rows)
    width = rows.nbytes // max(1, len(rows))
    offsets = (np.arange(len(rows) + 1, dtype=np.int64) * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())])


def _matrix(column: pa.Array, kind, width: int) -> np.ndarray:
    """The binary values of a column, ``width`` numbers each, as a matrix."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if len(column) else b""
    return np.frombuffer(data, kind).reshape(len(column), width)


def scaled(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kept rows of a list column, the length of each row, and all components of the kept rows as integers.

    A row is kept when its vector is not null and has neither null nor non-finite components.
    """
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    owner = np.repeat(np.arange(len(lists)), lengths)
    broken = np.bincount(owner[~np.isfinite(values)], minlength=len(lists)) > 0
    keep = ~broken & lists.is_valid().to_numpy(zero_copy_only=False)
    whole = np.floor(SCALE * values[keep[owner]])
    if len(whole) and np.abs(whole).max() >= LARGEST:
        raise ValueError(f"a component times {SCALE} reaches {LARGEST}; scale the vectors down first")
    return keep, lengths, whole.astype(np.int32)


def integer_vectors(vectors: DataFrame, vector: str) -> DataFrame:
    """(vec_id, label, n, x): kept rows with their number of components and 32-bit components as binary."""
    slim = vectors.select("vec_id", "label", F.col(vector).alias("vector"))

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches, ROWS_AT_ONCE):
            keep, lengths, whole = scaled(batch.column(2))
            ends = np.append(0, np.cumsum(lengths[keep])).astype(np.int32) * 4
            x = pa.Array.from_buffers(pa.binary(), int(keep.sum()), [None, pa.py_buffer(ends), pa.py_buffer(whole.tobytes())])
            kept = batch.select([0, 1]).filter(pa.array(keep))
            n = pa.array(lengths[keep].astype(np.int32))
            yield pa.RecordBatch.from_arrays([*kept.columns, n, x], ["vec_id", "label", "n", "x"])

    kinds = {f.name: f.dataType.simpleString() for f in slim.schema.fields}
    return slim.mapInArrow(convert, f"vec_id {kinds['vec_id']}, label {kinds['label']}, n int, x binary")


# ------------------------------------------------------------------- bounds --


def _squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of x (rows, width) to entries (rows or 1, k, width)."""
    gap = x[:, None, :] - entries
    return np.einsum("nkw,nkw->nk", gap, gap)


def _outwards(value: np.ndarray, way: float) -> np.ndarray:
    """A bound as 32-bit float, moved away from the true value by more than any rounding."""
    wide = value + way * 1e-6 * (1.0 + np.abs(value))
    return np.nextafter(wide.astype(np.float32), np.float32(way * np.inf))


def _ranked(squares: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squares rising, ties as they stand (``entry`` must rise), and the entries in that order."""
    order = np.argsort(squares, axis=1, kind="stable")
    return np.take_along_axis(squares, order, 1), np.take_along_axis(entry, order, 1)


def start_part(x: np.ndarray, entries: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Closest ``b + 1`` entries of each row and its bounds (upper, ``b`` lower, outer), from all distances."""
    k = len(entries)
    squares, order = _ranked(_squares(x, entries[None]), np.broadcast_to(np.arange(k, dtype=np.uint8), (len(x), k)))
    distance = np.sqrt(squares.astype(np.float64))
    bounds = np.full((len(x), b + 2), FAR, np.float32)
    bounds[:, :1] = _outwards(distance[:, :1], 1)
    rest = distance[:, 1 : b + 2]
    bounds[:, 1 : 1 + rest.shape[1]] = _outwards(rest, -1)
    return order[:, : b + 1], bounds


def advance_part(
    x: np.ndarray, near: np.ndarray, bounds: np.ndarray, entries: np.ndarray, drift: np.ndarray, b: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kept entries and bounds after the codebook has moved, and how many bounds each row had to pass.

    ``near`` and ``bounds`` may hold more bounds than ``b``; the surplus folds into the outer one.
    A row that passed ``b + 1`` bounds was compared with all entries.
    """
    near = near[:, : b + 1].copy()
    moved = drift[near[:, 1:]]
    upper = bounds[:, 0] + drift[near[:, 0]]
    lower = bounds[:, 1:].astype(np.float64)
    lower[:, -1] -= drift.max()
    if lower.shape[1] - 1 > b:  # surplus bounds drift by the largest step, like the outer one
        lower[:, b:-1] -= drift.max()
    lower[:, :b] -= moved
    lower = np.minimum.accumulate(lower[:, ::-1], axis=1)[:, ::-1][:, : b + 1]
    lower = _outwards(lower, -1)
    upper = _outwards(upper, 1)
    passed = np.zeros(len(x), np.uint8)
    open_rows = np.flatnonzero(upper >= lower[:, 0])
    if len(open_rows):
        upper[open_rows] = _outwards(
            np.sqrt(_squares(x[open_rows], entries[near[open_rows, :1]])[:, 0].astype(np.float64)), 1
        )
        passed[open_rows] = (upper[open_rows, None] >= lower[open_rows]).sum(axis=1)
    for count in range(1, b + 1):
        rows = np.flatnonzero(passed == count)
        if len(rows):
            some = np.sort(near[rows, : count + 1], axis=1)
            squares, order = _ranked(_squares(x[rows], entries[some]), some)
            distance = np.sqrt(squares.astype(np.float64))
            near[rows, : count + 1] = order
            upper[rows] = _outwards(distance[:, 0], 1)
            lower[rows, :count] = _outwards(distance[:, 1:], -1)
    out = np.column_stack([upper, lower])
    rows = np.flatnonzero(passed == b + 1)
    if len(rows):
        near[rows], out[rows] = start_part(x[rows], entries, b)
    return near, out, passed


# -------------------------------------------------------------------- state --

_STATE = ("vec_id", "label", "x", "near", "bounds", "passed")


def _state_schema(rows: DataFrame) -> str:
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return f"vec_id {kinds['vec_id']}, label {kinds['label']}, x binary, near binary, bounds binary, passed binary"


def start_state(rows: DataFrame, books: Codebooks, b: int) -> DataFrame:
    """State of all rows (vec_id, label, x) under the first codebooks."""
    entries = books.entries
    width = entries.shape[2]

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches, ROWS_AT_ONCE):
            x = _matrix(batch.column(2), np.int32, PARTS * width).reshape(-1, PARTS, width).astype(np.int64)
            parts = [start_part(x[:, p], entries[p], b) for p in range(PARTS)]
            near, bounds = (np.stack(side, axis=1) for side in zip(*parts))
            passed = np.full((len(x), PARTS), b + 1, np.uint8)
            yield pa.RecordBatch.from_arrays([*batch.columns, _fixed(near), _fixed(bounds), _fixed(passed)], list(_STATE))

    return rows.select("vec_id", "label", "x").mapInArrow(start, _state_schema(rows))


def _advanced(batch: pa.RecordBatch, books: Codebooks, had: int, b: int):
    """Integer vectors, kept entries, bounds and passed bounds of a state batch, moved to ``books``."""
    width = books.entries.shape[2]
    n = batch.num_rows
    x = _matrix(batch.column(2), np.int32, PARTS * width).reshape(n, PARTS, width).astype(np.int64)
    near = _matrix(batch.column(3), np.uint8, PARTS * (had + 1)).reshape(n, PARTS, had + 1)
    bounds = _matrix(batch.column(4), np.float32, PARTS * (had + 2)).reshape(n, PARTS, had + 2)
    parts = [
        advance_part(x[:, p], near[:, p], bounds[:, p], books.entries[p], books.drift[p], b) for p in range(PARTS)
    ]
    return x, *(np.stack(side, axis=1) for side in zip(*parts))


def advance_state(state: DataFrame, books: Codebooks, had: int, b: int) -> DataFrame:
    """The state under moved codebooks, from ``had`` to ``b`` bounds a part."""

    def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches, ROWS_AT_ONCE):
            _, near, bounds, passed = _advanced(batch, books, had, b)
            columns = [*batch.columns[:3], _fixed(near), _fixed(bounds), _fixed(passed)]
            yield pa.RecordBatch.from_arrays(columns, list(_STATE))

    return state.mapInArrow(advance, _state_schema(state))


def totals(state: DataFrame, width: int, had: int) -> tuple[dict[tuple[int, int], tuple[int, list[int]]], np.ndarray]:
    """Count and component sums by (part, entry), and how many parts passed 0, 1, ... bounds.

    A task sends one row for each entry it used; the driver sees PARTS x ENTRIES rows.
    """

    size = max(width, had + 2)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((PARTS, ENTRIES, size), np.int64)
        counts = np.zeros((PARTS, ENTRIES), np.int64)
        used = np.zeros(size, np.int64)
        for batch in row_slices(batches, ROWS_AT_ONCE):
            n = batch.num_rows
            x = _matrix(batch.column(0), np.int32, PARTS * width).reshape(n, PARTS, width)
            near = _matrix(batch.column(1), np.uint8, PARTS * (had + 1)).reshape(n, PARTS, had + 1)
            used += np.bincount(_matrix(batch.column(2), np.uint8, PARTS).ravel(), minlength=size)
            for p in range(PARTS):
                one = near[:, p, 0] == np.arange(ENTRIES)[:, None]
                # Exact: a batch's sums are below 2**53.
                sums[p, :, :width] += (one.astype(np.float64) @ x[:, p]).astype(np.int64)
                counts[p] += one.sum(axis=1)
        part, entry = np.nonzero(counts)
        if len(part):
            rows = [*zip(part.tolist(), entry.tolist(), counts[part, entry].tolist(), sums[part, entry].tolist())]
            rows.append((-1, -1, 0, used.tolist()))
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
            columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "n", "s"])

    own = state.select("x", "near", "passed").mapInArrow(add, "part int, entry int, n bigint, s array<bigint>")
    summed = [F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(size)]
    rows = own.groupBy("part", "entry").agg(F.sum("n").alias("n"), *summed).collect()
    sums = {(r["part"], r["entry"]): (r["n"], [r[f"s{i}"] for i in range(width)]) for r in rows if r["part"] >= 0}
    passed = [[r[f"s{i}"] for i in range(had + 2)] for r in rows if r["part"] < 0]
    return sums, np.array(passed[0] if passed else [0] * (had + 2), np.int64)


def fewer_bounds(passed: np.ndarray, b: int, entries: int) -> int:
    """Bounds to keep: enough for COVERED of the uncertain parts that ``b`` bounds settled, an eighth of the entries at least."""
    settled = passed[1 : b + 1]
    if not settled.sum():
        return min(b, max(1, entries // 8))
    needed = int(np.searchsorted(np.cumsum(settled), COVERED * settled.sum())) + 1
    return min(b, max(needed, entries // 8))


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this application's scratch state."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def compress_vectors(vectors: DataFrame, vector: str = "embedding", rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks | None]:
    """Product codes of all vectors, and the final codebooks.

    ``vectors`` needs vec_id, label and the ``vector`` column (arrays of numbers);
    other columns are ignored. Returns vec_id, label, code (two hex digits for
    each part) and error (squared distance in integers).

    Rows whose vector is null or has null or non-finite components are dropped.
    The codebooks start as the ENTRIES rows of smallest vec_id (a null vec_id
    comes last; rows of one vec_id by their components); with fewer rows there are fewer
    entries. Vectors must have the most common length (ties: the longest), a multiple
    of PARTS, or ValueError is raised; rows of another length have a null code and
    error. Components of LARGEST / SCALE or more raise ValueError. Repeated rows are
    each coded. An empty table gives no rows and no codebooks.
    """
    spark = vectors.sparkSession
    whole = _stored(integer_vectors(vectors, vector), shared_path(spark, "llm", "code_vectors"))
    common = whole.groupBy("n").count().orderBy(F.desc("count"), F.desc("n")).first()
    if common is None:
        return whole.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error")), None
    if common["n"] % PARTS or not 0 < common["n"] <= WIDEST:
        raise ValueError(f"vectors of {common['n']} components cannot be cut into {PARTS} equal parts of integers")
    width = common["n"] // PARTS
    rows, others = whole.where(F.col("n") == common["n"]), whole.where(F.col("n") != common["n"])
    seeds = rows.select("vec_id", "x").orderBy(F.asc_nulls_last("vec_id"), "x").limit(ENTRIES).collect()
    first = np.stack([np.frombuffer(bytes(s["x"]), np.int32).reshape(PARTS, width) for s in seeds], axis=1).astype(np.int64)
    books = Codebooks(first, np.zeros(first.shape[:2]))

    b = had = min(max(1, ENTRIES // 4), len(seeds) - 1)
    path = shared_path(spark, "llm", "code_state")
    state = _stored(start_state(rows, books, b), path)
    for turn in range(rounds):
        sums, passed = totals(state, width, had)
        books = books.moved(sums)
        if turn:
            b = fewer_bounds(passed, had, len(seeds))
        if turn == rounds - 1 or not books.drift.any():
            break
        after = shared_path(spark, "llm", "code_state")
        state = _stored(advance_state(state, books, had, b), after)
        _remove(spark, path)
        path, had = after, b

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches, ROWS_AT_ONCE):
            x, near, _, _ = _advanced(batch, books, had, b)
            code = np.ascontiguousarray(near[:, :, 0])
            gap = x - books.entries[np.arange(PARTS), code]
            error = (gap * gap).sum(axis=(1, 2))
            text = [row.tobytes().hex() for row in code]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(text, pa.string()), pa.array(error)], ["vec_id", "label", "code", "error"]
            )

    kinds = {f.name: f.dataType.simpleString() for f in state.schema.fields}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint"
    coded = state.mapInArrow(finish, schema)
    uncoded = others.select("vec_id", "label", F.lit(None).cast("string"), F.lit(None).cast("bigint"))
    return _stored(coded.union(uncoded), shared_path(spark, "llm", "codes")), books


def code_table(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Codes with the error summed over equal labels (nulls together) and the digest of the codebooks."""
    coded, books = compress_vectors(vectors, vector)
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "own_label")
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("own_label")))
    digest = F.lit(books.sha256() if books else hashlib.sha256(b"").hexdigest())
    return joined.select("vec_id", "label", "code", "error", "label_error", digest.alias("codebooks_sha256"))


def op11_vectorcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_table(table(spark, sf_dir, "embeddings")).drop("label")


# ---------------------------------------------------------------------- SQL --


def code_sql() -> str:
    """The same codes in DuckDB: plain rounds over all distances, in integers."""
    steps = [
        "kept as materialized (select row_number() over (order by vec_id nulls last, embedding) as id, vec_id, label, "
        "embedding from embeddings where embedding is not null "
        "and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0)",
        "cells as materialized (select id, (i - 1) // (n // 8) as part, (i - 1) % (n // 8) as pos, "
        "cast(floor(4096 * cast(embedding[i] as double)) as bigint) as x "
        "from (select id, embedding, len(embedding) as n, unnest(range(1, len(embedding) + 1)) as i from kept))",
        "book0 as materialized (select part, id - 1 as entry, pos, x as c from cells where id <= 16)",
    ]
    for k in range(ROUNDS + 1):
        steps.append(
            f"near{k} as materialized (select id, part, arg_min(entry, row(d, entry)) as entry, min(d) as d from ("
            "select cells.id, cells.part, entry, sum((x - c) * (x - c)) as d "
            f"from cells join book{k} using (part, pos) group by all) group by all)"
        )
        if k < ROUNDS:
            mean = "cast((s - ((s % n) + n) % n) / n as bigint)"
            steps.append(
                f"book{k + 1} as materialized (select part, entry, pos, coalesce({mean}, c) as c from book{k} left join ("
                "select part, entry, pos, cast(sum(x) as hugeint) as s, count(*) as n "
                f"from cells join near{k} using (id, part) group by all) using (part, entry, pos))"
            )
    last = f"near{ROUNDS}"
    steps.append(
        "coded as materialized (select id, string_agg(printf('%02x', cast(entry as int)), '' order by part) as code, "
        f"cast(sum(d) as bigint) as error from {last} group by id)"
    )
    return (
        "with "
        + ",\n".join(steps)
        + "\nselect vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, "
        f"(select sha256(string_agg(cast(c as varchar), ',' order by part, entry, pos)) from book{ROUNDS}) as codebooks_sha256 "
        "from kept join coded using (id)"
    )


OP11_SQL = code_sql()
