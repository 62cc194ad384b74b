"""Integrity of gzip dumps: each file's state, without failing the job or holding a file in memory.

A text scan fails on a truncated or damaged dump (:mod:`trafficlens.sources.pageviews`);
this pass tells beforehand which dumps those are, so that the completeness check can
count them as missing. The listing is dealt to tasks by file size, as every file scan
is; a task reads its files one after the other in pieces of PIECE bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE = 1 << 20
INTACT, TRUNCATED, CORRUPT = "intact", "truncated", "corrupt"


def dump_states(files: DataFrame) -> DataFrame:
    """``path, file_name, length, day, hour, state, n_bytes, n_lines`` of each file of a listing (``list_dumps``).

    ``state``: *intact* (every gzip member ends with a matching checksum and length),
    *truncated* (the data ends inside a member), *corrupt* (no gzip, or damaged data).
    ``n_bytes`` and ``n_lines`` count what could be unpacked. Files are opened through
    ``pyarrow.fs`` (local paths, S3, GCS, HDFS); one that cannot be opened fails the job,
    as that says nothing about its contents.
    """
    piece, states = PIECE, (INTACT, TRUNCATED, CORRUPT)

    def examine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        intact, truncated, corrupt = states

        def state_of(uri: str) -> tuple[str, int, int]:
            plain = uri.removeprefix("file:") if uri.startswith("file:/") else ""
            files, place = (pafs.LocalFileSystem(), "/" + plain.lstrip("/")) if plain else pafs.FileSystem.from_uri(uri)
            size = lines = 0
            last = b"\n"
            with files.open_input_stream(place, compression=None) as stream:
                member, fresh, rest = zlib.decompressobj(31), True, stream.read(piece)
                while rest:
                    try:
                        text = member.decompress(rest, piece)
                    except zlib.error:
                        return corrupt, size, lines
                    size, lines, fresh = size + len(text), lines + text.count(b"\n"), False
                    last = text[-1:] or last
                    if member.eof:  # another member may follow
                        rest, member, fresh = member.unused_data, zlib.decompressobj(31), True
                    else:
                        rest = member.unconsumed_tail
                    rest = rest or stream.read(piece)
                lines += last != b"\n"
            return (intact if fresh else truncated), size, lines

        for batch in batches:
            found = [state_of(uri) for uri in batch.column(0).to_pylist()]
            names, sizes, lines = zip(*found) if found else ((), (), ())
            columns = [pa.array(names, pa.string()), pa.array(sizes, pa.int64()), pa.array(lines, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "state", "n_bytes", "n_lines"])

    listed = files.select("path", "file_name", "length", "day", "hour")
    schema = "path string, file_name string, length bigint, day string, hour int, state string, n_bytes bigint, n_lines bigint"
    return listed.mapInArrow(examine, schema)


def intact_dumps(files: DataFrame) -> DataFrame:
    """The rows of a listing whose dump is intact."""
    return dump_states(files).where(F.col("state") == INTACT).select(*files.columns)
