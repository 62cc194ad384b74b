"""WARC archives with an index beside them, read back by coalesced byte ranges.

Each task writes archives of its own, one gzip member per record, and hands back
one index row per record: file, offset, length, URL and digest. The index is a
table; reading starts from selected index rows, merges neighbouring ranges of a
file in offset order, reads each merged range once and unpacks its records. A
file that a failed attempt left behind has no index rows, so nothing reads it.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trafficlens.session import shared_path

from .common import pieces, table, written

SMALLEST_SHARED = 100  # payload bytes from which equal payloads are revisits
ARCHIVE_BYTES = 256 << 20  # packed size at which a task begins another archive
RANGE_BYTES = 8 << 20  # a merged read begins anew at every multiple of this
GAP_BYTES = 64 << 10  # unselected bytes worth reading to save a request
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = pa.schema(
    [("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string())]
    + [("payload_digest", pa.string()), ("record_type", pa.string())]
)


def file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a URI, as Spark spells it, and the place in it."""
    return pyarrow.fs.FileSystem.from_uri(quote(uri, safe=":/=%"))


def classify(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, payload_digest, record_type, refers_to) of (page_id, url, html).

    Of equal payloads of at least SMALLEST_SHARED bytes the smallest page_id is
    the response and rows of other pages revisit it. The smallest comes from a
    pre-aggregated minimum per digest, so a digest that a third of the pages
    share needs no large task; only digests that several rows share are joined.
    """
    frame = pages.select(
        "page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("payload")
    )
    frame = frame.withColumn("payload_digest", F.sha2("payload", 256))
    firsts = (
        frame.where(F.octet_length("payload") >= SMALLEST_SHARED)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select("payload_digest", "first")
    )
    revisits = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return (
        frame.join(firsts, "payload_digest", "left")
        .withColumn("record_type", F.when(revisits, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(revisits, F.col("first")))
        .drop("first")
    )


def record_bytes(row: dict, date: str) -> bytes:
    """One WARC record; its id names the page and the digest, which is how a revisit refers to it."""
    payload = row["payload"].encode("utf-8") if row["record_type"] == "response" else b""
    url = "".join(c for c in row["url"] if c > " " and c != "\x7f")  # no line break enters a header
    lines = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: <urn:page:{row['page_id']}:{row['payload_digest']}>",
        f"WARC-Target-URI: {url}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{row['payload_digest']}",
    ]
    if row["record_type"] == "revisit":
        lines += [
            f"WARC-Profile: {REVISIT_PROFILE}",
            f"WARC-Refers-To: <urn:page:{row['refers_to']}:{row['payload_digest']}>",
        ]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}", "", ""]
    return "\r\n".join(lines).encode("utf-8") + payload + b"\r\n\r\n"


def write_archives(pages: DataFrame, path: str, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Write a record per page under ``path`` and return the index.

    ``pages`` needs page_id, url and html; other columns are ignored. A null
    html is an empty payload, a null url an empty URI; repeated rows each get a
    record, and all rows of a response's page are responses. The index has
    page_id, refers_to, file, offset, length, url, payload_digest and
    record_type. An empty table writes no archive.
    """
    kind = pages.schema["page_id"].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, uri, offset = None, "", 0
        files, place = file_system(path)
        try:
            for batch in batches:
                rows = []
                for row in batch.to_pylist():
                    if stream is None or offset >= ARCHIVE_BYTES:
                        if stream is not None:
                            stream.close()
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        uri = f"{path}/{name}"
                        files.create_dir(place, recursive=True)
                        stream = files.open_output_stream(f"{place}/{name}", compression=None)
                    packer = zlib.compressobj(5, zlib.DEFLATED, 31)
                    packed = packer.compress(record_bytes(row, date)) + packer.flush()
                    stream.write(packed)
                    rows.append([uri, offset, len(packed), row["url"], row["payload_digest"], row["record_type"]])
                    offset += len(packed)
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), INDEX)] if rows else []
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("page_id"), batch.column("refers_to"), *columns],
                        ["page_id", "refers_to", *INDEX.names],
                    )
        finally:
            if stream is not None:
                stream.close()

    schema = (
        f"page_id {kind}, refers_to {kind}, file string, offset bigint, length bigint, "
        "url string, payload_digest string, record_type string"
    )
    return written(classify(pages).mapInArrow(write, schema), "warc_index")


def coalesce_ranges(selected: DataFrame) -> DataFrame:
    """Merge (file, offset, length) rows into ranges with the parts they hold.

    Neighbours at most GAP_BYTES apart share a range; a range starts anew at
    every RANGE_BYTES of the file, so its size is bounded by that and one record.
    """
    order = Window.partitionBy("file").orderBy("offset")
    seen = F.max(F.col("offset") + F.col("length")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    far = F.col("offset") > F.coalesce(seen, F.lit(-GAP_BYTES - 1)) + GAP_BYTES
    cell = F.floor(F.col("offset") / RANGE_BYTES)
    starts = F.when(far | (cell != F.coalesce(F.lag(cell).over(order), F.lit(-1))), 1).otherwise(0)
    part = F.struct("offset", "length")
    return (
        selected.withColumn("starts", starts)
        .withColumn("range", F.sum("starts").over(order))
        .groupBy("file", "range")
        .agg(F.array_sort(F.collect_list(part)).alias("parts"))
    )


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    headers = {"version": lines[0]} | dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
    return headers, rest[: int(headers["Content-Length"])]


def read_records(index: DataFrame) -> DataFrame:
    """Read the records that ``index`` rows point to, by merged byte ranges.

    Returns file, offset, record_type, url, refers_to (the record id), digest
    (from the header), payload (null for a revisit) and read_digest (SHA-256 of
    the payload read).
    """
    text = ("record_type", "url", "refers_to", "digest", "payload", "read_digest")
    arrow = pa.schema([("file", pa.string()), ("offset", pa.int64()), *[(name, pa.string()) for name in text]])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, place = file_system(row["file"])
                first = row["parts"][0]["offset"]
                last = max(p["offset"] + p["length"] for p in row["parts"])
                with files.open_input_file(place) as stream:
                    block = stream.read_at(last - first, first)
                out = []
                for p in row["parts"]:
                    at = p["offset"] - first
                    headers, payload = parse_record(zlib.decompress(block[at : at + p["length"]], 31))
                    whole = headers["WARC-Type"] == "response"
                    out.append(
                        {
                            "file": row["file"],
                            "offset": p["offset"],
                            "record_type": headers["WARC-Type"],
                            "url": headers.get("WARC-Target-URI", ""),
                            "refers_to": headers.get("WARC-Refers-To"),
                            "digest": headers["WARC-Payload-Digest"].removeprefix("sha256:"),
                            "payload": payload.decode("utf-8") if whole else None,
                            "read_digest": hashlib.sha256(payload).hexdigest() if whole else None,
                        }
                    )
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    ranges = coalesce_ranges(index.select("file", "offset", "length"))
    total = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = pieces(int(total), RANGE_BYTES)
    schema = "file string, offset bigint, " + ", ".join(f"{name} string" for name in text)
    return ranges.repartition(tasks, "file", "range").mapInArrow(read, schema)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_archives(table(spark, sf_dir, "pages"), shared_path(spark, "llm", "warc"))
    records = read_records(index).select(
        "file",
        "offset",
        F.col("record_type").alias("read_type"),
        F.octet_length("payload").cast("bigint").alias("read_bytes"),
        F.coalesce("read_digest", "digest").alias("digest"),
    )
    pages = written(index.select("page_id", "file", "offset", "refers_to").join(records, ["file", "offset"]), "warc_read")
    # A revisit has the length of the response that it refers to.
    originals = (
        pages.where("read_type = 'response'")
        .join(pages.select(F.col("refers_to").alias("page_id"), "digest").distinct(), ["page_id", "digest"])
        .groupBy(F.col("page_id").alias("refers_to"), "digest")
        .agg(F.max("read_bytes").alias("original_bytes"))
    )
    return pages.join(originals, ["refers_to", "digest"], "left").select(
        "page_id",
        F.coalesce("read_bytes", "original_bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("read_type").alias("record_type"),
        "refers_to",
    )


OP3_SQL = """
with p as (
    select page_id, octet_length(encode(coalesce(html, ''))) as bytes, sha256(coalesce(html, '')) as digest from pages
), f as (
    select *, bytes >= 100 and page_id is distinct from min(page_id) over (partition by digest) as again,
        min(page_id) over (partition by digest) as first_page
    from p
)
select page_id, cast(bytes as bigint) as payload_bytes, digest as payload_digest,
    case when again then 'revisit' else 'response' end as record_type,
    case when again then first_page end as refers_to
from f
"""
