import gzip

import pytest
from pyspark.sql import functions as F

from trafficlens.llm import warc


@pytest.fixture
def pages(spark):
    same = "<p>" + "shared text " * 20 + "</p>"
    rows = [
        (4, "http://a/4", same, "x"),
        (2, "http://a/2", same, "x"),
        (9, "http://a/9", same, None),
        (9, "http://a/9", same, None),
        (5, "http://a/5", "tiny", "x"),
        (6, "http://a/6", "tiny", "x"),
        (7, None, None, "x"),
        (8, "http://a/\r\nX: 8", "", "x"),
        (None, "http://a/n", same, "x"),
        (10, "http://a/10", "é\r\n\r\nWARC/1.1\r\n" * 40, "x"),
        (11, "http://a/11", "z" * 300_000, "x"),
    ]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, file string")


def test_round_trip_and_types(spark, pages, tmp_path):
    index = warc.write_archives(pages, f"file://{tmp_path}/w")
    found = warc.read_records(index).join(index.select("file", "offset", "page_id", F.col("refers_to").alias("page")), ["file", "offset"])
    rows = found.collect()
    assert len(rows) == pages.count()
    html = {r["page_id"]: r["html"] or "" for r in pages.collect()}
    for r in rows:
        if r["record_type"] == "response":
            assert r["payload"] == html[r["page_id"]] and r["read_digest"] == r["digest"]
        else:
            assert r["page"] == 2 and r["refers_to"] == f"<urn:page:2:{r['digest']}>"
    types = sorted((r["page_id"] or -1, r["record_type"]) for r in rows)
    assert [p for p, t in types if t == "revisit"] == [-1, 4, 9, 9]


def test_archives_are_plain_members(spark, pages, tmp_path):
    warc.write_archives(pages, f"file://{tmp_path}/w")
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "w").iterdir()))
    assert whole.count(b"WARC-Record-ID:") == pages.count() and whole.endswith(b"\r\n\r\n")


def test_selected_records_are_read_in_merged_ranges(spark, pages, tmp_path, monkeypatch):
    index = warc.write_archives(pages.repartition(1), f"file://{tmp_path}/w")
    assert warc.coalesce_ranges(index.select("file", "offset", "length")).count() == 1
    monkeypatch.setattr(warc, "GAP_BYTES", 0)
    some = index.where("page_id in (5, 11)")
    got = warc.read_records(some)
    assert {r["payload"][:4] for r in got.collect()} == {"tiny", "zzzz"}


def test_empty_table(spark, pages, tmp_path):
    index = warc.write_archives(pages.limit(0), f"file://{tmp_path}/w")
    assert index.count() == 0 and warc.read_records(index).count() == 0
