"""Scan of real gzip dumps: parsing, file-name columns, malformed lines, ANSI safety."""

import datetime as dt

from traffic_helpers import write_dump

from trafficlens.sources import (
    file_hours,
    input_file_count,
    malformed_counts,
    pageview_glob,
    read_pageview_lines,
    read_pageviews,
)

GOOD = "pageviews-20260601-070000.gz"

LINES = [
    "fr Tour_Eiffel 231 0",
    "fr.m Tour_Eiffel 9 0",
    "fr.b Tour_Eiffel 9 0",
    "bad line",
    "a b c d e",
    "fr Foo abc 0",
    "fr Foo 99999999999 0",
    "fr Foo 12.5 0",
    "fr  7 0",
    "fr Discussion_Wikip%C3%A9dia:Y 1 0",
    "fr Discussions:_film 1 0",
    "fr spécial:X 1 0",
    'fr A_"quoted",_title 5 0',
]


def _dumps(tmp_path):
    month = tmp_path / "raw" / "2026-06"
    write_dump(month, GOOD, LINES)
    write_dump(month, "pageviews-20261345-000000.gz", ["fr Bad_Date 3 0"])
    write_dump(month, "pageviews-20260601-003000.gz", ["fr Wrong_Name 3 0"])
    write_dump(month, "other.gz", ["fr Other 3 0"])
    return str(tmp_path / "raw")


def test_scan_keeps_and_drops(spark, tmp_path, ansi):
    root = _dumps(tmp_path)
    pv = read_pageviews(spark, pageview_glob(root, "2026-06"))
    rows = {(r.project, r.title, r.views, r.day, r.hour, r.date) for r in pv.collect()}
    d = dt.date(2026, 6, 1)
    assert ("fr", "Tour_Eiffel", 231, "20260601", 7, d) in rows
    assert ("fr.m", "Tour_Eiffel", 9, "20260601", 7, d) in rows
    # the scan does not filter projects or empty titles
    assert ("fr.b", "Tour_Eiffel", 9, "20260601", 7, d) in rows
    assert ("fr", "", 7, "20260601", 7, d) in rows
    titles = {r[1] for r in rows}
    assert "Foo" not in titles  # abc, overflow and 12.5 all dropped, no exception
    assert "Wrong_Name" not in titles and "Other" not in titles
    # an invalid date in a recognised name keeps the row with a null date
    assert ("fr", "Bad_Date", 3, "20261345", 0, None) in rows
    assert len(rows) == 9


def test_file_columns_and_counts(spark, tmp_path):
    root = _dumps(tmp_path)
    lines = read_pageview_lines(spark, pageview_glob(root, "2026-06"))
    assert lines.columns == ["value", "file_name"]
    hours = {(r.file_name, r.day, r.hour) for r in file_hours(lines).collect()}
    assert hours == {(GOOD, "20260601", 7), ("pageviews-20261345-000000.gz", "20261345", 0)}
    assert input_file_count(lines).first().input_files == 4
    reasons = {r.reason: r.n_lines for r in malformed_counts(lines).collect()}
    assert reasons == {"ok": 9, "field_count": 2, "views": 3, "file_name": 2}


def test_glob_only_reads_gz(spark, tmp_path):
    root = _dumps(tmp_path)
    (tmp_path / "raw" / "2026-06" / "notes.txt").write_text("fr Text_File 1 0\n")
    pv = read_pageviews(spark, pageview_glob(root, "2026-06"))
    assert pv.where("title = 'Text_File'").count() == 0


def test_project_prefilter_equals_project_filter(spark, tmp_path, ansi):
    from trafficlens.operators import only_projects

    root = _dumps(tmp_path)
    write_dump(tmp_path / "raw" / "2026-06", "pageviews-20260602-050000.gz", ["fr.mobile X 1 0", "fr.m Y 2 0", "frx Z 3 0", "fr W 4"])
    glob = pageview_glob(root, "2026-06")
    want = sorted(tuple(r) for r in only_projects(read_pageviews(spark, glob)).collect())
    got = sorted(tuple(r) for r in read_pageviews(spark, glob, projects=("fr", "fr.m")).collect())
    assert got == want and want


def test_title_prefilter_is_a_superset(spark, tmp_path):
    from trafficlens.functions import title_spellings
    from trafficlens.plans import title_daily

    month = tmp_path / "raw" / "2026-06"
    write_dump(month, "pageviews-20260601-000000.gz", [
        "fr Sagrada_Família 3 0", "fr.m Sagrada_Fam%C3%ADlia 4 0", "fr Sagrada_Família_(film) 9 0",
        "fr Other 5 0", "fr 5 5 0", "fr.m Sagrada_Família 1",
    ])
    write_dump(month, "pageviews-20260602-000000.gz", ["fr Sagrada_Família 7 0", "fr 5 2 0"])
    glob = pageview_glob(str(tmp_path / "raw"), "2026-06")
    for title in ["Sagrada_Família", "5"]:
        full = sorted(tuple(r) for r in title_daily(read_pageviews(spark, glob), title).collect())
        pre = read_pageviews(spark, glob, projects=("fr", "fr.m"), titles=title_spellings(title))
        assert sorted(tuple(r) for r in title_daily(pre, title).collect()) == full
    assert [r.views for r in title_daily(read_pageviews(spark, glob), "Sagrada_Família").collect()] == [7, 7]


def test_truncated_dump_fails(spark, tmp_path):
    import pytest

    month = tmp_path / "raw" / "2026-06"
    good = write_dump(month, "pageviews-20260601-010000.gz", [f"fr Line_{i} 1 0" for i in range(5000)])
    data = open(good, "rb").read()
    with open(good, "wb") as fh:  # truncate the dump in the middle
        fh.write(data[: len(data) // 2])
    with pytest.raises(Exception):
        read_pageviews(spark, pageview_glob(str(tmp_path / "raw"), "2026-06")).count()


def test_dump_names_by_substrings_equal_the_pattern(spark):
    from trafficlens.functions.constants import FILENAME_PATTERN
    from trafficlens.sources.pageviews import _dump_name
    import re

    names = [
        "pageviews-20260601-010000.gz", "xpageviews-20260601-010000.gz", "pageviews-2026060a-010000.gz",
        "pageviews-20260601-0\u0661 0000.gz", "pageviews-20260601_010000.gz", "pageviews-20260601-010000.gzx",
        "pageviews-20260601-010001.gz", "ageviews-20260601-010000.gz", "", "pageviews--0260601-010000.gz",
    ]
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", _dump_name("n").alias("m"))
    for r in df.collect():
        want = re.search(FILENAME_PATTERN, r.n, re.ASCII)
        assert r.m == (want.group(0) if want else "")


def test_listing_counts_empty_dumps_and_equal_names(spark, tmp_path):
    import gzip

    from trafficlens.sources import dump_count, dump_hours, list_dumps

    for folder in ("a", "b"):
        write_dump(tmp_path / "raw" / folder, "pageviews-20260601-000000.gz", ["fr Good 1 0"])
    write_dump(tmp_path / "raw" / "a", "pageviews-20260601-010000.gz", [])
    (tmp_path / "raw" / "a" / "pageviews-20260601-020000.gz").write_bytes(gzip.compress(b""))
    write_dump(tmp_path / "raw" / "a", "notes.gz", ["fr Good 1 0"])
    files = list_dumps(spark, [str(tmp_path / "raw" / f) for f in ("a", "b")])
    assert dump_count(files).first()[0] == 5
    hours = sorted((r.day, r.hour) for r in dump_hours(files).collect())
    assert hours == [("20260601", 0), ("20260601", 1), ("20260601", 2)]
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan and "FileScan text" not in plan

