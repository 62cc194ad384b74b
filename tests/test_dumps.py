"""Hours solved on dump names, and the state of damaged gzip dumps."""

import datetime as dt
import fnmatch
import gzip
import random

import pytest
from traffic_helpers import collected_plan, write_dump

from trafficlens.sources import dump_states, hours_pattern, intact_dumps, list_dumps, read_pageviews
from trafficlens.sources import health

HOUR = dt.timedelta(hours=1)


def fits(name, pattern):
    return any(fnmatch.fnmatchcase(name, "*" + p) for p in pattern[2:-1].split(","))


@pytest.mark.parametrize("seed", range(6))
def test_the_pattern_holds_exactly_the_hours(seed):
    rng = random.Random(seed)
    begin = dt.datetime(2023, 11, 20)
    hours = [begin + k * HOUR for k in range(24 * 120)]
    first = rng.choice(hours)
    last = first + rng.choice([0, 3, 30, 24 * 45, 24 * 100]) * HOUR
    pattern = hours_pattern(first, last)
    for h in hours:
        assert fits(f"pageviews-{h:%Y%m%d-%H}0000.gz", pattern) == (first <= h <= last), (h, pattern)
    assert pattern.count(",") < 120


def test_only_dumps_of_the_hours_are_opened(spark, tmp_path):
    month = tmp_path / "2024-01"
    for day in (30, 31):
        for hour in range(24):
            write_dump(month, f"pageviews-202401{day}-{hour:02d}0000.gz", [f"fr T{day}_{hour} 1 0"])
    write_dump(month, "pageviews-20240131-003000.gz", ["fr Wrong_Name 1 0"])
    write_dump(month, "pageviews-20240199-000000.gz", ["fr No_Date 1 0"])
    with open(month / "pageviews-20240130-000000.gz", "wb") as fh:
        fh.write(b"damaged, but of another hour")
    for path in (f"{month}/*.gz", str(month), f"{tmp_path}/*/*.gz", f"{tmp_path}/2024-01/pageviews-2024013*.gz"):
        pv = read_pageviews(spark, path, hours=("2024-01-30 22:00", "2024-01-31 01:59"))
        assert sorted(r.title for r in pv.collect()) == ["T30_22", "T30_23", "T31_0", "T31_1"]
        _, nodes = collected_plan(pv)
        assert [m["numFiles"] for name, _, m in nodes if name.startswith("Scan")] == [4]
    assert list_dumps(spark, f"{month}/*.gz", hours=("2024-01-01", "2024-12-31 23:00")).count() == 48
    with pytest.raises(ValueError, match="are none"):
        read_pageviews(spark, str(month), hours=("2024-02-01", "2024-01-01"))


def test_states_of_damaged_dumps(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(health, "PIECE", 1000)  # files of many pieces
    rng = random.Random(5)
    text = "".join(f"fr T{rng.random()} {k} 0\n" for k in range(4000)).encode()
    whole = gzip.compress(text)
    members = b"".join(gzip.compress(text[k : k + 9000]) for k in range(0, len(text), 9000))
    zeros = gzip.compress(b"\0" * 3_000_000)
    files = {
        "00": (whole, "intact", len(text), 4000),
        "01": (members, "intact", len(text), 4000),
        "02": (gzip.compress(b""), "intact", 0, 0),
        "03": (gzip.compress(b"fr A 1 0\nno newline"), "intact", 19, 2),
        "04": (whole[: len(whole) // 2], "truncated", None, None),
        "05": (whole[:-1], "truncated", len(text), 4000),
        "06": (members[:-20], "truncated", None, None),
        "07": (whole[:5], "truncated", 0, 0),
        "08": (whole[:-6] + bytes([whole[-6] ^ 1]) + whole[-5:], "corrupt", None, None),
        "09": (whole[:5000] + bytes(300) + whole[5300:], "corrupt", None, None),
        "10": (b"fr A 1 0\n" * 50, "corrupt", 0, 0),
        "11": (whole + b"rest that is no gzip", "corrupt", None, None),
        "12": (zeros, "intact", 3_000_000, 1),
    }
    for hour, (content, *_) in files.items():
        (tmp_path / f"pageviews-20240101-{hour}0000.gz").write_bytes(content)
    listed = list_dumps(spark, f"{tmp_path}/*.gz")
    got = {r.file_name[19:21]: (r.state, r.n_bytes, r.n_lines) for r in dump_states(listed).collect()}
    assert got.keys() == files.keys()
    for hour, (_, state, size, lines) in files.items():
        assert got[hour][0] == state, (hour, got[hour])
        assert size is None or got[hour][1:] == (size, lines), (hour, got[hour])
    intact = intact_dumps(listed)
    assert intact.columns == listed.columns and sorted(r.hour for r in intact.collect()) == [0, 1, 2, 3, 12]
    assert dump_states(listed.limit(0)).count() == 0
