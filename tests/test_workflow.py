"""The documented end-to-end flow and the commands, on real gzip dumps."""

import json
import os

import pytest
from traffic_helpers import write_dump

from trafficlens import jobs
from trafficlens import (
    read_runs,
    RunContext,
    hourly_profile,
    land_pageviews,
    read_landed_pageviews,
    read_pageviews,
    title_daily,
    top_pages,
)
from trafficlens.functions import DEFAULT_PROJECTS, title_spellings


def test_documented_workflow(spark, tmp_path):
    month = tmp_path / "raw" / "2026-07"
    write_dump(month, "pageviews-20260726-100000.gz", ["fr Tour_Eiffel 200 0", "fr.m Tour_Eiffel 1090 0", "en Paris 5 0"])
    write_dump(month, "pageviews-20260727-000000.gz", ["fr Tour_Eiffel 5 0", "fr.m Tour_Eiffel 17 0", "fr Louvre 3 0"])
    glob = str(month / "*.gz")
    out = str(tmp_path / "out")

    with RunContext(spark, "top100", "2026-07", out, os.path.join(out, "runs"), inputs=glob) as run:
        pv = run.observe_input(read_pageviews(spark, glob))
        assert run.write(top_pages(pv, 100), fmt="csv", single_file=True, file_name="result.csv") == 2
    assert run.rows_in == 6 and run.record.input_files == 2
    lines = open(os.path.join(run.outdir, "result", "result.csv"), encoding="utf-8").read().splitlines()
    assert lines[0] == "rank,title,views,views_desktop,views_mobile,share_pct"
    assert lines[1].startswith("1,Tour_Eiffel,1312,205,1107,")

    pv_title = read_pageviews(spark, glob, projects=DEFAULT_PROJECTS, titles=title_spellings("Tour_Eiffel"))
    assert [(r.views, r.views_desktop, r.views_mobile) for r in title_daily(pv_title, "Tour_Eiffel").collect()] == [
        (1290, 200, 1090),
        (22, 5, 17),
    ]

    landed = str(tmp_path / "landed")
    land_pageviews(read_pageviews(spark, glob), landed, balance=True)
    assert sorted(r.hour for r in hourly_profile(read_landed_pageviews(spark, landed)).collect()) == [0, 10]


def _month(tmp_path):
    month = tmp_path / "raw" / "2026-07"
    write_dump(month, "pageviews-20260726-100000.gz", ["fr Tour_Eiffel 200 0", "fr.m Tour_Eiffel 1090 0", "en Paris 5 0"])
    write_dump(month, "pageviews-20260727-000000.gz", ["fr Louvre 3 0", "bad line", "fr.m Tour_Eiffel 17 0"])
    (tmp_path / "titles.csv").write_text("id,title\n1,Tour_Eiffel\n2,Sagrada_Família\n", encoding="utf-8")
    return [f"--raw={tmp_path}/raw", f"--out={tmp_path}/out", f"--runs={tmp_path}/runs"]


@pytest.mark.parametrize(
    "argv, rows_in, first",
    [
        (["top100", "2026-07", "--count-in"], 5, "1,Tour_Eiffel,1307,200,1107,99.771"),
        (["top100", "2026-07"], -1, "1,Tour_Eiffel,1307,200,1107,99.771"),
        (["monument", "2026-07", "Tour_Eiffel", "--count-in"], 5, "2026-07-26,1290,200,1090"),
        (["circadian", "2026-07"], -1, "0,20,20.0,3,17,85.0,1.527"),
    ],
)
def test_commands_write_result_manifest_and_metadata(spark, tmp_path, argv, rows_in, first):
    folders = _month(tmp_path)
    extra = [f"--titles={tmp_path}/titles.csv"] if argv[0] == "monument" else []
    done = jobs.run(spark, jobs.arguments([*argv, *folders, *extra]))
    lines = open(os.path.join(done.outdir, "result", "result.csv"), encoding="utf-8").read().splitlines()
    assert lines[1] == first and len(lines) == done.rows_out + 1
    row = read_runs(spark, f"{tmp_path}/runs").collect()
    assert [(r.run_id, r.rows_in, r.rows_out, r.month) for r in row] == [(done.run_id, rows_in, done.rows_out, "2026-07")]
    folder = os.path.join(done.outdir, "meta")
    meta = json.loads(open(os.path.join(folder, next(p for p in os.listdir(folder) if p.endswith(".json")))).read())
    assert meta["input_files"] == 2 and meta["job"].split("_")[0] == argv[0]


def test_monument_guard_force_and_hint(spark, tmp_path, capsys):
    folders = [*_month(tmp_path), f"--titles={tmp_path}/titles.csv"]
    with pytest.raises(ValueError, match="1 unknown title"):
        jobs.run(spark, jobs.arguments(["monument", "2026-07", "Tour_Eifel", *folders]))
    done = jobs.run(spark, jobs.arguments(["monument", "2026-07", "Tour_Eifel", "--force", *folders]))
    assert done.rows_out == 0 and "check its exact spelling" in capsys.readouterr().out
