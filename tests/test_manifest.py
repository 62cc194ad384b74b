"""Publication of runs by one commit marker: failures between the writes, retries, repetitions and compaction."""

import json
import os

import pytest

import __spark_entry__ as entry
from trafficlens.sinks import RunContext, append_run, compact_runs, manifest
from trafficlens.sources import RUNS_SCHEMA, read_committed_runs, read_runs, with_family


def row(run_id, ts="2026-07-28T20:00:00+00:00", duration=1.5):
    return {
        "run_id": run_id, "ts_utc": ts, "job": "top100", "month": "2026-07", "parallelism": 2, "duration_s": duration,
        "rows_in": -1, "rows_out": 100,
    }


def ids(spark, path):
    return sorted(r.run_id for r in read_committed_runs(spark, path).collect())


def test_a_failure_between_the_writes_leaves_a_readable_manifest(spark, tmp_path, monkeypatch):
    out, runs = str(tmp_path / "out"), str(tmp_path / "runs")
    append_run(spark, runs, row("before"))
    move = manifest._move_once

    def fails(*args):
        raise OSError("the storage went away")

    df = spark.range(5)
    monkeypatch.setattr(manifest, "_move_once", fails)
    with pytest.raises(OSError), RunContext(spark, "circadian", "2026-07", out, runs) as run:
        run.write(df)
    # Result and metadata are there, but nothing counts the run yet.
    assert {"_CLAIMED", "_run", "meta", "result"} <= set(os.listdir(run.outdir)) and ids(spark, runs) == ["before"]
    monkeypatch.setattr(manifest, "write_meta", fails)
    with pytest.raises(OSError):
        run.publish()
    assert ids(spark, runs) == ["before"]
    monkeypatch.undo()
    assert manifest._move_once is move
    assert run.publish() is True and run.publish() is False  # a retry commits, another one changes nothing
    assert ids(spark, runs) == sorted(["before", run.run_id])
    committed = {r.run_id: r for r in read_committed_runs(spark, runs).collect()}[run.run_id]
    folder = os.path.join(run.outdir, "meta")
    meta = json.loads(open(os.path.join(folder, next(p for p in os.listdir(folder) if p.endswith(".json")))).read())
    assert (meta["run_id"], meta["duration_s"], meta["rows_out"]) == (run.run_id, committed.duration_s, 5)


def test_repeated_and_uncommitted_rows_are_read_once_or_not_at_all(spark, tmp_path):
    runs = str(tmp_path / "runs")
    assert append_run(spark, runs, row('monument_AC/DC: "x", é')) is True
    assert append_run(spark, runs, row('monument_AC/DC: "x", é', duration=9.0)) is False
    header = "run_id,ts_utc,job,month,parallelism,duration_s,rows_in,rows_out\n"
    with open(f"{runs}/by_hand.csv", "w", encoding="utf-8") as fh:
        fh.write(header + "a,2026-01-01,j,m,2,1.0,1,1\n" * 3 + "a,2026-01-02,j,m,2,2.0,1,1\n" + ",2026-01-03,j,m,2,3.0,1,1\n" * 2)
    os.makedirs(f"{runs}/_pending/left")
    with open(f"{runs}/_pending/left/part-0.csv", "w", encoding="utf-8") as fh:
        fh.write(header + "uncommitted,t,j,m,2,1.0,1,1\n")
    got = sorted((r.run_id or "", r.duration_s) for r in read_committed_runs(spark, runs).collect())
    assert got == [("", 3.0), ("", 3.0), ("a", 2.0), ('monument_AC/DC: "x", é', 1.5)]


def test_compaction_keeps_every_run_once(spark, tmp_path, monkeypatch):
    runs = str(tmp_path / "runs")
    for k in range(4):
        append_run(spark, runs, row(f"r{k}"))
    before = sorted(map(tuple, read_committed_runs(spark, runs).collect()))
    assert compact_runs(spark, runs) == 4
    files = [p for p in os.listdir(runs) if p.endswith(".csv")]
    assert len(files) == 1 and sorted(map(tuple, read_committed_runs(spark, runs).collect())) == before

    # A compaction that stops after its move: the old files are still there, and each run still counts once.
    append_run(spark, runs, row("r9"))
    move = manifest._move_once

    def stops(*args):
        move(*args)
        raise KeyboardInterrupt

    monkeypatch.setattr(manifest, "_move_once", stops)
    with pytest.raises(KeyboardInterrupt):
        compact_runs(spark, runs)
    monkeypatch.undo()
    assert len([p for p in os.listdir(runs) if p.endswith(".csv")]) == 3
    assert ids(spark, runs) == ["r0", "r1", "r2", "r3", "r9"]
    assert compact_runs(spark, runs) == 5 and ids(spark, runs) == ["r0", "r1", "r2", "r3", "r9"]
    os.makedirs(tmp_path / "none")
    assert compact_runs(spark, str(tmp_path / "none")) == 0


def test_reading_committed_runs_shuffles_each_column_once(spark, tmp_path):
    runs = str(tmp_path / "runs")
    append_run(spark, runs, row("a"))
    plan = read_committed_runs(spark, runs)._jdf.queryExecution().executedPlan().toString()
    above, shuffled = plan.split("Exchange hashpartitioning(run_id")  # one shuffle
    assert "struct(" not in plan and "family" in above and "family" not in shuffled


def test_of_repeated_rows_the_greatest_stays_and_null_is_the_least(spark, tmp_path):
    header = "run_id,ts_utc,job,month,parallelism,duration_s,rows_in,rows_out\n"
    low, high = ["t1", "j_1", "m1", "2", "1.5", "9", "9"], ["t2", "j_2", "m2", "10", "10.5", "10", "10"]
    lines, want = [], {}
    for k in range(len(low)):  # equal before column k, greater there, smaller after it
        winner = low[:k] + [high[k]] + low[k + 1 :]
        for name, value in (("value", low[k]), ("null", "")):
            loser = low[:k] + [value] + high[k + 1 :]
            lines += [[f"{name}{k}", *loser], [f"{name}{k}", *winner], [f"{name}{k}", *loser]]
            want[f"{name}{k}"] = (*winner[:3], int(winner[3]), float(winner[4]), int(winner[5]), int(winner[6]), "j")
    (tmp_path / "runs.csv").write_text(header + "".join(",".join(x) + "\n" for x in lines), encoding="utf-8")
    rows = [tuple(r) for r in read_committed_runs(spark, str(tmp_path / "runs.csv")).collect()]
    assert {r[0]: r[1:] for r in rows} == want and len(rows) == len(want)


def test_a_manifest_of_the_query_is_compressed_in_files_of_bounded_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "runs")
    monkeypatch.setattr(entry, "shared_path", lambda *_: path)
    monkeypatch.setattr(entry, "MANIFEST_OPTIONS", entry.MANIFEST_OPTIONS | {"maxRecordsPerFile": "20"})
    runs = with_family(spark.createDataFrame([tuple(row(f"r{k}").values()) for k in range(50)], RUNS_SCHEMA).coalesce(1))
    got = entry._committed_runs(runs)
    files = [p for p in os.listdir(path) if p.startswith("part-")]
    assert len(files) == 6 and all(p.endswith(".csv.gz") for p in files)
    assert read_runs(spark, path).count() == 100
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, runs.collect()))
