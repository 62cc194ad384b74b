"""Run a registered Spark query and its DuckDB oracle side by side and compare.

Comparison: same column names, same row count, and the same multiset of rows
after sorting columns by name (floats compared to 1e-9 relative).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


_SPARK_TO_SQL = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def _type_mismatches(sdf, rel) -> list[str]:
    """Columns whose Spark type and DuckDB type differ (after the usual name mapping)."""
    s_types = {f.name: _SPARK_TO_SQL.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    d_types = {c[0]: str(c[1]) for c in rel.description}
    return [f"{c}: {s_types[c]} vs {d_types.get(c)}" for c in s_types if s_types[c] != d_types.get(c)]


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "as_integer_ratio") and not isinstance(v, int):  # Decimal
        return float(f"{float(v):.9g}")
    return v


def _key(row):
    return tuple((0, "") if x is None else (1, str(x)) for x in row)


def compare(spark, name: str, sf_dir: str, query, sql: str | None):
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    result = {"name": name, "spark_rows": len(s_rows), "columns": s_cols}
    if sql is None:
        result["match"] = None
        return result
    con = duck(sf_dir)
    rel = con.execute(sql)
    d_cols = [c[0] for c in rel.description]
    result["type_mismatches"] = _type_mismatches(sdf, rel)
    d_rows = rel.fetchall()
    result["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        result["match"] = False
        result["why"] = f"columns {s_cols} vs {d_cols}"
        return result
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_index = {c: i for i, c in enumerate(d_cols)}
    s_norm = sorted((tuple(_norm(r[i]) for i in order) for r in s_rows), key=_key)
    d_norm = sorted(
        (tuple(_norm(r[d_index[s_cols[i]]]) for i in order) for r in d_rows), key=_key
    )
    result["match"] = s_norm == d_norm
    if not result["match"]:
        d_set, s_set = set(d_norm), set(s_norm)
        diff_s = [r for r in s_norm if r not in d_set][:5]
        diff_d = [r for r in d_norm if r not in s_set][:5]
        result["why"] = f"spark-only {diff_s} oracle-only {diff_d}"
    return result


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from trafficlens.session import local_session

    sf_dir = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
    names = argv or sorted(entry.queries())
    spark = local_session()
    sqls = entry.oracle_sql()
    bad = 0
    for name in names:
        try:
            r = compare(spark, name, sf_dir, entry.queries()[name], sqls.get(name))
        except Exception as exc:  # noqa: BLE001
            r = {"name": name, "match": False, "why": f"{type(exc).__name__}: {str(exc)[:400]}"}
        ok = r.get("match")
        bad += ok is False
        types = r.get("type_mismatches") or ""
        print(f"{'OK ' if ok else ('-- ' if ok is None else 'BAD')} {name} {r.get('spark_rows')}/{r.get('oracle_rows')} {r.get('why', '')} {types}")
    print(f"{len(names) - bad}/{len(names)} queries match their oracle at {sf_dir}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
