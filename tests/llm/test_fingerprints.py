import hashlib
import math
import re
import struct

import xxhash
from pyspark.sql import functions as F

from trafficlens.llm import fingerprints as fp

SF = "/root/testdata/sf0.001"


def test_edited_text_and_likeness(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy(F.desc("doc_id")).collect()
    out = {r["doc_id"]: r for r in fp.op7_fingerprints(spark, SF).collect()}
    assert len(out) == len(docs)
    for k, d in enumerate(docs):
        text, following = d["text"], docs[(k + 1) % len(docs)]["text"]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert out[d["doc_id"]]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert out[d["doc_id"]]["n_chars"] == len(text)
    nearer = sum(r["near_edited"] > r["near_next"] for r in out.values())
    assert nearer > 0.85 * len(out)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in out.values())


def test_next_text_across_runs(spark, monkeypatch):
    monkeypatch.setattr(fp, "ROWS_PER_RUN", 3)
    monkeypatch.setattr(fp, "SEGMENTS", 4)
    monkeypatch.setattr(fp, "BLOCK", 2)
    ids = [1, 2, 3, 10, 11, 500, 501, 502, 10**12, 10**12 + 1, -7]
    docs = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id bigint, text string")
    got = {r["doc_id"]: r["next_text"] for r in fp.with_next(docs).collect()}
    down = sorted(ids, reverse=True)
    assert got == {i: f"t{down[(k + 1) % len(down)]}" for k, i in enumerate(down)}


def test_order_insert_and_delete(spark):
    one = spark.createDataFrame([("a\nb\nc", "c\na\nb", "b")], "x string, y string, p string")
    x, y = fp.fingerprint_lanes(F.col("x")), fp.fingerprint_lanes(F.col("y"))
    p = fp.paragraph_vector(F.col("p"))
    row = one.select(
        (x == y).alias("same"),
        (fp.delete(x, p) == fp.fingerprint_lanes(F.lit("c\na"))).alias("deleted"),
        (fp.insert(x, p) == fp.fingerprint_lanes(F.lit("a\nb\nb\nc"))).alias("inserted"),
        (x == fp.fingerprint_lanes(F.lit("a\nb\nb\nc"))).alias("multiset"),
    ).first()
    assert row.asDict() == {"same": True, "deleted": True, "inserted": True, "multiset": False}


def test_odd_rows(spark, odd_docs):
    rows = fp.fingerprint_documents(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[2]["n_chars"] == 0 and by_id[2]["fingerprint"] == by_id[3]["fingerprint"] == "0" * 8 * fp.LANES
    assert by_id[2]["near_edited"] == 1.0
    assert by_id[8]["n_chars"] == len("été \U0001f600 naïve — 日本語 text with spaces")
    assert fp.fingerprint_documents(odd_docs.limit(0)).count() == 0
    single = fp.fingerprint_documents(odd_docs.where("doc_id = 1")).first()
    assert single["near_next"] == 1.0


def plain_lanes(text):
    """The sum of all paragraphs' lanes, paragraph by paragraph."""
    lanes = [0] * fp.LANES
    for p in re.split(fp.PARAGRAPH_END, text):
        if not p.strip(" "):
            continue
        for seed in range(fp.HASHES):
            chained = xxhash.xxh64_intdigest(struct.pack("<i", seed), seed=42)
            h = xxhash.xxh64_intdigest(p.encode(), seed=chained)
            for k in range(4):
                at = 4 * seed + k
                lanes[at] = (lanes[at] + (h >> 16 * k & 0xFFFF) - (1 << 15)) % fp.MODULUS
    return lanes


def plain_likeness(a, b):
    if a == b:
        return 1.0
    x, y = ([v - fp.MODULUS if v >= fp.HALF else v for v in lanes] for lanes in (a, b))
    norms = math.sqrt(sum(v * v for v in x)) * math.sqrt(sum(v * v for v in y))
    return min(1.0, max(0.0, sum(v * w for v, w in zip(x, y)) / norms)) if norms else 0.0


def test_fingerprints_and_likenesses_equal_plain_sums(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy(F.desc("doc_id")).collect()
    out = {r["doc_id"]: r for r in fp.op7_fingerprints(spark, SF).collect()}
    spelled = lambda lanes: "".join(f"{v:08x}" for v in lanes)
    for k, d in enumerate(docs):
        text, following = d["text"] or "", docs[(k + 1) % len(docs)]["text"] or ""
        half = len(text) // 2
        own, changed, after = (plain_lanes(t) for t in (text, text[: len(text) - half] + following[:half], following))
        got = out[d["doc_id"]]
        assert (got["fingerprint"], got["edited_fingerprint"]) == (spelled(own), spelled(changed))
        assert math.isclose(got["near_edited"], plain_likeness(own, changed), abs_tol=1e-9)
        assert math.isclose(got["near_next"], plain_likeness(own, after), abs_tol=1e-9)


def test_next_text_over_thousands_of_runs_and_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(fp, "ROWS_PER_RUN", 1)
    monkeypatch.setattr(fp, "BLOCK", 16)
    docs = spark.range(3000).select((F.col("id") * 17).alias("doc_id"), F.col("id").cast("string").alias("text"))
    got = {r["doc_id"]: r["next_text"] for r in fp.with_next(docs).collect()}
    assert got == {k * 17: str((k - 1) % 3000) for k in range(3000)}


def test_plan_has_no_python(spark):
    plan = fp.op7_fingerprints(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapInArrow", plan)
