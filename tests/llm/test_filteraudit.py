import re
from itertools import permutations

import pytest

from oracle_harness import compare
from trafficlens.llm import filteraudit as fa
from trafficlens.llm.registry import oracle_sql, queries

LABELS = "doc_id bigint, quality int, toxic int, part string, mask int"


def brute(docs, labels):
    """All counts by walking every document through every order."""
    texts = {}
    for doc_id, text, _ in docs:
        texts.setdefault(text or "", []).append(doc_id)
    out = {}
    for doc_id, text, lang in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
            "D": any(c in "#$%&*|" for c in t),
            "E": doc_id is not None and any(o is not None and o < doc_id for o in texts[t]),
        }
        good = any(i is not None and i == doc_id and q == 1 for i, q, _ in labels)
        toxic = any(i is not None and i == doc_id and x == 1 for i, _, x in labels)
        for order in permutations("ABCDE"):
            gone = False
            for step, name in enumerate(order, 1):
                row = out.setdefault((lang or "", "".join(order), step), [0] * 6)
                here = fails[name] and not gone
                row[0] += not gone and not fails[name]
                row[1] += here
                row[2] += fails[name] and gone
                row[3] += fails[name] and sum(fails.values()) == 1
                row[4] += here and good
                row[5] += here and toxic
                gone = gone or fails[name]
    shapley = {}
    for (part, order, step), row in out.items():
        key = part, order[step - 1]
        shapley[key] = shapley.get(key, 0) + row[1]
    return {(p, o, s): (*row, shapley[p, o[s - 1]]) for (p, o, s), row in out.items()}


def rows_of(df):
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in df.collect()}
    return found


def test_odd_documents_equal_brute_force(spark, odd_docs):
    labels = [(1, 1, 0), (5, 0, 1), (5, 1, None), (None, 1, 1), (9, None, None), (99, 1, 1)]
    got = rows_of(fa.audit_filters(odd_docs, spark.createDataFrame([(*r, "p", 3) for r in labels], LABELS)))
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in odd_docs.collect()]
    assert got == brute(docs, labels)
    assert sorted({p for p, _, _ in got}) == ["", "en", "fr"] and len(got) == 3 * 600


def test_copies_and_borders_equal_brute_force(spark):
    plain = " ".join(f"word{k}" for k in range(100))
    texts = [
        plain,
        " ".join(f"word{k}" for k in range(99)),
        " ".join(f"word{k % 80}" for k in range(100)),  # exactly 80 % distinct
        " ".join(f"word{k % 79}" for k in range(100)),
        "A" * 10 + "é" * 90,  # exactly 10 % upper case by code points
        "A" * 11 + "é" * 89,
        plain + " |",
        "a\x0bb\x1cc\u00a0d\u2003e",  # only the first is white space here
        "",
        None,
    ]
    docs = [(k, texts[k % len(texts)], ["en", "de", None, ""][k // 3 % 4], "x") for k in range(240)]
    docs += [(None, plain, "en", "x"), (3, plain, "en", "x"), (3, plain, "de", "x")]
    labels = [(k, k % 2, k % 3 % 2) for k in range(0, 200, 3)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, digest string").repartition(7)
    got = rows_of(fa.audit_filters(df, spark.createDataFrame([(*r, "p", 3) for r in labels], LABELS)))
    assert got == brute([d[:3] for d in docs], labels)


def test_fields_do_not_carry():
    """Sums far beyond any table stay inside their fields."""
    many = (1 << 62) // 3
    total = sum(many * n for n in fa.wide_counters()[5:8])
    fields = fa.unpacked(total)
    singles = [fa.unpacked(n) for n in fa.wide_counters()[5:8]]
    assert (fields == many * sum(singles)).all() and fields.max() == 3 * many


def test_every_mask_goes_somewhere():
    for mask, packed in enumerate(fa.wide_counters()):
        kept, removed, redundant = fa.unpacked(packed)[: 3 * fa.PLACES].reshape(3, len(fa.ORDERS), 5)
        assert (removed.sum(axis=1) == (mask > 0)).all()
        assert ((removed + redundant).sum(axis=1) == bin(mask).count("1")).all()
        assert (kept[:, -1] == (mask == 0)).all()


def test_empty_tables(spark, odd_docs):
    labels = spark.createDataFrame([], LABELS)
    assert fa.audit_filters(odd_docs.limit(0), labels).collect() == []
    assert {r[4] for r in rows_of(fa.audit_filters(odd_docs, labels)).values()} == {0}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    name = "op12_filteraudit"
    result = compare(spark, name, f"/root/testdata/{sf}", queries()[name], oracle_sql()[name])
    assert result["match"] and not result["type_mismatches"], result
