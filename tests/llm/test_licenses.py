import math
import random
import re

from oracle_harness import compare
from trafficlens.llm import licenses
from trafficlens.llm.licenses import BASE_PHRASES, op8_licenses, scan_licenses
from trafficlens.llm.registry import oracle_sql, queries

SF = "/root/testdata/sf0.01"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(text):
    words = WORD.findall((text or "").translate(LOWER))
    starts, labels = [], set()
    for phrase, label in BASE_PHRASES.items():
        parts = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        starts += at
        labels |= {label} if at else set()
    first, last = (min(starts), max(starts)) if starts else (None, None)
    return len(words), len(starts), first, last, ",".join(sorted(labels))


def test_base_places_match_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op8_licenses(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert brute(docs[r["doc_id"]]) == (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
    assert any(r["n_base"] for r in rows)


def test_templates_by_position(spark):
    grant = (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction"
    )
    scattered = " ".join(reversed(grant.split()))
    texts = [
        grant,
        scattered,
        "Free software; software, free permission granted person copy",
        "x MIT\nLicense, mit--license! CC-BY 4.0",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        "Mit Licence of the GNU general public",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r["doc_id"]: r for r in scan_licenses(docs).collect()}
    assert got[0]["labels"] == "mit" and got[0]["n_base"] == 0 and got[0]["score"] > 0.9
    assert got[1]["labels"] == "" and got[2]["labels"] == "" and got[5]["labels"] == ""
    assert got[3]["base_labels"] == "cc-by,mit" and (got[3]["n_base"], got[3]["first_word"]) == (3, 1)
    assert got[4]["labels"] == "bsd"


def test_odd_rows(spark, odd_docs):
    rows = scan_licenses(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert (r["labels"], r["score"], r["first_word"]) == ("", 0.0, None)
    assert {r["n_words"] for r in rows if r["doc_id"] in (2, 3)} == {0}
    assert scan_licenses(odd_docs.limit(0)).count() == 0


def test_every_notice_of_a_file_is_found(spark):
    notices = {}
    for labels, notice, _ in licenses.TEMPLATES:
        notices.setdefault(labels[0], notice)
    pairs = [(a, b) for a in notices for b in notices if a < b]
    texts = [f"{notices[a]} some other line here {notices[b]}" for a, b in pairs]
    # Files that make the words of some notices common, so the others' words are the rarer ones.
    common = ["all rights reserved", notices["lgpl"], notices["gpl"], notices["mpl"], notices["cc-by-nc"]] * 40
    texts += common + [" and ".join(notices.values())]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r["doc_id"]: set(r["labels"].split(",")) for r in scan_licenses(docs).collect()}
    missed = [pair for k, pair in enumerate(pairs) if not set(pair) <= got[k]]
    assert missed == [] and set(notices) <= got[len(texts) - 1]


def brute_templates(texts):
    """Labels and score of every text: every template at every place, weighed and compared word by word."""
    words = [WORD.findall((t or "").translate(LOWER)) for t in texts]
    known = set(licenses.VOCABULARY)
    holding = [set(w) & known for w in words]
    count = {w: sum(w in h for h in holding) for w in known}
    idf = {w: math.log((len(texts) + 1) / n) if n else 1e-9 for w, n in count.items()}
    out = []
    for own in words:
        labels, score, joined = set(), 0.0, f" {' '.join(own)} "
        where = {}
        for i, w in enumerate(own):
            where.setdefault(w, []).append(i)
        for names, notice, phrases in licenses.TEMPLATES:
            if not any(f" {p} " in joined for p in phrases):
                continue
            indexed = [(k, w) for k, w in enumerate(notice.split()) if w in known]
            total = sum(idf[w] for _, w in indexed)
            for offset in {i - k for k, w in indexed for i in where.get(w, ())}:
                here = [w for k, w in indexed if 0 <= k + offset < len(own) and own[k + offset] == w]
                coverage = sum(idf[w] for w in here) / total
                if coverage >= licenses.MIN_COVERAGE and len(set(here)) >= min(licenses.MIN_VOTES, len({w for _, w in indexed})):
                    labels |= set(names)
                    score = max(score, min(1.0, coverage))
        for phrase, label in BASE_PHRASES.items():
            labels |= {label} if f" {phrase} " in joined else set()
        out.append((",".join(sorted(labels)), score))
    return out


def same(rows, texts):
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in rows}
    for k, (labels, score) in enumerate(brute_templates(texts)):
        assert got[k][0] == labels, (k, got[k], labels, score, texts[k][:300])
        assert math.isclose(got[k][1], score, abs_tol=1e-6), (k, got[k], score)


def test_labels_and_scores_equal_a_scan_of_all_templates_at_all_places(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    texts = {r["doc_id"]: r["text"] for r in docs}
    order = sorted(texts)
    rows = op8_licenses(spark, SF).collect()
    renamed = [{"doc_id": order.index(r["doc_id"]), "labels": r["labels"], "score": r["score"]} for r in rows]
    same(renamed, [texts[i] for i in order])
    assert any(r["score"] > 0 for r in rows)


def test_torn_mixed_and_versioned_notices_equal_the_scan(spark):
    rng = random.Random(8)
    notices = [notice for _, notice, _ in licenses.TEMPLATES]
    texts = list(notices)
    for _ in range(250):
        parts = []
        for notice in rng.sample(notices, rng.randint(1, 3)):
            words = notice.split()
            kept = [w for w in words if rng.random() > rng.choice([0, 0.1, 0.3])]
            for _ in range(rng.choice([0, 0, 2])):
                kept.insert(rng.randrange(len(kept) + 1), rng.choice(["filler", *rng.choice(notices).split()]))
            parts += kept + ["other", "words", "here"] * rng.randint(0, 2)
        texts.append(" ".join(parts))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    rows = scan_licenses(df).collect()
    same(rows, texts)
    for r in rows:
        if r["doc_id"] < len(notices):  # each notice alone has its labels, family and version
            assert set(licenses.TEMPLATES[r["doc_id"]][0]) <= set(r["labels"].split(","))


def test_base_phrases_score_by_the_method(spark):
    texts = ["see the MIT license", "the GNU General Public License!", "Apache-License", "CC BY", "mit", "license", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in scan_licenses(df).collect()}
    assert got == {0: ("mit", 1.0), 1: ("gpl", 1.0), 2: ("apache", 1.0), 3: ("cc-by", 1.0), 4: ("", 0.0), 5: ("", 0.0), 6: ("", 0.0)}


def test_plan_has_no_python(spark):
    plan = op8_licenses(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapInArrow", plan)


def test_query_equals_sql(spark):
    result = compare(spark, "op8_licenses", SF, queries()["op8_licenses"], oracle_sql()["op8_licenses"])
    assert result["match"] and not result["type_mismatches"], result
