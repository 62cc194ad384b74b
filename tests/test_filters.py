"""Cleaning filters, namespace pattern, percent-encoding."""

import re
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from trafficlens.functions import namespace_regex, percent_encode, title_variants
from trafficlens.operators import clean_pages, drop_home_pages, drop_namespaces, match_title, only_projects

NS_CASES = [
    ("Spécial:Recherche", True),
    ("Sp%C3%A9cial:X", True),
    ("Sp%C3%A9cial%3AX", True),
    ("Sp%C3%A9cial%3aX", True),
    ("Special:Search", True),
    ("Catégorie:Peinture", True),
    ("Gadget_definition:X", True),
    ("Discussion:Paris", True),
    ("Discussion_utilisateur:Bob", True),
    ("Discussions:_film", True),  # parity: a talk-like article is dropped
    ("Discussion_Wikip%C3%A9dia:Y", False),  # parity: the encoded talk page slips through
    ("spécial:X", False),  # case-sensitive
    ("Paris", False),
    ("Special_Forces", False),
    ("Modèle", False),  # prefix without separator
]


@pytest.mark.parametrize("title,dropped", NS_CASES)
def test_namespace_pattern_python(title, dropped):
    assert bool(re.search(namespace_regex(), title)) is dropped


def test_namespace_pattern_spark(spark):
    df = spark.createDataFrame([(t,) for t, _ in NS_CASES], "title string")
    kept = {r.title for r in drop_namespaces(df).collect()}
    assert kept == {t for t, dropped in NS_CASES if not dropped}


def test_home_pages_raw_and_encoded(spark):
    titles = ["-", "Main_Page", "Page_d'accueil", "Page_d%27accueil", "Wikip%C3%A9dia%3AAccueil_principal", "Paris"]
    df = spark.createDataFrame([(t,) for t in titles], "title string")
    assert [r.title for r in drop_home_pages(df).collect()] == ["Paris"]


def test_project_allow_list(spark):
    df = spark.createDataFrame([(p, "X") for p in ["fr", "fr.m", "fr.b", "fr.d", "en", "fr.n"]], "project string, title string")
    assert sorted(r.project for r in only_projects(df).collect()) == ["fr", "fr.m"]


def test_clean_pages_drops_empty(spark):
    df = spark.createDataFrame([("fr", ""), ("fr", "Paris"), ("fr.m", "Main_Page")], "project string, title string")
    assert [r.title for r in clean_pages(df).collect()] == ["Paris"]


SAMPLES = [chr(c) for c in range(32, 127)] + ["é", "í", "ß", "中文", "😀", "a b*c~d+e", "Sagrada_Família", "C++"]


def test_percent_encode_matches_strict_quote(spark):
    df = spark.createDataFrame([(s,) for s in SAMPLES], "s string")
    got = {r.s: r.e for r in df.select("s", percent_encode("s").alias("e")).collect()}
    assert got == {s: quote(s, safe="") for s in SAMPLES}


def test_title_variants_and_match(spark):
    df = spark.createDataFrame([("Sagrada_Família",), ("Paris",)], "t string")
    rows = {r.t: r.v for r in df.select("t", title_variants("t").alias("v")).collect()}
    assert rows == {"Sagrada_Família": ["Sagrada_Família", "Sagrada_Fam%C3%ADlia"], "Paris": ["Paris"]}
    pv = spark.createDataFrame(
        [("Sagrada_Família",), ("Sagrada_Fam%C3%ADlia",), ("Sagrada_Fam%c3%adlia",), ("sagrada_família",)],
        "title string",
    )
    assert match_title(pv, "Sagrada_Família").count() == 2
    assert pv.where(F.col("title").isNull()).count() == 0


def test_title_guard_and_reader(spark, tmp_path):
    from trafficlens.operators import check_titles, unknown_titles
    from trafficlens.sources import read_titles

    csv = tmp_path / "monuments.csv"
    csv.write_text("title\n Tour_Eiffel \nSagrada_Família\n\nTour_Eiffel\n", encoding="utf-8")
    known = read_titles(spark, str(csv))
    assert sorted(r.title for r in known.collect()) == ["Sagrada_Família", "Tour_Eiffel"]
    missing = read_titles(spark, str(tmp_path / "absent.csv"))
    assert missing.count() == 0

    asked = spark.createDataFrame([("Tour_Eiffel",), ("Mont-Saint-Michel",)], "title string")
    assert [r.title for r in unknown_titles(asked, known).collect()] == ["Mont-Saint-Michel"]
    with pytest.raises(ValueError, match="Mont-Saint-Michel"):
        check_titles(asked, known)
    check_titles(asked, known, force=True)  # forced
    check_titles(asked, missing)  # no reference list: guard skipped
