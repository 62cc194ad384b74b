import re

import numpy as np
import pytest

from trafficlens.llm import urlfilter as uf
from trafficlens.llm.registry import queries

SCHEMA = "page_id bigint, url string, html string, host string, score string"


def plain_judgement(url):
    """Host, path, rule and rule's verdict by the words of the contract."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url[url.index("://") + 3 :]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(h + p), h + p, verdict)
        for h, p, verdict in (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


ODD = [
    None, "", "no scheme", "http://", "http:///path", "HTTP://WWW.Example.NET/en/1", "http://example.net/EN/1", "https://a.net",
    "https://a.net/", "https://a.net?x=/en/", "https://a.net#/", "http://notexample.net/en/2", "http://anet/x", "http://net/", "http://x.org/fr/?q",
    "http://x.org/fr", "http://exampleXorg/fr/", "ftp://u:p@m.example.com:80/de/", "http://m.example.com/de/#top", "http://a.b/c://d.net/",
    "http://É.ORG/fr/é", "http://\U0001f600.net/\U0001f600?", "http://x.net/" + "p" * 100_000, "http://" + "h." * 20_000 + "org/fr/",
    "http://a.com/x?y#z", "http://.net/", "http://net./",
]


def test_hosts_paths_and_rules(spark):
    rows = [(k, url, None, "h", "s") for k, url in enumerate(ODD)] + [(0, None, None, "h", "s"), (None, ODD[5], "", "", "")]
    found = uf.judge_urls(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(found) == len(rows)
    for r in found:
        url = ODD[r["page_id"]] if r["page_id"] is not None else ODD[5]
        host, path, rule, verdict = plain_judgement(url)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), url
        assert r["verdict"] == (verdict or ("block" if r["score"] >= 0.5 else "allow")), url


def test_query_equals_brute_force_on_whole_table(spark):
    sf_dir = "/root/testdata/sf0.1"
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect()}
    found = queries()["op13_urlfilter"](spark, sf_dir).collect()
    model = uf.train_urls(uf.labelled_urls())
    assert sorted(r["page_id"] for r in found) == sorted(urls)
    for r in found:
        host, path, rule, verdict = plain_judgement(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        # The classifier's sum, one n-gram after the other.
        assert abs(r["score"] - plain_score(model, host, path)) < 1e-9
        assert r["verdict"] == (verdict or ("block" if r["score"] >= 0.5 else "allow"))


def plain_score(model, host, path):
    total = model.intercept
    mask = (1 << 64) - 1
    for half, text in enumerate((host, path)):
        marked = f"\x02{text}\x03"
        for size in uf.GRAMS:
            for at in range(len(marked) - size + 1):
                h = size
                for c in marked[at : at + size]:
                    h = (h ^ ord(c)) * 0x9E3779B97F4A7C15 & mask
                    h ^= h >> 29
                total += uf.GRAM_VALUE * model.weights[h % (uf.SLOTS // 2) + half * (uf.SLOTS // 2)]
    return 1 / (1 + np.exp(-min(30, max(-30, total))))


def test_held_out_hosts():
    """Hosts that the training rows lack: ordinary ones stay, and most unwanted ones with a known word in them go."""
    rows = uf.labelled_urls()
    hosts = [(h, 1) for h in uf.UNWANTED_HOSTS] + [(h, 0) for h in uf.ORDINARY_HOSTS]

    def name(url):
        labels = uf.host_and_path(url)[0].split(".")
        return labels[1] if labels[0] in ("www", "m", "blog") else labels[0]

    right = {0: [], 1: []}
    for fold in range(10):
        held = {h for h, _ in hosts[fold::10]}
        model = uf.train_urls([r for r in rows if name(r[0]) not in held])
        test = [r for r in rows if name(r[0]) in held]
        parsed = [uf.host_and_path(url) for url, _ in test]
        scores = model.score([h for h, _ in parsed], [p for _, p in parsed])
        for (_, label), score in zip(test, scores):
            right[label].append((score >= 0.5) == label)
    assert np.mean(right[0]) >= 0.93 and np.mean(right[1]) >= 0.45


def test_fitted_rows_and_unknown_text():
    model = uf.train_urls(uf.labelled_urls())
    rows = uf.labelled_urls()
    parsed = [uf.host_and_path(url) for url, _ in rows]
    scores = model.score([h for h, _ in parsed], [p for _, p in parsed])
    assert all((s >= 0.5) == label for s, (_, label) in zip(scores, rows))
    assert model.score(["", "qqqq.zzz"], ["", "/"]).max() < 0.3


def test_own_rules_and_labels(spark):
    labelled = spark.createDataFrame(
        [("http://zork.com/a", 1), ("http://zorkmid.com/b", 1), ("http://plain.com/a", 0), ("http://other.com/b", 0), (None, 0), ("x", None)],
        "url string, label int",
    )
    pages = spark.createDataFrame([(1, "http://zork.com/q"), (2, "http://plain.com/q"), (3, "http://my.site/q")], "page_id int, url string")
    rules = [uf.Rule("site", "", "block"), uf.Rule("my.site", "", "allow"), uf.Rule("my.site", "/q", "block")]
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in uf.judge_urls(pages, rules, labelled).collect()}
    assert got == {1: (None, "block"), 2: (None, "allow"), 3: ("my.site/q", "block")}
    one_class = labelled.where("label = 0")
    assert {r["verdict"] for r in uf.judge_urls(pages, (), one_class).collect()} == {"allow"}
    with pytest.raises(ValueError):
        uf.by_host([uf.Rule("a", "", "maybe")])


def test_empty_table(spark):
    assert uf.judge_urls(spark.createDataFrame([], SCHEMA)).collect() == []
