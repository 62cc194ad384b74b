"""URL filter: host and path rules, and a logistic regression on hashed character n-grams for the rest.

The classifier is fitted on a small labelled table of URLs (LABELLED_URLS by
default, MAX_LABELLED rows at most) in numpy: every character n-gram of the host
and, in another half of the table, of the path is hashed to a weight, and a URL's
score is the logistic of their scaled sum. Scoring reads the ``url`` column
only, row by row inside the scan's tasks: nothing is shuffled or collected, and
what is broadcast is the weight table and the rules, both of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import row_slices, table

GRAMS = (3, 4, 5)
SLOTS = 1 << 18  # hashed weights, the lower half for hosts and the upper one for paths
GRAM_VALUE = 1 / 8
PRIOR = 0.1  # share of unwanted URLs where no n-gram is known; the labelled classes are weighted to it
RIDGE = 3e-6
STEPS = 600
RATE = 2.0
BLOCK = 0.5
MAX_LABELLED = 100_000
MAX_RULES = 10_000
ROWS_AT_ONCE = 4096


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host, its subdomains, and paths that begin with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)

# The labelled table: unwanted kinds of sites (gambling, adult, pills, tracking, link farms, scams), and ordinary ones.
UNWANTED_HOSTS = (
    "casino-bonus", "online-casino", "best-casinos", "royalcasino", "slots-win", "win-jackpot",
    "bets-live", "free-betting", "sports-bet", "bet-now", "poker-room", "lucky-poker",
    "bingo-free", "roulette-online", "gambling-tips", "casino", "betting", "win-big-casino", "free-bet",
    "adult-video", "adults-only", "xxx-tube", "x-rated", "porn-clips", "sex-cams",
    "escort-girls", "hot-nude", "adult-dating", "adult-games", "free-porn", "sexshop-x", "xxx-videos",
    "cheap-meds", "pills-online", "buy-pills", "viagra-cheap", "cheap-pharmacy", "diet-pill",
    "no-rx-drugs", "viagra-pills", "cheap-viagra",
    "ads-server", "adserver", "track-click", "ad-track", "click-tracker", "popup-ads",
    "banner-ads", "pixel-tracking", "ads-network", "tracking-ads",
    "spam-links", "link-farm", "seo-farm", "spam-blast", "bulk-spam", "backlinks-farm",
    "free-money", "cash-fast", "payday-loans", "replica-watches", "get-rich", "prize-winner",
    "free-iphone", "crack-keygen", "warez-download", "torrent-free", "malware-host", "phishing-login",
)
ORDINARY_HOSTS = (
    "news", "daily-news", "weather", "library", "university", "history-museum", "science",
    "open-data", "wiki", "encyclopedia", "recipes", "cooking", "travel-guide", "city-hall",
    "government", "health-service", "hospital", "school", "courses", "software-docs",
    "developer", "code-review", "photography", "music-lessons", "garden", "bookshop",
    "publisher", "magazine", "football-club", "chess", "theatre", "cinema", "architecture",
    "railway", "airport", "bakery", "furniture", "farmers-market", "village", "adventure",
    "addresses", "trade-union", "betterment", "alphabet", "essex", "pillow", "shadow",
    "roadside", "winter", "window", "darwin", "cashmere", "diabetes", "spanish",
    "contrack", "truck-parts", "thesis", "nation", "station", "others", "thread",
)
UNWANTED_PATHS = (
    "/casino/bonus", "/bet/now", "/xxx/video", "/adult/tube", "/cheap-pills/buy", "/viagra", "/click/track", "/ads/banner",
    "/spam/offer", "/free-money/win", "/poker/room", "/keygen/crack",
)
ORDINARY_PATHS = (
    "/", "", "/en/12", "/de/345.html", "/fr/6789", "/es/43210/", "/about", "/news/2024/01/05", "/article/512", "/index.html",
    "/docs/guide", "/wiki/History", "/blog/post-7", "/contact", "/library/books", "/recipes/bread", "/category/science",
)
SITES = ("", "www.", "m.", "blog.")
ENDINGS = ("com", "net", "org", "info", "example.com", "example.net", "example.org")


def labelled_urls() -> list[tuple[str, int]]:
    """(url, 1 for unwanted): every host with a few ordinary paths, and unwanted paths on ordinary hosts."""
    rows = []
    for label, hosts in ((1, UNWANTED_HOSTS), (0, ORDINARY_HOSTS)):
        for k, host in enumerate(hosts):
            for j, site in enumerate(SITES):
                path, ending = ORDINARY_PATHS[(4 * k + j) % len(ORDINARY_PATHS)], ENDINGS[(k + j) % len(ENDINGS)]
                rows.append((f"https://{site}{host}.{ending}{path}", label))
    for k, path in enumerate(UNWANTED_PATHS):
        rows.append((f"https://{ORDINARY_HOSTS[k]}.{ENDINGS[k % len(ENDINGS)]}{path}", 1))
    return rows


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host (A-Z in lower case) and path of a URL; both empty without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((at for at in map(rest.find, "/?#") if at >= 0), default=len(rest))
    host, tail = rest[:end], rest[end:]
    path = tail.split("#", 1)[0].split("?", 1)[0]
    return host.encode("utf-8").lower().decode("utf-8"), path


def gram_slots(texts: list[str], half: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all character n-grams of all texts, and to which text each belongs.

    A text is read between two marks, so its ends have n-grams of their own.
    """
    marked = [f"\x02{text}\x03" for text in texts]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    code = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(marked)), lengths)
    slots, of = [], []
    for size in GRAMS:
        many = len(code) - size + 1
        if many <= 0:
            continue
        total = np.full(many, size, np.uint64)
        for k in range(size):
            total = (total ^ code[k : k + many]) * np.uint64(0x9E3779B97F4A7C15)
            total ^= total >> np.uint64(29)
        inside = np.flatnonzero(owner[:many] == owner[size - 1 :])
        slots.append((total[inside] % np.uint64(SLOTS // 2)).astype(np.int64) + half * (SLOTS // 2))
        of.append(owner[inside])
    if not slots:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(slots), np.concatenate(of)


def features(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Slots and owners of the n-grams of hosts and paths; each n-gram counts GRAM_VALUE, however long its URL."""
    found = [gram_slots(texts, half) for half, texts in enumerate((hosts, paths))]
    return tuple(np.concatenate(side) for side in zip(*found))


@dataclass(frozen=True)
class UrlClassifier:
    """Weights by slot and the intercept."""

    weights: np.ndarray
    intercept: float

    def score(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        slots, of = features(hosts, paths)
        total = GRAM_VALUE * np.bincount(of, weights=self.weights[slots], minlength=len(hosts))
        return 1.0 / (1.0 + np.exp(-np.clip(total + self.intercept, -30, 30)))


def train_urls(rows: Iterable[tuple[str | None, int]]) -> UrlClassifier:
    """Logistic regression by accelerated gradient steps with a ridge; without both classes every score is about 0.

    The intercept is the prior's, so a URL without a known n-gram is not unwanted. Rows with equal URLs each count.
    """
    rows = [(url, label) for url, label in rows if label in (0, 1)]
    y = np.array([label for _, label in rows], np.float64)
    if not len(y) or y.min() == y.max():
        return UrlClassifier(np.zeros(SLOTS), -30.0)
    parsed = [host_and_path(url) for url, _ in rows]
    slots, of = features([h for h, _ in parsed], [p for _, p in parsed])
    share = np.where(y > 0, PRIOR / y.mean(), (1 - PRIOR) / (1 - y.mean())) / len(y)
    intercept = float(np.log(PRIOR / (1 - PRIOR)))
    weights = ahead = np.zeros(SLOTS)
    for step in range(STEPS):
        margin = GRAM_VALUE * np.bincount(of, weights=ahead[slots], minlength=len(y)) + intercept
        gap = (1.0 / (1.0 + np.exp(-np.clip(margin, -30, 30))) - y) * share
        slope = GRAM_VALUE * np.bincount(slots, weights=gap[of], minlength=SLOTS) + RIDGE * ahead
        after = ahead - RATE * slope
        ahead = after + step / (step + 3.0) * (after - weights)
        weights = after
    return UrlClassifier(weights, intercept)


def longest_rule(host: str, path: str, rules: dict[str, list[Rule]]) -> Rule | None:
    """The longest rule that fits a host or one of the domains above it and begins the path."""
    best: Rule | None = None
    at = 0
    while at >= 0:
        for rule in rules.get(host[at:], ()):
            if path.startswith(rule.path) and (best is None or len(rule.text) > len(best.text)):
                best = rule
        dot = host.find(".", at)
        at = dot + 1 if dot >= 0 else -1
    return best


def by_host(rules: Iterable[Rule]) -> dict[str, list[Rule]]:
    """Rules by host, each host's in the order of their text; MAX_RULES at most."""
    found: dict[str, list[Rule]] = {}
    for rule in sorted(rules, key=lambda r: (r.text, r.host, r.verdict)):
        if rule.verdict not in ("allow", "block"):
            raise ValueError(f"a rule's verdict is allow or block, not {rule.verdict!r}")
        found.setdefault(rule.host, []).append(rule)
    if sum(map(len, found.values())) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    return found


def judge_urls(pages: DataFrame, rules: Iterable[Rule] = RULES, labelled: DataFrame | None = None) -> DataFrame:
    """Host, path, rule and verdict of every URL: page_id, host, path, rule, score, verdict.

    ``pages`` needs page_id and url; other columns are ignored. ``labelled`` (url,
    label 0 or 1, MAX_LABELLED rows at most, or ValueError) trains the classifier in
    place of the built-in table. A null URL or one without ``://`` has an empty host
    and path, fits no rule and is judged by the classifier like any other; URLs that
    fit a rule have the classifier's score as well. Of equally long rules the first in text order wins.
    Repeated rows are judged alike; an empty table gives no rows.
    """
    if labelled is None:
        rows = labelled_urls()
    else:
        rows = [(r["url"], r["label"]) for r in labelled.select("url", "label").limit(MAX_LABELLED + 1).collect()]
        if len(rows) > MAX_LABELLED:
            raise ValueError(f"more than {MAX_LABELLED} labelled URLs")
    spark = pages.sparkSession
    shared = spark.sparkContext.broadcast((by_host(rules), train_urls(sorted(rows, key=lambda r: (r[0] or "", r[1])))))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, model = shared.value
        for batch in row_slices(batches, ROWS_AT_ONCE):
            parsed = [host_and_path(url) for url in batch.column(1).to_pylist()]
            hosts, paths = [h for h, _ in parsed], [p for _, p in parsed]
            found = [longest_rule(h, p, known) for h, p in parsed]
            scores = model.score(hosts, paths)
            verdicts = [r.verdict if r else "block" if s >= BLOCK else "allow" for r, s in zip(found, scores)]
            columns = [
                batch.column(0),
                pa.array(hosts, pa.string()),
                pa.array(paths, pa.string()),
                pa.array([r.text if r else None for r in found], pa.string()),
                pa.array(scores),
                pa.array(verdicts, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "host", "path", "rule", "score", "verdict"])

    slim = pages.select("page_id", F.col("url").cast("string").alias("url"))
    kind = slim.schema["page_id"].dataType.simpleString()
    return slim.mapInArrow(judge, f"page_id {kind}, host string, path string, rule string, score double, verdict string")


def op13_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))
