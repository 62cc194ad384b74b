"""Licence scan by a positional index of rare licence words.

Each licence notice is a template of words with postings (word, place). A file is
looked up by the highest-IDF licence words it holds, template by template: in order of
their IDF until the words taken carry more weight than a passing alignment may lack.
Two of them that agree on the difference between their place in the file and their
place in the template vote for the same alignment, so every alignment that can
pass is found. Alignments are then scored over all words of the template by IDF
weight, and kept only when a mandatory key phrase of the licence stands in the file.
Everything is a DataFrame expression; the postings are a constant of this package, so
their broadcast has a fixed size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, text_or_empty, written
from .notices import FUNCTION_WORDS, TEMPLATES

# Base phrases and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

MIN_VOTES = 2  # looked-up words that must agree on one alignment
MIN_COVERAGE = 0.6  # share of the template's weight found in place

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SEPARATORS = "".join(chr(c) for c in range(1, 0x80) if not chr(c).isalnum()) + "\x00"

VOCABULARY = sorted({w for _, notice, _ in TEMPLATES for w in notice.split()} - set(FUNCTION_WORDS))
KEY_PHRASES = sorted({p for _, _, phrases in TEMPLATES for p in phrases})
_FIRST_WORDS = sorted({p.split()[0] for p in BASE_PHRASES})


def licence_words(text: Column) -> Column:
    """Words of a text: A-Z lowered, split at every other ASCII character that is no digit or letter."""
    spaced = F.translate(text, _UPPER + _SEPARATORS, _UPPER.lower() + " " * len(_SEPARATORS))
    return F.array_remove(F.split(spaced, " "), "")


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _starts(words: Column, phrase: str) -> Column:
    """Places at which the phrase's words stand consecutively."""
    parts = phrase.split()

    def here(_, i: Column) -> Column:
        test = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            test = test & F.coalesce(F.get(words, i + k) == part, F.lit(False))
        return test

    indexes = F.transform(words, lambda _, i: i)
    return F.filter(indexes, lambda at: here(None, at))


def postings(spark: SparkSession) -> DataFrame:
    """(template, word, place): one row per indexed word of every template, a constant."""
    known = set(VOCABULARY)
    rows = [
        (number, word, place)
        for number, (_, notice, _) in enumerate(TEMPLATES)
        for place, word in enumerate(notice.split())
        if word in known
    ]
    return spark.createDataFrame(rows, "template int, word string, place int")


def scan_words(docs: DataFrame) -> DataFrame:
    """One row per document: word count, base places, licence words with places, key phrases present.

    The costly expressions run only on files that hold a licence word at all.
    """
    none = F.expr("cast(array() as array<int>)")
    frame = docs.select("doc_id", licence_words(text_or_empty()).alias("words"))
    frame = frame.withColumn("present", F.array_intersect("words", _strings(VOCABULARY)))
    frame = frame.withColumn("indexed", F.size("present") > 0)
    frame = frame.withColumn("based", F.arrays_overlap("words", _strings(_FIRST_WORDS)))
    words = F.col("words")
    starts = [F.when(F.col("based"), _starts(words, p)).otherwise(none) for p in BASE_PHRASES]
    frame = frame.withColumn("starts", F.array(*starts))
    flat = F.flatten("starts")
    base = F.array_sort(
        F.array_distinct(
            F.array_compact(
                F.array(
                    *[
                        F.when(F.size(F.col("starts")[k]) > 0, F.lit(label))
                        for k, label in enumerate(BASE_PHRASES.values())
                    ]
                )
            )
        )
    )
    hits = F.filter(
        F.transform(words, lambda w, i: F.struct(i.alias("at"), w.alias("word"))),
        lambda hit: F.array_contains("present", hit["word"]),
    )
    spaced = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    frame = frame.withColumn("spaced", F.when(F.col("indexed"), spaced))
    return frame.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        F.size(flat).cast("bigint").alias("n_base"),
        F.array_min(flat).cast("bigint").alias("first_word"),
        F.array_max(flat).cast("bigint").alias("last_word"),
        base.alias("base"),
        F.when(F.col("indexed"), hits).alias("hits"),
        F.when(
            F.col("indexed"),
            F.filter(_strings(KEY_PHRASES), lambda p: F.col("spaced").contains(F.concat(F.lit(" "), p, F.lit(" ")))),
        ).alias("phrases"),
    )


def word_weights(hits: DataFrame, files: int) -> DataFrame:
    """(word, idf) of the licence words in (row, word) hits over ``files`` files; a constant number of rows at most."""
    return (
        hits.select("row", "word")
        .distinct()
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("files_with"))
        .select("word", F.log((F.lit(files) + 1) / F.col("files_with")).alias("idf"))
    )


def looked_up(words: Column, total: Column) -> Column:
    """Of a file's (idf, word) of one template the rarest, until those but the first outweigh what an alignment may lack.

    An alignment of MIN_COVERAGE lacks at most the rest of the weight, so it holds two
    of these words (one, if the template has no more).
    """
    rising = F.sort_array(words, asc=False)
    spare = F.lit(1 - MIN_COVERAGE + 1e-9) * total
    start = F.struct(F.lit(0.0).alias("behind"), F.expr("cast(array() as array<string>)").alias("taken"))

    def take(state: Column, one: Column) -> Column:
        done = state["behind"] > spare
        first = F.size(state["taken"]) == 0
        behind = state["behind"] + F.when(first, F.lit(0.0)).otherwise(one["idf"])
        return F.when(done, state).otherwise(
            F.struct(behind.alias("behind"), F.concat(state["taken"], F.array(one["word"])).alias("taken"))
        )

    return F.aggregate(rising, start, take, lambda state: state["taken"])


def match_templates(scanned: DataFrame) -> DataFrame:
    """(row, labels, coverage) of every template alignment that passes votes, coverage and key phrase."""
    spark = scanned.sparkSession
    index = postings(spark)
    hits = scanned.where("hits is not null").select("row", F.inline("hits"))
    weighted = index.join(word_weights(hits, scanned.count()), "word", "left").withColumn(
        "idf", F.coalesce("idf", F.lit(1e-9))
    )
    template = Window.partitionBy("template")
    weighted = weighted.withColumn("total", F.sum("idf").over(template)).withColumn(
        "needed", F.least(F.lit(MIN_VOTES), F.size(F.collect_set("word").over(template)))
    )
    weighted = written(weighted, "license_index")
    words = weighted.select("template", "word", "idf", "total").distinct()
    # A template's words are its own few: the set of a file and template is bounded.
    chosen = (
        hits.select("row", "word")
        .distinct()
        .join(F.broadcast(words), "word")
        .groupBy("row", "template", "total")
        .agg(F.collect_set(F.struct("idf", "word")).alias("words"))
        .select("row", "template", F.explode(looked_up(F.col("words"), F.col("total"))).alias("word"))
    )
    placed = hits.join(F.broadcast(weighted), "word").withColumn("offset", F.col("at") - F.col("place"))
    votes = (
        placed.join(chosen, ["row", "template", "word"], "left_semi")
        .groupBy("row", "template", "offset")
        .agg(F.countDistinct("word").alias("votes"), F.first("needed").alias("needed"))
        .where(F.col("votes") >= F.col("needed"))
        .select("row", "template", "offset")
    )
    aligned = (
        placed.join(votes, ["row", "template", "offset"], "left_semi")
        .groupBy("row", "template", "offset")
        .agg((F.sum("idf") / F.first("total")).alias("coverage"))
        .where(F.col("coverage") >= MIN_COVERAGE)
        .groupBy("row", "template")
        .agg(F.max("coverage").alias("coverage"))
    )
    keys = spark.createDataFrame(
        [(number, list(labels), phrases) for number, (labels, _, phrases) in enumerate(TEMPLATES)],
        "template int, labels array<string>, keys array<string>",
    )
    present = scanned.where("size(phrases) > 0").select("row", "phrases")
    return (
        aligned.join(F.broadcast(keys), "template")
        .join(present, "row")
        .where(F.arrays_overlap("phrases", "keys"))
        .select("row", "labels", F.least("coverage", F.lit(1.0)).alias("coverage"))
    )


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Licence labels of every document.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A null or
    empty text has no words, no places, empty labels and score 0. Repeated rows
    are scanned separately. ``score`` is the best coverage of a verified template to six
    digits (sums of weights depend on their order in the last bits), or 0; a base phrase is a template of its own, so a text that holds one scores 1.
    """
    scanned = written(scan_words(docs), "license_words")
    found = (
        match_templates(scanned)
        .groupBy("row")
        .agg(F.array_distinct(F.flatten(F.collect_set("labels"))).alias("found"), F.max("coverage").alias("coverage"))
    )
    empty = F.expr("cast(array() as array<string>)")
    joined = scanned.join(found, "row", "left")
    return joined.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("found", empty))), ",").alias("labels"),
        F.round(F.coalesce("coverage", F.lit(0.0)), 6).alias("score"),
    )


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


# ---------------------------------------------------------------------- SQL --


def license_sql() -> str:
    """The same scan in DuckDB, without an index: every template at every place that shares a word with it."""

    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    def texts(values) -> str:
        return "[" + ", ".join(map(text, values)) + "]"

    templates = ", ".join(
        f"({number}, {texts(labels)}, {text(notice)}, {texts(phrases)})"
        for number, (labels, notice, phrases) in enumerate(TEMPLATES)
    )
    starts = []
    for phrase, label in BASE_PHRASES.items():
        parts = phrase.split()
        joins = "".join(
            f" join w w{k} on w{k}.id = w0.id and w{k}.spot = w0.spot + {k} and w{k}.word = {text(part)}"
            for k, part in enumerate(parts[1:], 1)
        )
        starts.append(f"select w0.id, w0.spot, {text(label)} as label from w w0{joins} where w0.word = {text(parts[0])}")
    return f"""
with d as materialized (
  select row_number() over (order by doc_id) as id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words
  from documents),
w as materialized (select id, unnest(words) as word, generate_subscripts(words, 1) - 1 as spot from d),
tpl(template, labels, notice, phrases) as (values {templates}),
idx as (select * from (select template, unnest(string_split(notice, ' ')) as word, generate_subscripts(string_split(notice, ' '), 1) - 1 as place from tpl)
        where word not in {"(" + ", ".join(map(text, FUNCTION_WORDS)) + ")"}),
idf as (select word, ln(((select count(*) from d) + 1) / count(distinct id)) as idf from w where word in (select word from idx) group by word),
weighted as materialized (
  select idx.*, coalesce(idf, 1e-9) as idf, sum(coalesce(idf, 1e-9)) over (partition by template) as total from idx left join idf using (word)),
needed as (select template, least({MIN_VOTES}, count(distinct word)) as needed from idx group by template),
aligned as (
  select id, template, sum(idf) / any_value(total) as coverage
  from w join weighted using (word) join needed using (template)
  group by id, template, spot - place, needed
  having count(distinct word) >= needed and sum(idf) / any_value(total) >= {MIN_COVERAGE}),
found as (
  select id, list_distinct(flatten(list(labels))) as labels, max(least(coverage, 1.0)) as coverage
  from aligned join tpl using (template) join d using (id)
  where len(list_filter(phrases, lambda p: contains(' ' || array_to_string(words, ' ') || ' ', ' ' || p || ' '))) > 0
  group by id),
starts as ({" union all ".join(starts)}),
base as (select id, count(*) as n, min(spot) as low, max(spot) as high, list(distinct label) as labels from starts group by id)
select doc_id, cast(len(words) as bigint) as n_words, coalesce(n, 0) as n_base, low as first_word, high as last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') as base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ','), '') as labels,
       cast(round(coalesce(coverage, 0.0), 6) as double) as score
from d left join base using (id) left join found using (id)
"""


OP8_SQL = license_sql()
