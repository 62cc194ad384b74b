import os
from collections import Counter

import corpus_pipeline
from trafficlens.llm.decontamination import allowed, best_distance, normal, plain
from trafficlens.llm.neardup import near_duplicates
from trafficlens.llm.quality import classify_quality
from trafficlens.llm.registry import queries
from trafficlens.llm.toxicity import classify_toxicity

SF = "/root/testdata/sf0.01"


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    items = [b" ".join(normal(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    columns, left = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, SF), "test_pipeline")
        assert docs.columns == columns and docs.count() < left, name
        left = docs.count()
    rows = docs.collect()
    kept = [labels[r["doc_id"]] for r in rows if r["doc_id"] in labels]
    assert sum(r["quality"] for r in kept) >= 0.97 * len(kept) and sum(r["toxic"] for r in kept) <= 0.04 * len(kept)
    assert not any(item in b" ".join(normal(r["text"])) for r in rows for item in items)
    assert near_duplicates(docs).where("class_size > 1").count() <= 2
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(out) == left and all(r["round_trip"] for r in out)


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, words string, size int"


def tables(spark, folder, docs, labels=None, benchmark=None):
    """A folder of tables: the given rows, those of SF where none are given."""
    docs.write.parquet(f"{folder}/documents.parquet")
    for name, rows, schema in (("labels", labels, "doc_id bigint, quality int, toxic int"), ("benchmark", benchmark, "item_id bigint, text string")):
        if rows is None:
            os.symlink(f"{SF}/{name}.parquet", f"{folder}/{name}.parquet")
        else:
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_odd_documents(spark, odd_docs, tmp_path):
    """Without labels the classifiers keep all; of equal texts one row stays, and the benchmark's passage goes."""
    more = [(20, "the planted passage of a benchmark stands in this document here", "en", "a", 1, "r", "w", 1)]
    docs = odd_docs.unionByName(spark.createDataFrame(more, DOCS))
    path = tables(spark, tmp_path, docs, [], [(1, "planted passage of a benchmark stands in this"), (2, None), (3, " ")])
    rows = corpus_pipeline.run(spark, path).collect()
    # 2, 3 and 7 have no words and are copies, as are the two equal rows of 5; 20 holds the passage.
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in rows) == [(False, k) for k in (1, 2, 4, 5, 5, 8, 9)] + [(True, None)]
    assert all(r["round_trip"] for r in rows)
    assert {r["doc_id"]: r["n_tokens"] for r in rows}[2] == 0


def test_labels_of_one_class_drop_nothing(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    path = tables(spark, tmp_path, docs, [(r["doc_id"], 1, 0) for r in docs.collect()], [])
    kept = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:2]:
        kept = stage(spark, kept, path)
        assert kept.count() == 60, name


def test_empty_tables(spark, odd_docs, tmp_path):
    path = tables(spark, tmp_path, odd_docs.limit(0))
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, path).count() == 0, name
    assert corpus_pipeline.run(spark, path).count() == 0


def test_stage_results_equal_brute_force(spark):
    """Survivors of each stage on its own input, from scores, all pairs and all passages taken one by one."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    after = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, corpus_pipeline.written(stage(spark, docs, sf), "brute_pipeline")
        after[name] = before, ids(docs)
    before, kept = after["quality classifier"]
    assert kept == {r["doc_id"] for r in classify_quality(before, labels).where("score >= 0.7").collect()}
    before, kept = after["toxicity"]
    assert kept == {r["doc_id"] for r in classify_toxicity(before, labels).where("score < 0.5").collect()}

    before, kept = after["minhash near-dedup"]
    sets = {r["doc_id"]: shingled(r["text"]) for r in before.collect()}
    group = {i: i for i in sets}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and alike(sets[a], sets[b]):
                group[max(root(a), root(b))] = min(root(a), root(b))
    assert kept == {root(i) for i in sets}

    before, kept = after["benchmark decontamination"]
    items = [plain(r["text"] or "") for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    texts = {r["doc_id"]: plain(r["text"] or "") for r in before.collect()}
    assert kept == {i for i, t in texts.items() if not any(best_distance(x, t) <= allowed(len(x)) for x in items if x)}


def shingled(text):
    words = (text or "").lower().split()
    return Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else Counter()


def alike(a, b):
    """Jaccard of the sets, or probability Jaccard of the weighted ones, of at least 0.8."""
    if not a or not b:
        return a == b
    if len(a & b) >= 0.8 * len(a | b) - 1e-9:
        return True
    shared = sum(
        1 / sum(max(a[y] / a[x], b[y] / b[x]) for y in a.keys() | b.keys()) for x in a.keys() & b.keys()
    )
    return shared >= 0.8 - 1e-9


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == list(range(1, 14))
