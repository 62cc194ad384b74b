import numpy as np
from pyspark.sql import functions as F

from trafficlens.llm import quality

SF = "/root/testdata/sf0.01"


def test_held_out_rows_are_separated(spark):
    out = quality.op1_quality(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = out.join(labels, "doc_id").where("held_out").collect()
    right = np.mean([r["predicted"] == r["quality"] for r in rows])
    assert len(rows) > 50 and right > 0.95
    assert out.where("score < 0 or score > 1 or score is null").count() == 0
    assert out.where((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2) != F.col("held_out")).count() == 0


def test_moments_and_density():
    rng = np.random.default_rng(1)
    p = len(quality.STATISTICS)
    x = [rng.normal(0, 1, (400, p)), rng.normal(1, 2, (300, p))]
    moments = {k: (len(v), v.sum(axis=0), v.T @ v) for k, v in enumerate(x)}
    model = quality.fit_discriminant(moments)
    covariance = [np.linalg.inv(model.inverse[k].T @ model.inverse[k]) for k in (0, 1)]
    point = rng.normal(0, 1, (5, p))
    for row, got in zip(point, model.difference(point)):
        logs = []
        for k in (0, 1):
            d = row - moments[k][1] / moments[k][0]
            logs.append(
                np.log(moments[k][0] / 700) - 0.5 * np.linalg.slogdet(covariance[k])[1] - 0.5 * d @ np.linalg.solve(covariance[k], d)
            )
        assert np.isclose(got, logs[1] - logs[0])


def test_odd_rows_and_missing_labels(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1, "x"), (4, 0, "x"), (5, None, "x"), (None, 1, "x")], "doc_id bigint, quality int, text string")
    rows = quality.classify_quality(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    none = quality.classify_quality(odd_docs, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality.classify_quality(odd_docs.limit(0), labels).count() == 0
    assert quality.keep_accepted(odd_docs, labels).columns == odd_docs.columns


def plain_statistics(text):
    """The 14 statistics, each by its own plain loop."""
    import math

    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * 14
    data = text.encode("utf-8")
    share = lambda part, whole: math.log(part / whole + 0.02)
    mean = sum(len(w) for w in words) / n
    spread = math.sqrt(sum((len(w) - mean) ** 2 for w in words) / n)
    lines = [x for x in text.split("\n") if x.strip()]
    return [
        math.log1p(n),
        math.log1p(mean),
        math.log1p(spread),
        share(sum(w.isupper() for w in words), n),
        share(sum(chr(b) in "#$%&*@^~`<>{}[]\\=+_!" for b in data), len(text)),
        share(data.count(b"|"), len(text)),
        share(sum(48 <= b <= 57 for b in data), len(text)),
        share(sum(len(w) > 1 and not w[-1].isalnum() and not w[-2].isalnum() for w in words), n),
        share(sum(chr(b) in ".,;:?" for b in data), n),
        len(set(words)) / n**0.85,
        share(sum(a == b for a, b in zip(words, words[1:])), n),
        math.log1p(n / max(1, len(lines))),
        len(set(lines)) / max(1, len(lines)),
        share(sum(w.istitle() for w in words), n),
    ]


def test_scored_rows_equal_a_plain_recomputation(spark):
    """Statistics, moments, densities and the logistic of the query, one document after the other."""
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    labels = [(r["doc_id"], r["quality"]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    import zlib

    x = {i: np.array(plain_statistics(t)) for i, t in docs.items()}
    train = [(x[i], q) for i, q in labels if i in x and q in (0, 1) and zlib.crc32(str(i).encode()) % 4 != 2]
    rows = {k: np.array([v for v, q in train if q == k]) for k in (0, 1)}
    p, total = 14, len(train)
    within = {k: np.cov(v.T, bias=True) for k, v in rows.items()}
    pooled = sum(len(rows[k]) * within[k] for k in rows) / total
    models = {}
    for k in rows:
        c = (1 - quality.POOLING) * within[k] + quality.POOLING * pooled
        c = (1 - quality.RIDGE) * c + quality.RIDGE * max(np.trace(c) / p, 1e-6) * np.eye(p)
        models[k] = rows[k].mean(axis=0), np.linalg.inv(c), np.log(len(rows[k]) / total) - 0.5 * np.linalg.slogdet(c)[1]
    differ = lambda v: np.diff([o - 0.5 * (v - m) @ inv @ (v - m) for m, inv, o in (models[0], models[1])])[0]
    z = {i: np.sign(d) * np.log1p(abs(d)) for i, d in ((i, differ(v)) for i, v in x.items())}
    # The logistic by plain Newton steps on the same training rows.
    a = np.array([[np.sign(d) * np.log1p(abs(d)), 1.0] for d in (differ(v) for v, _ in train)])
    y, w = np.array([q for _, q in train], float), np.array([1.0, 0.0])
    for _ in range(50):
        mu = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        w = w - np.linalg.solve(a.T @ (a * (mu * (1 - mu))[:, None]) + 1e-3 * np.eye(2), a.T @ (mu - y) + 1e-3 * w)
    got = {r["doc_id"]: r["score"] for r in quality.op1_quality(spark, sf).collect()}
    want = {i: 1 / (1 + np.exp(-np.clip(w[0] * v + w[1], -30, 30))) for i, v in z.items()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-6 for i in got)


def test_without_a_model_every_row_is_kept(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (4, 1), (5, None), (None, 0)], "doc_id bigint, quality int")
    for known in (labels, labels.limit(0)):
        assert quality.keep_accepted(odd_docs, known).count() == odd_docs.count()
    assert quality.keep_accepted(odd_docs.limit(0), labels).count() == 0
