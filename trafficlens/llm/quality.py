"""Quality classifier: a regularised quadratic discriminant over transformed document statistics.

Each class has a Gaussian with a covariance shrunk towards the pooled one and
towards a multiple of the identity. A score is the difference of the two
log densities, each a Mahalanobis distance by the inverse of a Cholesky factor
that is computed once, mapped to 0..1 by a logistic fitted on the training rows.

The class moments are sums, so they come from one grouped aggregation over all
labelled rows; the driver sees two small matrices. The logistic has two
parameters and is fitted on a bounded sample of CALIBRATION_ROWS labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, row_slices, table, text_or_empty, written

STATISTICS = (
    "log_words",
    "log_word_length",
    "word_length_spread",
    "upper_words",
    "symbols",
    "pipes",
    "digits",
    "marked_words",
    "stops",
    "distinct_words",
    "repeated_next",
    "log_line_words",
    "distinct_lines",
    "capitalised",
)
POOLING = 0.1  # share of the pooled covariance in each class covariance
RIDGE = 0.02  # share of the mean variance on the diagonal
ACCEPT = 0.7
CALIBRATION_ROWS = 20_000
SPREAD = 0.02  # offset of the logarithms of shares

_CLASSES = np.zeros(256, np.int64)
for _c in b"0123456789":
    _CLASSES[_c] = 1
for _c in b"#$%&*@^~`<>{}[]\\=+_!":
    _CLASSES[_c] = 2
for _c in b"|":
    _CLASSES[_c] = 3
for _c in b".,;:?":
    _CLASSES[_c] = 4
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _CLASSES[_c] = 5


def statistics(text: str) -> list[float]:
    """Transformed statistics of one whole text; shares enter by their logarithm, an empty text as zeros."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(_CLASSES[np.frombuffer(text.encode("utf-8"), np.uint8)], minlength=6)
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [line for line in text.split("\n") if line.strip()]
    repeats = sum(map(str.__eq__, words, words[1:]))
    upper = sum(map(str.isupper, words))
    title = sum(map(str.istitle, words))
    marked = sum(1 for w in words if not w[-1].isalnum() and len(w) > 1 and not w[-2].isalnum())
    chars = max(1, len(text))

    def share(part: float, whole: float) -> float:
        return float(np.log(part / whole + SPREAD))

    return [
        float(np.log1p(n)),
        float(np.log1p(lengths.mean())),
        float(np.log1p(lengths.std())),
        share(upper, n),
        share(counts[2], chars),
        share(counts[3], chars),
        share(counts[1], chars),
        share(marked, n),
        share(counts[4], n),
        float(len(set(words)) / n ** 0.85),
        share(repeats, n),
        float(np.log1p(n / max(1, len(lines)))),
        len(set(lines)) / max(1, len(lines)),
        share(title, n),
    ]


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of every whole text; a null text counts as empty."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches):
            rows = [statistics(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "x"]
            )

    slim = docs.select("doc_id", text_or_empty().alias("text"))
    return slim.mapInArrow(measure, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, x array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Centre, inverse Cholesky factor and log density offset of each class, and the logistic."""

    centres: np.ndarray
    inverse: np.ndarray
    offsets: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    fitted: bool = True  # False without training rows of both classes: the scores then tell nothing

    def values(self) -> tuple:
        return self.centres, self.inverse, self.offsets, self.slope, self.shift, self.fitted

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 minus that of class 0."""
        logs = []
        for k in (0, 1):
            z = (x - self.centres[k]) @ self.inverse[k].T
            logs.append(self.offsets[k] - 0.5 * (z * z).sum(axis=1))
        return logs[1] - logs[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * squashed(self.difference(x)) + self.shift, -30, 30)))


def squashed(difference: np.ndarray) -> np.ndarray:
    """Log density differences on a scale that far outliers don't dominate."""
    return np.sign(difference) * np.log1p(np.abs(difference))


def class_moments(labelled: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Rows, sum and sum of products of x by label, over all rows of (label, x): two rows at the driver."""
    p = len(STATISTICS)
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    x = [F.col("x")[i] for i in range(p)]
    sums = [F.sum(x[i]).alias(f"s{i}") for i in range(p)]
    products = [F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i, j in pairs]
    rows = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n"), *sums, *products).collect()
    found = {}
    for row in rows:
        second = np.zeros((p, p))
        for i, j in pairs:
            second[i, j] = second[j, i] = row[f"p{i}_{j}"]
        found[int(row["label"])] = (int(row["n"]), np.array([row[f"s{i}"] for i in range(p)]), second)
    return found


def fit_discriminant(moments: dict[int, tuple[int, np.ndarray, np.ndarray]]) -> Discriminant:
    """Shrunk covariances and their Cholesky factors; a class without rows takes the pooled moments."""
    p = len(STATISTICS)
    total = sum(n for n, _, _ in moments.values())
    if total == 0:
        return Discriminant(np.zeros((2, p)), np.stack([np.eye(p)] * 2), np.zeros(2), fitted=False)
    scatter, own = np.zeros((p, p)), {}
    for label, (n, s, second) in moments.items():
        own[label] = (n, s / n, second - np.outer(s, s) / n)
        scatter += own[label][2]
    pooled = scatter / total
    everything = (total, sum(s for _, s, _ in moments.values()) / total, pooled * total)
    centres, inverse, offsets = np.zeros((2, p)), np.zeros((2, p, p)), np.zeros(2)
    for k in (0, 1):
        n, centre, within = own.get(k, everything)
        covariance = (1 - POOLING) * within / n + POOLING * pooled
        covariance = (1 - RIDGE) * covariance + RIDGE * max(np.trace(covariance) / p, 1e-6) * np.eye(p)
        factor = np.linalg.cholesky(covariance)
        centres[k], inverse[k] = centre, np.linalg.inv(factor)
        offsets[k] = np.log((n if k in own else 1) / total) - np.log(np.diag(factor)).sum()
    return Discriminant(centres, inverse, offsets, fitted=len(own) == 2)


def calibrate(model: Discriminant, x: np.ndarray, label: np.ndarray, steps: int = 50) -> Discriminant:
    """Fit the logistic by damped Newton steps; rows of a single class leave it as it is."""
    if len(set(label.tolist())) < 2:
        return model
    z = np.column_stack([squashed(model.difference(x)), np.ones(len(x))])
    weights = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(z @ weights, -30, 30)))
        gradient = z.T @ (p - label) + 1e-3 * weights
        hessian = (z * (p * (1 - p))[:, None]).T @ z + np.diag([1e-3, 1e-3])
        weights = weights - np.linalg.solve(hessian, gradient)
    return Discriminant(model.centres, model.inverse, model.offsets, float(weights[0]), float(weights[1]), model.fitted)


def train_quality(measured: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2) -> Discriminant:
    """Fit on the labelled rows of (doc_id, x) whose fold is not ``held``.

    ``labels`` needs doc_id and quality; rows without a label of 0 or 1 are left
    out. A document with repeated label rows counts once for each.
    """
    known = labels.select(F.col("doc_id"), F.col("quality").cast("int").alias("label")).where("label in (0, 1)")
    known = known.where(fold(F.col("doc_id"), folds) != held)
    labelled = written(measured.join(known, "doc_id").select("doc_id", "label", "x"), "quality_training")
    model = fit_discriminant(class_moments(labelled))
    sample = labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(CALIBRATION_ROWS).select("label", "x").collect()
    if not sample:
        return model
    return calibrate(model, np.array([r["x"] for r in sample]), np.array([float(r["label"]) for r in sample]))


def keep_accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows scored below ACCEPT; all columns stay, repeated rows are judged alike.

    Without training labels of both classes there is no model, and every row is kept.
    Null and empty texts are scored by their zero statistics; an empty table gives no
    rows. Other columns pass through whatever their names.

    The texts are read once for the statistics of the training rows and once to
    score and filter; they are not shuffled.
    """
    model = train_quality(written(document_statistics(docs), "quality_statistics"), labels)
    if not model.fitted:
        return docs
    values = model.values()
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Discriminant(*values)
        for batch in row_slices(batches):
            x = np.array([statistics(text or "") for text in batch.column(at).to_pylist()])
            yield batch.filter(pa.array(fitted.score(x) >= ACCEPT))

    return docs.mapInArrow(keep, docs.schema)


def score_quality(measured: DataFrame, model: Discriminant) -> DataFrame:
    """(doc_id, score): scores of (doc_id, x) rows."""
    values = model.values()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Discriminant(*values)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fitted.score(x))], ["doc_id", "score"])

    kind = measured.schema["doc_id"].dataType.simpleString()
    return measured.select("doc_id", "x").mapInArrow(score, f"doc_id {kind}, score double")


def classify_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every document's quality.

    ``docs`` needs doc_id and text, ``labels`` doc_id and quality; other columns
    are ignored. Returns doc_id, held_out, score and predicted. Null and empty
    texts have zero statistics and are scored like any other; repeated rows are
    scored separately. Without labels every score is 0.5; an empty table gives no rows.
    """
    measured = written(document_statistics(docs), "quality_statistics")
    model = train_quality(measured, labels)
    return score_quality(measured, model).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )


def held_out() -> Column:
    return F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
