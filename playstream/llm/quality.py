"""Quality classifier: a regularised quadratic discriminant over transformed
document statistics.

Both classes are Gaussians with covariances shrunk towards the pooled
variances.  Class moments are sums that Spark aggregates over all labelled
rows; the driver factors two small matrices once (Cholesky), and tasks score
by the difference of the Mahalanobis log densities with the cached factors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playstream.llm.common import as_bytes, row_key, rows_with, save, slices, table

FOLDS = 5            # rows of fold 0 are never learnt from
THRESHOLD = 0.3      # least score that is kept
SHRINK = 0.3         # share of the pooled variances in each class covariance

#: Fixed byte classes of the statistics.
_SYMBOLS, _UPPER, _DIGITS, _MARKS, _STOPS = b"#*$%&|<>", bytes(range(65, 91)), b"0123456789", b"!", b".,;:?"

STATS = ("words", "word_length", "longest_word", "words_per_line", "distinct_words", "adjacent_repeats", "repeated_lines",
         "symbols", "upper", "digits", "marks", "stops")


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of a text: logarithms of sizes, square roots of shares."""
    words = text.split()
    n, chars = max(1, len(words)), max(1, len(text))
    lines = [x for x in text.split(b"\n") if x.strip()]
    share = lambda marks: (len(text) - len(text.translate(None, marks))) / chars
    return [np.log1p(len(words)), np.log1p(len(b"".join(words)) / n), np.log1p(max(map(len, words), default=0)),
            np.log1p(len(words) / max(1, len(lines))), np.log1p(len(set(words))) / np.log1p(n),
            (sum(map(eq, words, words[1:])) / n) ** 0.5, (1 - len(set(lines)) / max(1, len(lines))) ** 0.5,
            *(share(x) ** 0.5 for x in (_SYMBOLS, _UPPER, _DIGITS, _MARKS, _STOPS))]


def measured(docs: DataFrame) -> DataFrame:
    """``(doc_id, h, stats)`` of whole texts; null counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            stats = pa.array([statistics(t) for t in as_bytes(b.column("text"))], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("h"), stats], ["doc_id", "h", "stats"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", row_key()["h"].alias("h"), "text").mapInArrow(run, f"doc_id {kind}, h long, stats array<double>")


def held_out(doc_id: Column) -> Column:
    """Fold 0 of crc32 of the id as text; a null id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


@dataclass
class Model:
    """Means, inverse Cholesky factors and log density constants of classes 0 and 1."""

    mean: np.ndarray
    factor: np.ndarray
    constant: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        log = [c - 0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) for m, f, c in zip(self.mean, self.factor, self.constant)]
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def fit(samples: DataFrame, shrink: float = SHRINK) -> Model | None:
    """Learn from ``samples(stats, quality)``; None unless both classes have rows.

    All rows count; what reaches the driver is one row of sums per class."""
    d = len(STATS)
    x = [F.col("stats")[i] for i in range(d)]
    sums = [F.count("*").alias("n"), *(F.sum(v).alias(f"s{i}") for i, v in enumerate(x)),
            *(F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d))]
    rows = {r["quality"]: r for r in samples.where("quality IN (0, 1)").groupBy("quality").agg(*sums).collect()}
    if len(rows) < 2:
        return None
    n = np.array([rows[k]["n"] for k in (0, 1)], float)
    mean = np.array([[rows[k][f"s{i}"] for i in range(d)] for k in (0, 1)]) / n[:, None]
    cov = np.array([[[rows[k][f"p{min(i, j)}_{max(i, j)}"] for j in range(d)] for i in range(d)] for k in (0, 1)]) / n[:, None, None]
    cov -= mean[:, :, None] * mean[:, None, :]
    pooled = np.diag((n[:, None, None] * cov).sum(axis=0) / n.sum())
    target = np.diag(np.maximum(pooled, 1e-6))
    lower = [np.linalg.cholesky((1 - shrink) * c + shrink * target) for c in cov]
    return Model(mean, np.array([np.linalg.inv(f) for f in lower]),
                 np.array([np.log(n[k] / n.sum()) - np.log(np.diag(f)).sum() for k, f in enumerate(lower)]))


def _scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, h, score)`` per row, by the model learnt from these rows and labels."""
    stats = save(measured(docs))
    known = labels.select(F.col("doc_id").alias("id"), "quality").where(~held_out(F.col("id")))
    model = fit(stats.join(known, F.col("doc_id") == F.col("id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array(b.column("stats").values).reshape(b.num_rows, -1) if b.num_rows else np.zeros((0, len(STATS)))
            score = model.scores(x) if model else np.full(b.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("h"), pa.array(score)], ["doc_id", "h", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return stats.mapInArrow(run, f"doc_id {kind}, h long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs(doc_id, text)``.

    * learns from ``labels(doc_id, quality)`` of rows outside fold 0; other
      labels than 0 and 1 are ignored, a repeated label counts each time;
    * without rows of both labels every score is 0.5;
    * null and empty texts are scored as texts of no words; a null id is
      scored but never learnt from; repeated rows get equal scores; other
      columns are ignored; an empty table gives an empty table."""
    return _scored(docs, labels).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns kept."""
    return rows_with(docs, _scored(docs, labels).where(F.col("score") < threshold), "left_anti")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
