import zlib

import numpy as np
from pyspark.sql import functions as F

from playstream.llm.quality import STATS, Model, classify, op1_quality_classifier, statistics
from tests.llm.util import EDGE, SF001, docs_of


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in op1_quality_classifier(spark, SF001).collect()}
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for d, r in got.items())
    known = [(got[r.doc_id], r.quality) for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()]
    test = [(r, q) for r, q in known if r.held_out]
    assert sum(r.predicted == q for r, q in test) / len(test) > 0.95
    assert sum(r.predicted for r, q in test if q == 1) / sum(q for _, q in test) > 0.97


def test_density_is_gaussian():
    rng = np.random.default_rng(0)
    d = len(STATS)
    a = rng.normal(size=(d, d))
    cov = a @ a.T + np.eye(d)
    lower = np.linalg.cholesky(cov)
    model = Model(np.array([np.zeros(d), np.ones(d)]), np.array([np.linalg.inv(lower)] * 2), np.array([-np.log(np.diag(lower)).sum()] * 2))
    x = rng.normal(size=(5, d))
    log = lambda v: -0.5 * v @ np.linalg.inv(cov) @ v
    for row, got in zip(x, model.scores(x)):
        assert abs(got - 1 / (1 + np.exp(log(row) - log(row - 1)))) < 1e-9


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, stats string")


def test_edge_rows(spark):
    docs = docs_of(spark, EDGE)
    for rows in ([], [(1, 1, "")], [(1, 0, ""), (2, 1, ""), (2, 1, ""), (4, None, ""), (5, 7, ""), (None, 1, ""), (6, 1, ""), (9, 0, "")]):
        got = classify(docs, labels_of(spark, rows)).collect()
        assert sorted((r.doc_id for r in got), key=str) == sorted((d for d, _ in EDGE), key=str)
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
        twice = [r.score for r in got if r.doc_id == 5]
        assert twice[0] == twice[1]
    assert classify(docs_of(spark, []), labels_of(spark, [])).collect() == []


def test_labels_of_fold_0_are_not_learnt(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    turned = labels.withColumn("quality", F.when(fold, 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r.doc_id: r.score for r in classify(docs, labels).collect()}
    b = {r.doc_id: r.score for r in classify(docs, turned).collect()}
    assert all(abs(a[d] - b[d]) < 1e-9 for d in a)


def test_statistics_are_finite():
    for _, t in EDGE:
        assert np.isfinite(statistics((t or "").encode())).all()
