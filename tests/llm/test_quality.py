import numpy as np

from txrisk.llm.common import id_remainder, keep, prepare
from txrisk.llm.quality import (
    STATISTICS, class_moments, document_statistics, fit_discriminant, quality_scores, statistics,
)
from txrisk.llm.queries import op4_quality_classifier


def auc(score, label):
    order = np.argsort(np.argsort(score))
    n1 = label.sum()
    return (order[label == 1].sum() - n1 * (n1 - 1) / 2) / (n1 * (len(label) - n1))


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.01"
    rows = op4_quality_classifier(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    score, label = np.array([r.score for r in held]), np.array([r.quality for r in held])
    assert auc(score, label) > 0.95
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95


def test_moments_are_those_of_all_rows(spark, sf_docs):
    prepare(spark)
    features = document_statistics(sf_docs)
    labelled = features.selectExpr("cast(doc_id % 2 as int) label", "x")
    found = class_moments(labelled, len(STATISTICS))
    rows = labelled.collect()
    for c in (0, 1):
        x = np.array([r.x for r in rows if r.label == c])
        n, s, outer = found[c]
        assert n == len(x)
        assert np.allclose(s, x.sum(axis=0)) and np.allclose(outer, x.T @ x)


def test_scores_are_differences_of_log_densities():
    r = np.random.default_rng(1)
    x = [r.normal(0, 1, (200, 3)), r.normal(1, 2, (100, 3))]
    moments = {c: (len(v), v.sum(axis=0), v.T @ v) for c, v in enumerate(x)}
    model = fit_discriminant(moments, shrinkage=0.0, temperature=1.0)
    point = r.normal(0, 1, (5, 3))
    density = []
    for c, v in enumerate(x):
        cov = np.cov(v.T, bias=True)
        d = point - v.mean(axis=0)
        maha = (d @ np.linalg.inv(cov) * d).sum(axis=1)
        density.append(np.log(len(v) / 300) - 0.5 * np.log(np.linalg.det(cov)) - 0.5 * maha)
    assert np.allclose(model.scores(point), 1 / (1 + np.exp(density[0] - density[1])))


def test_statistics_are_finite():
    for text in ("", " ", "\n\n", "a", "### &&&", "é" * 10, "A" * 100_000):
        assert len(statistics(text)) == len(STATISTICS)
        assert np.isfinite(statistics(text)).all()


def test_odd_documents(spark, odd_docs, no_docs):
    prepare(spark)
    features = keep(document_statistics(odd_docs), "odd")
    rows = id_remainder("doc_id", 5) >= 0
    schema = "doc_id long, quality int, toxic int"
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 0, 0), (6, 0, None), (5, None, 0), (None, 1, 0), (99, 1, 1)], schema)
    scores = quality_scores(features, labels, rows).collect()
    assert len(scores) == odd_docs.count()
    assert all(0 <= r.score <= 1 for r in scores)
    none = spark.createDataFrame([], schema)
    assert {r.score for r in quality_scores(features, none, rows).collect()} == {0.5}
    assert {r.score for r in quality_scores(features, labels.where("quality = 1"), rows).collect()} == {1.0}
    assert quality_scores(document_statistics(no_docs), labels, rows).count() == 0
