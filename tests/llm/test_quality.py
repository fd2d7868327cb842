"""Operator 1: fit on part of the labels, judged on the rest; odd rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from sluice.llm import quality as m

SF = "/root/testdata/sf0.1"


def test_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", m.rating(F.col("quality"), F.col("toxic")).alias("grade"))
    train = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    model = m.fit_quality(docs, train)
    assert model.thresholds[0] < model.thresholds[1]
    got = m.score_quality(docs.join(labels.join(train, "doc_id", "left_anti"), "doc_id"), model).join(labels, "doc_id").groupBy("grade").agg(F.avg(F.col("kept").cast("int")).alias("kept"), F.avg("expected_grade").alias("e")).orderBy("grade").collect()
    kept, expected = [r["kept"] for r in got], [r["e"] for r in got]
    assert kept[0] < 0.15 and kept[1] < 0.25 and kept[2] > 0.97
    assert expected[0] < expected[1] < expected[2]


def test_thresholds_recover_a_known_model():
    rng = np.random.default_rng(0)
    n = 4000
    doc = np.repeat(np.arange(n), 3)
    feature = rng.integers(0, 6, (n, 3)).ravel()
    weights = np.array([-3.0, -1.0, 0.0, 0.5, 1.0, 2.0])
    latent = np.bincount(doc, weights[feature], minlength=n) + rng.logistic(size=n)
    grade = (latent > -2).astype(int) + (latent > 0) + (latent > 2)
    fit = m.OrdinalModel.fit(n, doc, feature, grade, 4, sparsity=0.0, steps=400)
    gaps = fit.weights[1:6] - fit.weights[0]
    assert np.allclose(gaps, weights[1:] - weights[0], atol=0.5) and (np.diff(fit.thresholds) > 1.2).all()
    assert (np.diff(fit.tails(np.linspace(-4, 4, 9)), axis=1) <= 0).all()


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (None, "a b", "y"), (2, "", "z"), (3, "word " * 30000, "w")], "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(1, None), (9, 2), (None, 1)], "doc_id bigint, grade int")
    model = m.fit_quality(docs, labels)
    got = m.score_quality(docs, model).collect()
    assert len(got) == 5 and all(0 <= r["tail_probability"] <= 1 for r in got)
    assert m.keep_good(docs, model, keep_from=0.0).count() == 5 and m.keep_good(docs, model, keep_from=2.0).count() == 0
    assert m.score_quality(docs.limit(0), m.fit_quality(docs.limit(0), labels.limit(0))).count() == 0


def test_scores_against_a_plain_version(spark):
    """Each document by itself, its words in a plain dictionary of weights, the cumulative links by hand."""
    import math

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", m.rating(F.col("quality"), F.col("toxic")).alias("grade"))
    model = m.fit_quality(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in m.score_quality(docs, model).collect():
        _, feature = m.document_features([(texts[r["doc_id"]] or "").encode()])
        score = sum(model.weights[k] for k in set(feature.tolist()))
        chances = [1 / (1 + math.exp(t - score)) for t in model.thresholds]
        assert math.isclose(r["score"], score, rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(r["expected_grade"], sum(chances), rel_tol=1e-9) and math.isclose(r["tail_probability"], chances[-1], rel_tol=1e-9)
        assert r["kept"] == (chances[-1] >= m.KEEP_FROM)
