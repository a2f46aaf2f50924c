"""Regressions of several labels go the way of Spark ML's, but in the same passes and without a copy of the features."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from commentguard.operators import models as ML
from commentguard.operators import regressions as R
from commentguard.session import scratch_path


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(1)
    rows = []
    for k in range(300):
        words = [f"w{i}" for i in np.minimum(rng.zipf(1.4, rng.integers(0, 30)) - 1, 40)]
        truth = [int("w2" in words and rng.random() < .8), int(rng.random() < .2), 1, 0, int(len(words) > 12)]
        rows.append((k, " ".join([*words, "all"]), int("w3" in words) + int("w5" in words) + int(rng.integers(0, 2)), 0, truth))
    return spark.createDataFrame(rows, "id long, text string, y int, none int, truth array<int>").repartition(5).localCheckpoint()


LABELS = [(F.col, "y", "multinomial"), (F.col, "none", "multinomial")] + [(lambda i: F.element_at("truth", i), i + 1, "binomial") for i in range(5)]


@pytest.mark.parametrize("max_iter", [1, 25])
def test_the_way_of_spark_ml(spark, docs, max_iter):
    rows, model = ML.stored_frequencies(docs, ["y", "none", "truth"], num_features=64)
    labels = [(of(x), family) for of, x, family in LABELS]
    idf = model.stages[-1].idf.toArray()
    features = model.stages[-1].transform(rows).cache()
    for (label, family), own in zip(labels, R.fit(rows, labels, idf, max_iter)):
        want = LogisticRegression(featuresCol="features", labelCol="__y", family=family, maxIter=max_iter).fit(features.withColumn("__y", label.cast("double")))
        assert np.allclose(own.weights, want.coefficientMatrix.toArray() * idf, atol=1e-6)
        assert np.allclose(own.bias, want.interceptVector.toArray(), atol=1e-6)
    features.unpersist()


def test_passes_do_not_grow_with_labels(spark, docs, monkeypatch):
    passes = []
    monkeypatch.setattr(R, "summed", lambda *a, run=R.summed: passes.append(spark.sparkContext._jsc.getPersistentRDDs().size()) or run(*a))
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    train, test = docs.where("id % 5 <> 0"), docs.where("id % 5 = 0")
    out = ML.fit_types(train, test, 5, max_iter=4, num_features=64)
    assert len(passes) <= 14 and set(passes) == {held}  # the start, and a step in one pass for most labels
    rows = out.collect()
    assert len(rows) == 60 and all(r["probs"][2:4] == [1.0, 0.0] and r["pred"][2:4] == [1, 0] for r in rows)
    monkeypatch.setattr(R, "HELD_BYTES", 1)  # one label after the other: the same fits
    again = ML.fit_types(train, test, 5, max_iter=4, num_features=64).collect()
    assert sorted((r["id"], [round(p, 9) for p in r["probs"]]) for r in rows) == sorted((r["id"], [round(p, 9) for p in r["probs"]]) for r in again)


def test_levels_and_scorer(spark, docs, monkeypatch):
    held, seen = spark.sparkContext._jsc.getPersistentRDDs().size(), []
    monkeypatch.setattr(R, "summed", lambda *a, run=R.summed: seen.append(spark.sparkContext._jsc.getPersistentRDDs().size()) or run(*a))
    rows, model = ML.stored_features(docs, ["y"], num_features=64)
    want = LogisticRegression(labelCol="y", family="multinomial", maxIter=6).fit(rows.withColumn("y", F.col("y").cast("double")))
    want = {r["id"]: (r["prediction"], r["rawPrediction"].toArray()) for r in want.transform(model.transform(docs.drop("y"))).collect()}
    levels = ML.fit_levels(docs, docs, {"p": "y", "q": "none"}, max_iter=6, num_features=64)
    assert {(r["id"], r["p"], r["q"]) for r in levels.collect()} == {(k, p, 0) for k, (p, _) in want.items()}
    ML.fit_scorer(docs, {"ind": "y"}, "truth", 5, max_iter=6, num_features=64).save(path := scratch_path(spark, "scorer-test"))
    scored = ML.TextScorer.load(spark, path).logits(docs.select("id", "text"))
    assert scored.columns == ["id", "text", "ind", "typ"]
    for r in scored.collect():
        assert np.allclose(r["ind"], want[r["id"]][1], atol=1e-6)
        assert len(r["typ"]) == 5 and r["typ"][2] == np.inf and r["typ"][3] == -np.inf
    assert set(seen) == {held}  # no fit keeps a copy of the features


@pytest.mark.parametrize("label", ["cast(null as int)", "-1", "0.5", "2"])
def test_labels_are_checked(spark, docs, label):
    bad = docs.limit(20).withColumn("truth", F.array(F.col("truth")[0].cast("double"), F.expr(label).cast("double")))
    with pytest.raises(Exception, match="abels MUST|Binomial family"):
        ML.fit_types(bad, bad, 2, max_iter=1, num_features=64)
