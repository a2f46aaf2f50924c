"""Fits read stored rows without texts, in as many partitions as there are cores, and share out their memory."""

from pyspark.sql import functions as F

from commentguard.operators import models as ML


def test_features_are_stored_once_without_texts(spark):
    cores = spark.sparkContext.defaultParallelism
    train = spark.range(600).select("id", F.concat(F.lit("w"), (F.col("id") % 7).cast("string"), F.lit(" x")).alias("text"),
                                    (F.col("id") % 2).alias("y")).repartition(3 * cores)
    ready, model = ML.stored_features(train, ["y"], num_features=64)
    assert ready.columns == ["y", "features"] and ready.count() == 600
    assert ready.rdd.getNumPartitions() <= cores
    want = ML.text_features(num_features=64).fit(train).transform(train).select("y", "features")
    assert ready.exceptAll(want).isEmpty() and want.exceptAll(ready).isEmpty()
    assert [r["features"] for r in model.transform(train).select("features").head(3)]


def test_large_features_are_fitted_one_at_a_time(spark, monkeypatch):
    train = spark.createDataFrame([("a b", 1.0), ("b c", 0.0)], "text string, y double")
    ready, _ = ML.stored_features(train, ["y"], num_features=64)
    assert ML.at_once(ready, 4) == 4
    monkeypatch.setattr(ML, "CACHED_BYTES", 100)  # two rows of two features: 48 bytes
    assert ML.at_once(ready, 4) == 2
    monkeypatch.setattr(ML, "CACHED_BYTES", 10)
    assert ML.at_once(ready, 4) == 1
    monkeypatch.undo()
    assert ML.at_once(ready.limit(0), 4) == 4
