"""Label heads fitted together: against separate fits, early stopping, hand-over and edge cases."""

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from commentguard.operators import heads as HD
from commentguard.plans import fixtures as FX
from commentguard.session import scratch_path

SF = "/root/testdata/sf0.001"


def labelled(spark):
    """Documents with three labels that depend on their words, and one that no row has."""
    docs = FX.table(spark, SF, "documents").select(F.col("doc_id").alias("id"), "text").where("text is not null")
    has = lambda w: F.lower("text").contains(w).cast("int")
    return docs.withColumn("truth", F.array(has(" the "), has(" der "), (F.length("text") > 800).cast("int"), F.lit(0)))


def test_as_separate_fits(spark):
    rows = labelled(spark)
    model = HD.fit_heads(rows.withColumn("truth", F.slice("truth", 1, 3)), 3, reg=0.05, num_features=256, tol=1e-5, max_passes=200)
    assert len(model.steps) < 200
    ready = model.features.transform(rows.withColumn("__text", F.col("text"))).cache()
    for k in range(3):
        lr = LogisticRegression(featuresCol="features", labelCol="y", regParam=0.05, standardization=False, tol=1e-12, maxIter=1000)
        one = lr.fit(ready.withColumn("y", F.col("truth")[k].cast("double")))
        assert np.abs(one.coefficients.toArray() - model.weights[k]).max() < 1e-3
        assert abs(one.intercept - model.bias[k]) < 1e-3
    losses = [s["loss"] for s in model.steps]
    assert all(b <= a + 1e-12 for a, b in zip(losses, losses[1:]))


def test_many_tasks_agree(spark, monkeypatch):
    """Sums in two levels, and reruns."""
    rows = labelled(spark)
    one = HD.fit_heads(rows, 4, num_features=128, max_passes=8)
    monkeypatch.setattr(HD, "ONE_LEVEL", 1)
    monkeypatch.setattr(HD, "BLOCK", 50)
    many = HD.fit_heads(rows.repartition(7, "id"), 4, num_features=128, max_passes=8)
    again = HD.fit_heads(rows.repartition(7, "id"), 4, num_features=128, max_passes=8)
    assert np.allclose(one.weights, many.weights, atol=1e-6)
    assert np.allclose(many.weights, again.weights, atol=1e-9)


def test_early_stop_keeps_the_best_step(spark):
    rows = labelled(spark)
    flip = F.transform("truth", lambda b: 1 - b)
    model = HD.fit_heads(rows.where("id % 2 = 0"), 4, dev=rows.where("id % 2 = 1").withColumn("truth", flip), reg=1e-4, num_features=256, patience=3)
    scores = [s["dev_f1"] for s in model.steps if s["moved"]]
    assert len(model.steps) < 60 and max(scores) > scores[-1]
    dev = rows.where("id % 2 = 1").withColumn("truth", flip)
    got = {r["id"]: r["pred"] for r in model.predict(dev).collect()}
    want = {r["id"]: r["truth"] for r in dev.select("id", "truth").collect()}
    pairs = [(p, y) for i in want for p, y in zip(got[i], want[i])]
    hit, extra, missed = (sum(1 for x in pairs if x == k) for k in ((1, 1), (1, 0), (0, 1)))
    assert abs(2 * hit / (2 * hit + extra + missed) - max(scores)) < 1e-9


def test_learns_and_hands_over(spark):
    rows = labelled(spark)
    model = HD.fit_heads(rows.where("id % 5 <> 0"), 4, dev=rows.where("id % 5 = 0"), num_features=4096)
    assert max(s["dev_f1"] for s in model.steps) > 0.8
    assert model.bias[3] < -1  # no row has the last label
    path = scratch_path(spark, "heads-test")
    model.save(spark, path)
    again = HD.LabelHeads.load(spark, path)
    test = rows.where("id % 5 = 0")
    assert sorted(map(str, again.predict(test).collect())) == sorted(map(str, model.predict(test).collect()))


def test_texts_are_read_once_and_tasks_bounded(spark, monkeypatch):
    rows, n = labelled(spark), spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        n.add(1)
        return text

    tasks = []
    monkeypatch.setattr(HD, "_evaluate", lambda rows, n_tasks, *more, run=HD._evaluate: tasks.append(n_tasks) or run(rows, n_tasks, *more))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        read = rows.withColumn("text", seen.asNondeterministic()("text"))
        HD.fit_heads(read.repartition(60, "id"), 4, num_features=64, max_passes=2)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert n.value == rows.count()
    assert len(tasks) == 2 and max(tasks) <= spark.sparkContext.defaultParallelism


def test_edges(spark):
    kind = "id long, text string, truth array<int>, features int, bits int, dev int"
    rows = [(1, "good day", [1, 0], 1, 2, 3), (2, None, [0, None], 1, 2, 3), (3, "", [0, 1], 1, 2, 3), (4, "bad day", None, 1, 2, 3),
            (5, "bad " * 200_000, [0, None], 1, 2, 3), (1, "good day", [1, 0], 1, 2, 3), (6, "x", [1], 1, 2, 3), (None, "good", [None, None], 1, 2, 3)]
    docs = spark.createDataFrame(rows, kind)
    model = HD.fit_heads(docs, 2, dev=docs, num_features=64, max_passes=10)
    out = model.logits(docs)
    assert out.columns == [*docs.columns, "typ"] and out.count() == len(rows)
    assert all(np.isfinite(r["typ"]).all() and len(r["typ"]) == 2 for r in out.collect())
    none = HD.fit_heads(docs.limit(0), 2, num_features=64)
    assert not none.weights.any() and not none.bias.any()
    assert model.predict(docs.limit(0)).count() == 0
