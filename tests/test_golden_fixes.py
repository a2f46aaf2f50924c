"""Bad values in scores, probabilities and ids (golden rows)."""

from pyspark.sql import functions as F

from commentguard.functions import scores as S
from commentguard.operators import metrics as ME
from commentguard.operators import monitor as MO
from commentguard.operators import scoring as SC


def test_coerce_level_out_of_range(spark):
    rows = [("3e9",), ("-3e9",), ("NaN",), ("Infinity",), ("-Infinity",), ("2.9",), ("x",), (None,)]
    df = spark.createDataFrame(rows, "v string")
    assert [r[0] for r in df.select(S.coerce_level("v")).collect()] == [3, 0, 0, 3, 0, 2, 0, 0]


def test_samples_average_with_repeated_ids(spark):
    rows = [(1, [1, 0], [1, 1]), (1, [1, 1], [1, 0]), (2, [0, 1], [1, 0])]
    df = spark.createDataFrame(rows, "id long, truth array<int>, pred array<int>")
    got = {r["label"]: r for r in ME.multilabel_report(df, labels=["a", "b"]).collect()}["samples avg"]
    assert abs(got["precision"] - 0.5) < 1e-9 and abs(got["recall"] - 0.5) < 1e-9 and got["support"] == 4


def test_sweep_ignores_missing_probabilities(spark):
    rows = [([1, 0, 0], [0.9, None, float("nan")]), ([1, 0, 0], [0.9, 0.1, float("inf")])]
    df = spark.createDataFrame(rows, "truth array<int>, probs array<double>")
    got = {round(r["threshold"], 2): r["f1_micro"] for r in ME.threshold_sweep(df).collect()}
    assert abs(got[0.5] - 0.8) < 1e-9


def test_type_counts_order(spark):
    df = spark.createDataFrame([(["b", "a"],), (["b", "c"],), (["d", "c"],)], "type_attack array<string>")
    assert [(r[0], r[1]) for r in MO.type_counts(df).collect()] == [("b", 2), ("c", 2), ("a", 1), ("d", 1)]


def test_attach_scores_keeps_last(spark):
    comments = spark.createDataFrame([(1, "z", 1), (1, "a", 2), (9, "n", 3)], "id long, cmt string, at long")
    scores = spark.createDataFrame([(1, 0.5), (2, 0.1)], "id long, s double")
    got = {r["id"]: r["cmt"] for r in SC.attach_scores(comments, scores, order_col="at").collect()}
    assert got == {1: "a", 2: ""}


def test_softmax_wide(spark):
    df = spark.range(500).select(F.transform(F.sequence(F.lit(1), F.lit(48)), lambda x: x.cast("double") / 10).alias("a"))
    assert abs(df.select(F.aggregate(S.softmax("a"), F.lit(0.0), lambda t, x: t + x).alias("s")).agg(F.min("s")).first()[0] - 1) < 1e-9
