"""Evaluation metrics (E7-E14) as aggregations.

Multi-label metrics share one long-form table (id, label, y, p) reduced to
per-label confusion counts with map-side combine; nothing is collected.
Division by zero yields 0 (``zero_division=0``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions import scores as S


def _div(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return _div(2 * tp, 2 * tp + fp + fn)


# ---------------------------------------------------------------- single label
def accuracy(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Accuracy per task; ``pairs`` maps task -> (truth col, prediction col)."""
    aggs = [F.avg((F.col(y) == F.col(p)).cast("double")).alias(t) for t, (y, p) in pairs.items()]
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(t).alias("task"), F.col(t).alias("accuracy")) for t in pairs])).alias("r")).select("r.*")


def class_report(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Per class precision/recall/F1/support + accuracy, macro and weighted averages.

    Classes are the union of true and predicted values. Rows:
    (task, label, precision, recall, f1, support); the summary rows use labels
    'accuracy' (value in f1, as a classification report prints it), 'macro avg',
    'weighted avg'.
    """
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(t).alias("task"), F.col(y).cast("string").alias("y"), F.col(p).cast("string").alias("p"))
        for t, (y, p) in pairs.items()])).alias("r")).select("r.*")
    conf = long.groupBy("task", "y", "p").agg(F.count(F.lit(1)).alias("n"))
    by_true = conf.groupBy("task", F.col("y").alias("label")).agg(
        F.sum("n").alias("support"), F.sum(F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)).alias("tp"))
    by_pred = conf.groupBy("task", F.col("p").alias("label")).agg(F.sum("n").alias("predicted"))
    per = by_true.join(by_pred, ["task", "label"], "full").select(
        "task", "label",
        F.coalesce("support", F.lit(0)).alias("support"),
        F.coalesce("tp", F.lit(0)).alias("tp"),
        F.coalesce("predicted", F.lit(0)).alias("predicted"),
    )
    per = per.select(
        "task", "label",
        _div(F.col("tp"), F.col("predicted")).alias("precision"),
        _div(F.col("tp"), F.col("support")).alias("recall"),
        _div(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"),
        F.col("support").cast("long").alias("support"),
        F.col("tp"),
    )
    tot = per.groupBy("task").agg(
        F.sum("support").alias("n"), F.sum("tp").alias("tp"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        F.sum(F.col("precision") * F.col("support")).alias("wp"),
        F.sum(F.col("recall") * F.col("support")).alias("wr"),
        F.sum(F.col("f1") * F.col("support")).alias("wf"),
    )
    acc = tot.select("task", F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), _div(F.col("tp"), F.col("n")).alias("f1"),
                     F.col("n").alias("support"))
    macro = tot.select("task", F.lit("macro avg").alias("label"), F.col("mp").alias("precision"),
                       F.col("mr").alias("recall"), F.col("mf").alias("f1"), F.col("n").alias("support"))
    weighted = tot.select("task", F.lit("weighted avg").alias("label"), _div(F.col("wp"), F.col("n")).alias("precision"),
                          _div(F.col("wr"), F.col("n")).alias("recall"), _div(F.col("wf"), F.col("n")).alias("f1"),
                          F.col("n").alias("support"))
    return per.drop("tp").unionByName(acc).unionByName(macro).unionByName(weighted)


# ----------------------------------------------------------------- multi label
def label_long(df: DataFrame, truth: str = "truth", pred: str = "pred", id_col: str = "id") -> DataFrame:
    """(id, idx, y, p) from two aligned 0/1 arrays."""
    z = F.posexplode(F.arrays_zip(F.col(truth).alias("y"), F.col(pred).alias("p")))
    return df.select(id_col, z.alias("idx", "z")).select(id_col, "idx", "z.y", "z.p")


def label_confusion(long: DataFrame) -> DataFrame:
    """Per-label tp/fp/fn/tn counts."""
    y, p = F.col("y") == 1, F.col("p") == 1
    return long.groupBy("idx").agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))


def multilabel_metrics(df: DataFrame, truth: str = "truth", pred: str = "pred",
                       n_labels: int = len(V.TYPE_ATTACK_LABELS)) -> DataFrame:
    """Micro F1, macro F1 over all ``n_labels`` labels, Hamming loss = wrong / (N * L)."""
    conf = label_confusion(label_long(df, truth, pred))
    per = conf.select("*", _f1(F.col("tp"), F.col("fp"), F.col("fn")).alias("f1"))
    # every row contributes one of tp/fp/fn/tn per label, so their total is N * L
    tot = per.agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"),
                  F.sum(F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("cells"),
                  F.sum("f1").alias("f1sum"))
    return tot.select(
        _f1(F.col("tp"), F.col("fp"), F.col("fn")).alias("f1_micro"),
        (F.col("f1sum") / n_labels).alias("f1_macro"),
        _div(F.col("fp") + F.col("fn"), F.col("cells")).alias("hamming_loss"),
    )


def multilabel_report(df: DataFrame, truth: str = "truth", pred: str = "pred", id_col: str = "id",
                      labels: list[str] | None = None) -> DataFrame:
    """Per-label precision/recall/F1/support + micro/macro/weighted/samples averages."""
    names = labels or V.TYPE_ATTACK_LABELS
    long = label_long(df, truth, pred, id_col)
    conf = label_confusion(long)
    name_of = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("idx") + 1)
    per = conf.select(
        name_of.alias("label"),
        _div(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _div(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        _f1(F.col("tp"), F.col("fp"), F.col("fn")).alias("f1"),
        (F.col("tp") + F.col("fn")).alias("support"),
        "tp", "fp", "fn",
    )
    tot = per.agg(
        F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"), F.sum("support").alias("s"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        F.sum(F.col("precision") * F.col("support")).alias("wp"),
        F.sum(F.col("recall") * F.col("support")).alias("wr"),
        F.sum(F.col("f1") * F.col("support")).alias("wf"),
    )
    micro = tot.select(F.lit("micro avg").alias("label"), _div(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                       _div(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
                       _f1(F.col("tp"), F.col("fp"), F.col("fn")).alias("f1"), F.col("s").alias("support"))
    macro = tot.select(F.lit("macro avg").alias("label"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                       F.col("mf").alias("f1"), F.col("s").alias("support"))
    weighted = tot.select(F.lit("weighted avg").alias("label"), _div(F.col("wp"), F.col("s")).alias("precision"),
                          _div(F.col("wr"), F.col("s")).alias("recall"), _div(F.col("wf"), F.col("s")).alias("f1"),
                          F.col("s").alias("support"))
    # samples average: per-row precision/recall/F1 inside the row (ids may repeat), then the mean over rows
    def cells(y: int, p: int):
        return F.aggregate(F.zip_with(truth, pred, lambda a, b: F.when((a == y) & (b == p), 1).otherwise(0)), F.lit(0), lambda n, x: n + x)

    per_row = df.where(F.size(truth) > 0).select(cells(1, 1).alias("tp"), cells(0, 1).alias("fp"), cells(1, 0).alias("fn"))
    samples = per_row.agg(
        F.avg(_div(F.col("tp"), F.col("tp") + F.col("fp"))).alias("precision"),
        F.avg(_div(F.col("tp"), F.col("tp") + F.col("fn"))).alias("recall"),
        F.avg(_f1(F.col("tp"), F.col("fp"), F.col("fn"))).alias("f1"),
        F.sum(F.col("tp") + F.col("fn")).alias("support"),  # all positives = the label supports' sum
    ).select(F.lit("samples avg").alias("label"), "precision", "recall", "f1", "support")
    return per.drop("tp", "fp", "fn").unionByName(micro).unionByName(macro).unionByName(weighted).unionByName(samples)


def threshold_sweep(df: DataFrame, truth: str = "truth", probs: str = "probs",
                    lo: int = V.SWEEP_FROM, hi: int = V.SWEEP_TO, good: float = 0.5) -> DataFrame:
    """Micro F1 at thresholds k/100 for k in [lo, hi] with ``p >= k/100``.

    One pass: each (row, label) lands in bucket = largest k with p >= k/100
    (clipped to [lo - 1, hi]); per-bucket counts of y=1 / y=0 are turned into
    tp/fp at every threshold by a reverse cumulative sum over the
    (hi - lo + 2)-row histogram. Best = highest F1, lowest threshold on ties.
    """
    z = F.explode(F.arrays_zip(F.col(truth).alias("y"), F.col(probs).alias("p")))
    long = df.select(z.alias("z")).select(F.col("z.y").alias("y"), F.col("z.p").cast("double").alias("p"))
    # null and NaN are below every threshold; infinities are clipped
    valid = F.when(F.col("p").isNull() | F.isnan("p"), -1.0).otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(2.0), F.col("p"))))
    long = long.select("y", valid.alias("p"))
    k0 = F.floor(F.col("p") * 100).cast("long")
    k = F.when(F.col("p") < k0 / 100.0, k0 - 1).when(F.col("p") >= (k0 + 1) / 100.0, k0 + 1).otherwise(k0)
    bucket = F.greatest(F.lit(lo - 1), F.least(F.lit(hi), k))
    hist = long.groupBy(bucket.alias("k")).agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") != 1).alias("neg"))
    # the grid plus the below-range bucket: at most (hi - lo + 2) rows, so the
    # windows below run over a bounded table
    grid = df.sparkSession.range(lo - 1, hi + 1).select(F.col("id").alias("k"))
    full = grid.join(hist, "k", "left").na.fill(0, ["pos", "neg"]) \
        .withColumn("P", F.sum("pos").over(Window.partitionBy()))
    rev = Window.orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, 0)
    swept = full.select(
        "k", (F.col("k") / 100.0).alias("threshold"),
        F.sum("pos").over(rev).alias("tp"), F.sum("neg").over(rev).alias("fp"), F.col("P")) \
        .filter(F.col("k") >= lo)
    swept = swept.select("threshold", _f1(F.col("tp"), F.col("fp"), F.col("P") - F.col("tp")).alias("f1_micro"))
    best = Window.orderBy(F.col("f1_micro").desc(), F.col("threshold"))  # <= 45 rows
    return swept.select("threshold", "f1_micro",
                        (F.row_number().over(best) == 1).alias("is_best"),
                        (F.col("f1_micro") > good).alias("above_good"))


def losses(df: DataFrame, heads: dict[str, str], typ: str = "typ", truth: str = "truth") -> DataFrame:
    """Sum over heads of mean cross-entropy, and mean BCE-with-logits over N * L.

    ``heads`` maps logits column -> true class column. Row-weighted means.
    """
    ce = None
    for logits, y in heads.items():
        arr = S.to_double_array(logits)
        lse = S.bind(arr, lambda a: S.bind(F.array_max(a), lambda m: m + F.log(
            F.aggregate(a, F.lit(0.0), lambda acc, x: acc + F.exp(x - m)))))
        term = lse - F.element_at(arr, F.col(y).cast("int") + 1)
        ce = term if ce is None else ce + term
    x = S.to_double_array(typ)
    zipped = F.arrays_zip(x.alias("x"), F.col(truth).alias("y"))
    bce = F.aggregate(zipped, F.lit(0.0), lambda acc, e: acc + F.greatest(e.x, F.lit(0.0)) - e.x * e.y
                      + F.log1p(F.exp(-F.abs(e.x))))
    return df.agg(F.avg(ce).alias("ce_sum"), (F.sum(bce) / F.sum(F.size(truth))).alias("bce"))


def subset_accuracy(df: DataFrame, truth: str = "truth", pred: str = "pred") -> DataFrame:
    """Share of rows whose predicted label set equals the true set."""
    same = F.col(truth) == F.col(pred)
    return df.agg(F.count_if(same).alias("exact"), F.count(F.lit(1)).alias("n"),
                  F.avg(same.cast("double")).alias("subset_accuracy"))


def label_distribution(corpus: DataFrame, columns: list[str]) -> DataFrame:
    """Counts and shares of each value of each label/source column."""
    long = corpus.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in columns])).alias("r")
    ).select("r.*")
    counts = long.groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("n"))
    per_dim = counts.groupBy("dimension").agg(F.sum("n").alias("total"))
    return counts.join(per_dim, "dimension").select("dimension", "value", "n", (F.col("n") / F.col("total")).alias("share"))
