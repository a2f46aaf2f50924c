"""Spark ML re-aims of the reference's models.

The transformer/GRU models are replaced by Spark ML estimators over shared
text features (RegexTokenizer -> HashingTF -> IDF), fitted once per task.
Training is distributed by Spark ML; nothing is collected to the driver.

Texts are read once: their term frequencies are written under the checkpoint
folder without text and tokens, and every fit reads them there. A fit sums one
array of all coefficients per partition and step, so the stored rows come in as
many partitions as there are cores, whatever their number. The regressions of
several labels take their steps in the same passes (``regressions``); a fit of
Spark ML keeps its own copy of the features while it runs, so with large features
such fits should run one at a time (``at_once``).
"""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scores as S
from ..session import scratch_path
from . import regressions as R

CACHED_BYTES = 1 << 30  # of features that fits running at once may keep in memory


def text_features(text_col: str = "text", num_features: int = 1 << 18) -> Pipeline:
    """Whitespace tokens -> hashed term frequencies -> IDF weights in ``features``."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text_col, outputCol="__tokens", pattern=r"\s+", toLowercase=True),
        HashingTF(inputCol="__tokens", outputCol="__tf", numFeatures=num_features),
        IDF(inputCol="__tf", outputCol="features"),
    ])


def stored_frequencies(train: DataFrame, keep: list[str], text_col: str = "text", num_features: int = 1 << 18) -> tuple[DataFrame, PipelineModel]:
    """(``keep``, __tf) of train, stored without text and tokens, and the fitted text features; train is read once."""
    spark = train.sparkSession
    tokenizer, hashing, idf = text_features(text_col, num_features).getStages()
    path = scratch_path(spark, f"features-{uuid.uuid4().hex}")
    hashing.transform(tokenizer.transform(train)).select(*keep, "__tf").write.parquet(path)
    rows = spark.read.parquet(path).coalesce(spark.sparkContext.defaultParallelism)
    return rows, PipelineModel([tokenizer, hashing, idf.fit(rows)])


def stored_features(train: DataFrame, keep: list[str], text_col: str = "text", num_features: int = 1 << 18) -> tuple[DataFrame, PipelineModel]:
    """(``keep``, features) of train, stored without text and tokens, and the fitted text features; train is read once."""
    rows, model = stored_frequencies(train, keep, text_col, num_features)
    return model.stages[-1].transform(rows).drop("__tf"), model


def featurize(train: DataFrame, test: DataFrame, keep: list[str], text_col: str = "text",
              num_features: int = 1 << 18) -> tuple[DataFrame, DataFrame, PipelineModel]:
    """Stored (``keep``, features) of train, test with features, and the fitted text features."""
    ready, model = stored_features(train, keep, text_col, num_features)
    return ready, model.transform(test), model


def at_once(ready: DataFrame, parallelism: int) -> int:
    """How many fits, each with a copy of ready's features, may run at once: ``parallelism``, or as many as keep to CACHED_BYTES."""
    held = F.coalesce(F.sum(F.size(F.unwrap_udt("features")["indices"]).cast("long") * 12), F.lit(1))  # an int and a double each
    return max(1, min(parallelism, CACHED_BYTES // max(ready.agg(held).first()[0], 1)))


class TextScorer:
    """A fitted model to hand over: text features and named heads, saved, loaded and applied as one.

    ``logits`` adds the columns the cascade reads: one array of class logits per severity head,
    and (if there are label heads ``label0`` ...) one array of label logits.
    """

    def __init__(self, features: PipelineModel, heads: dict[str, R.Regression], text_col: str = "text"):
        self.features, self.heads, self.text_col = features, heads, text_col

    def logits(self, df: DataFrame, labels_col: str = "typ") -> DataFrame:
        out = R.logits(self.features.transform(df), list(self.heads.values()), "__tf", "__z")
        names, bits = [], []
        for name, own in zip(self.heads, R.own_logits(list(self.heads.values()), "__z")):
            if name.startswith("label"):
                bits.append(own[0])
            else:
                names.append(own.alias(name))
        if bits:
            names.append(F.array(*bits).alias(labels_col))
        return out.select(*df.columns, *names)

    def save(self, path: str) -> None:
        """Write everything under path, replacing what was there."""
        self.features.write().overwrite().save(f"{path}/features")
        spark = SparkSession.getActiveSession()
        R.save(spark, f"{path}/heads", self.heads)
        spark.createDataFrame([(self.text_col,)], "text_col string").coalesce(1).write.mode("overwrite").json(f"{path}/order")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TextScorer:
        text_col = spark.read.schema("text_col string").json(f"{path}/order").first()["text_col"]
        return cls(PipelineModel.load(f"{path}/features"), R.load(spark, f"{path}/heads"), text_col)


def fit_scorer(train: DataFrame, levels: dict[str, str], bits_col: str | None = None, n_labels: int = 0, text_col: str = "text",
               max_iter: int = 20, num_features: int = 1 << 16) -> TextScorer:
    """J3 + J4 as a model to keep: ``levels`` maps head name -> label column; n_labels heads over ``bits_col``."""
    rows, features = stored_frequencies(train, [*dict.fromkeys([*levels.values(), *([bits_col] if n_labels else [])])], text_col, num_features)
    jobs = {name: (F.col(label), "multinomial") for name, label in levels.items()}
    jobs |= {f"label{i}": (F.element_at(F.col(bits_col), i + 1), "binomial") for i in range(n_labels)}
    fitted = R.fit(rows, list(jobs.values()), features.stages[-1].idf.toArray(), max_iter)
    return TextScorer(features, dict(zip(jobs, fitted)), text_col)


def fit_levels(train: DataFrame, test: DataFrame, targets: dict[str, str], text_col: str = "text",
               id_col: str = "id", max_iter: int = 50, num_features: int = 1 << 18) -> DataFrame:
    """One multinomial logistic regression per severity head on shared features, all fitted together.

    ``targets`` maps output column -> label column. Returns (id, <output cols>) for ``test``.
    """
    rows, features = stored_frequencies(train, [*dict.fromkeys(targets.values())], text_col, num_features)
    fitted = R.fit(rows, [(F.col(label), "multinomial") for label in targets.values()], features.stages[-1].idf.toArray(), max_iter)
    out = R.logits(features.transform(test), fitted, "__tf", "__z")
    return out.select(id_col, *[S.argmax(own).alias(name) for name, own in zip(targets, R.own_logits(fitted, "__z"))])


def fit_types(train: DataFrame, test: DataFrame, n_labels: int, bits_col: str = "truth", text_col: str = "text",
              id_col: str = "id", threshold: float = 0.3, max_iter: int = 30,
              num_features: int = 1 << 18) -> DataFrame:
    """One binary logistic regression per label, all fitted together over the stored
    term frequencies; returns (id, probs, pred) for ``test``, pred = probs >= threshold. A
    probability is 1 less that of the other class, as in Spark ML."""
    rows, features = stored_frequencies(train, [bits_col], text_col, num_features)
    fitted = R.fit(rows, [(F.element_at(F.col(bits_col), i + 1), "binomial") for i in range(n_labels)], features.stages[-1].idf.toArray(), max_iter)
    out = R.logits(features.transform(test), fitted, "__tf", "__z")
    out = out.select(id_col, F.transform("__z", lambda z: 1 - 1 / (1 + F.exp(z))).alias("probs"))
    return out.withColumn("pred", F.transform("probs", lambda p: F.when(p >= threshold, 1).otherwise(0)))


def fit_head(train: DataFrame, test: DataFrame, emb_col: str = "embedding", label_col: str = "label",
             id_col: str = "id", max_iter: int = 100) -> DataFrame:
    """Classification head over fixed embeddings (array -> ML vector -> multinomial LR)."""
    def vec(df):
        return df.withColumn("features", array_to_vector(F.transform(emb_col, lambda x: x.cast("double"))))
    lr = LogisticRegression(featuresCol="features", labelCol="__y", family="multinomial", maxIter=max_iter)
    tr = vec(train).withColumn("__y", F.col(label_col).cast("double")).cache()
    try:
        model = lr.fit(tr)
    finally:
        tr.unpersist()
    out = model.transform(vec(test))
    return out.select(id_col, F.col(label_col), F.col("prediction").cast("int").alias("predicted"))


def fit_svm(train: DataFrame, test: DataFrame, label_col: str = "toxic", text_col: str = "text",
            id_col: str = "id", max_iter: int = 50) -> DataFrame:
    """TF-IDF + linear SVM baseline."""
    ftrain, ftest, _ = featurize(train, test, [label_col], text_col)
    model = LinearSVC(featuresCol="features", labelCol="__y", maxIter=max_iter) \
        .fit(ftrain.withColumn("__y", F.col(label_col).cast("double")))
    return model.transform(ftest).select(id_col, F.col(label_col), F.col("prediction").cast("int").alias("predicted"))
