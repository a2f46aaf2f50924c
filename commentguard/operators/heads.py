"""All label heads fitted together, with early stopping on a dev score.

The heads are independent logistic regressions over the same hashed TF-IDF features. Each is driven
by its own L-BFGS descent, but all of them ask for the loss and gradient at their next trial point
in the same pass: one scan of the feature table per step, whatever the number of heads. A task sums
over its rows; sums of tasks meet by blocks of features, in groups of about the square root of the
number of tasks and in the order of the tasks, so reruns agree. What the driver holds is bounded by
parameters: ``2 * MEMORY + 6`` arrays of ``num_features * n_labels`` numbers.

The same pass counts the dev rows' hits and misses at the trial points. The micro F1 of the heads'
accepted points is the dev score; after ``patience`` steps below the best one the descent ends, and
the weights of the best step are kept. Without dev rows it goes on until every head has converged.

Defined cases: null texts are empty; a row without labels is left out, a null label leaves the row out
for that head; a head without a labelled row keeps zero weights; without training rows all do; equal
rows count as often as they stand there; other columns are not read, and ``logits`` and ``predict``
hand them on.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .models import text_features
from .regressions import BLOCK, ONE_LEVEL, cuts, row_scores, sent, summed

THRESHOLD = 0.3
PATIENCE = 5
MEMORY = 6  # pairs of steps and gradient changes a descent keeps


class Descent:
    """L-BFGS with backtracking, one evaluation at a time: evaluate at ``trial``, then call ``told``."""

    def __init__(self, size: int, tol: float):
        self.tol, self.x, self.trial = tol, np.zeros(size), np.zeros(size)
        self.loss, self.grad, self.done = math.inf, np.zeros(size), False
        self.step, self.slope, self.way = 1.0, 0.0, np.zeros(size)
        self.past: list[tuple[np.ndarray, np.ndarray, float]] = []

    def told(self, loss: float, grad: np.ndarray) -> bool:
        """Take in loss and gradient at the trial point; True if it becomes the current point."""
        if self.done:
            return False
        if math.isfinite(self.loss) and not loss <= self.loss + 1e-4 * self.step * self.slope:
            self.step /= 2
            self.done = self.step < 1e-12
            self.trial = self.x + self.step * self.way
            return False
        moved, change = self.trial - self.x, grad - self.grad
        gain = self.loss - loss
        bend = float(moved @ change)
        if math.isfinite(self.loss) and bend > 1e-12 * float(change @ change):
            self.past = [*self.past, (moved, change, bend)][-MEMORY:]
        self.x, self.loss, self.grad = self.trial, loss, grad
        self.done = float(np.abs(grad).max(initial=0.0)) <= self.tol or gain <= 1e-14 * abs(loss)
        if not self.done:
            self._turn()
        return True

    def _turn(self) -> None:
        way, shares = -self.grad, []
        for moved, change, bend in reversed(self.past):
            shares.append(float(moved @ way) / bend)
            way = way - shares[-1] * change
        if self.past:
            _, change, bend = self.past[-1]
            way = way * (bend / float(change @ change))
        for (moved, change, bend), share in zip(self.past, reversed(shares)):
            way = way + (share - float(change @ way) / bend) * moved
        self.step = 1.0 if self.past else 1.0 / max(float(np.sqrt(self.grad @ self.grad)), 1e-12)
        self.way, self.slope = way, float(self.grad @ way)
        self.trial = self.x + self.step * way


def _pass(shared, n_labels: int, n_features: int, threshold: float):
    """Sums of a task: blocks of the gradient, and under block -1 loss, rows, gradient of the bias, hits, false hits, misses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        grad, sums = np.zeros((n_labels, n_features)), np.zeros((6, n_labels))
        for batch in batches:
            lengths = batch.column("indices").value_lengths().to_numpy()
            off = np.append(0, np.cumsum(lengths))
            indices, values = batch.column("indices").flatten().to_numpy(), batch.column("values").flatten().to_numpy()
            bits = batch.column("bits").flatten().to_numpy(zero_copy_only=False).reshape(-1, n_labels).T
            dev = batch.column("dev").to_numpy(zero_copy_only=False)
            for lo, hi in cuts(lengths):
                i, v = indices[off[lo]:off[hi]].astype(np.intp), values[off[lo]:off[hi]]
                z = row_scores(i, v, lengths[lo:hi], weights, bias)
                y, known, held = bits[:, lo:hi] == 1, bits[:, lo:hi] >= 0, dev[lo:hi]
                p = 0.5 * (1 + np.tanh(z / 2))
                learn, said = known & ~held, p >= threshold
                wrong = np.where(learn, p - y, 0.0)
                sums += [(np.logaddexp(0, np.where(y, -z, z)) * learn).sum(1), learn.sum(1), wrong.sum(1),
                         (said & y & held & known).sum(1), (said & ~y & held & known).sum(1), (~said & y & held & known).sum(1)]
                if learn.any():
                    for k in range(n_labels):
                        grad[k] += np.bincount(i, v * np.repeat(wrong[k], lengths[lo:hi]), n_features)
        yield from sent(grad, sums, BLOCK)

    return run


def _evaluate(rows: DataFrame, n_tasks: int, weights: np.ndarray, bias: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """One pass: (gradient sums, the six rows of sums) at the given weights."""
    n_labels, n_features = weights.shape
    shared = rows.sparkSession.sparkContext.broadcast((weights, bias))
    grad, sums = summed(rows, _pass(shared, n_labels, n_features, threshold), n_tasks, n_labels, n_features, 6, BLOCK, ONE_LEVEL)
    shared.unpersist()
    return grad, sums


def micro_f1(hits: np.ndarray, extra: np.ndarray, missed: np.ndarray) -> float:
    total = 2 * hits.sum() + extra.sum() + missed.sum()
    return float(2 * hits.sum() / total) if total else 0.0


@dataclass
class LabelHeads:
    """Fitted heads: ``weights`` (heads x features), ``bias``; ``steps`` holds mean loss and dev score after each pass."""

    features: PipelineModel
    weights: np.ndarray
    bias: np.ndarray
    threshold: float = THRESHOLD
    steps: list[dict] = field(default_factory=list)

    def logits(self, df: DataFrame, text_col: str = "text", out_col: str = "typ") -> DataFrame:
        """df with an array of the heads' logits."""
        shared = df.sparkSession.sparkContext.broadcast((self.weights, self.bias))

        @F.arrow_udf("array<double>")
        def score(indices: pa.Array, values: pa.Array) -> pa.Array:
            weights, bias = shared.value
            lengths = indices.value_lengths().to_numpy()
            off = np.append(0, np.cumsum(lengths))
            i, v = indices.flatten().to_numpy().astype(np.intp), values.flatten().to_numpy()
            out = np.zeros((len(lengths), len(bias)))
            for lo, hi in cuts(lengths):
                out[lo:hi] = row_scores(i[off[lo]:off[hi]], v[off[lo]:off[hi]], lengths[lo:hi], weights, bias).T
            return pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1) * len(bias), pa.int32()), pa.array(out.ravel()))

        rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
        vector = F.unwrap_udt("features")
        return self.features.transform(rows).select("__row.*", score(vector["indices"], vector["values"]).alias(out_col))

    def predict(self, df: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
        """(id, probs, pred): probability per label, and 1 where it reaches the threshold."""
        rows = self.logits(df.select(id_col, text_col), text_col, "__z")
        probs = F.transform("__z", lambda z: 1 / (1 + F.exp(-z)))
        return rows.select(id_col, probs.alias("probs")) \
            .withColumn("pred", F.transform("probs", lambda p: F.when(p >= self.threshold, 1).otherwise(0)))

    def save(self, spark: SparkSession, path: str) -> None:
        self.features.write().overwrite().save(f"{path}/features")
        rows = [(k, float(b), self.threshold, w.tolist()) for k, (w, b) in enumerate(zip(self.weights, self.bias))]
        spark.createDataFrame(rows, "head int, bias double, threshold double, weights array<double>").write.mode("overwrite").parquet(f"{path}/heads")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LabelHeads:
        rows = spark.read.parquet(f"{path}/heads").orderBy("head").collect()  # one row per head
        return cls(PipelineModel.load(f"{path}/features"), np.array([r["weights"] for r in rows]), np.array([r["bias"] for r in rows]),
                   rows[0]["threshold"] if rows else THRESHOLD)


def feature_rows(hashed: Callable[[DataFrame], DataFrame], parts: list[tuple[DataFrame, bool]], n_labels: int, bits_col: str,
                 text_col: str) -> DataFrame:
    """(__tf, bits, dev) of the rows of the parts: a bit is 1, 0 or, if null, -1; bits are null in a row without all labels."""
    out = None
    for df, dev in parts:
        bits = F.transform(bits_col, lambda b: F.when(b.isNull(), -1).when(b.cast("int") == 1, 1).otherwise(0).cast("int"))
        rows = df.select(F.coalesce(F.col(text_col), F.lit("")).alias("__text"), F.when(F.size(bits_col) == n_labels, bits).alias("bits"))
        rows = hashed(rows).select("__tf", "bits", F.lit(dev).alias("dev"))
        out = rows if out is None else out.unionByName(rows)
    return out


def fit_heads(train: DataFrame, n_labels: int, dev: DataFrame | None = None, bits_col: str = "truth", text_col: str = "text",
              reg: float = 1e-3, max_passes: int = 60, patience: int = PATIENCE, threshold: float = THRESHOLD, tol: float = 1e-5,
              num_features: int = 1 << 16) -> LabelHeads:
    """n_labels logistic regressions (mean loss plus reg / 2 times the squared weights, bias free) over ``bits_col``.

    Texts are read and hashed once, and their features written under the checkpoint folder and read once per pass, in as
    many tasks as there are cores, as each hands on an array of all weights. Features are learned from train alone: what
    they weigh is taken into the weights that a pass sends out and into the gradient it gets.
    """
    spark = train.sparkSession
    tokenizer, hashing, idf = text_features("__text", num_features).getStages()

    def hashed(df: DataFrame) -> DataFrame:
        return hashing.transform(tokenizer.transform(df))

    path = scratch_path(spark, f"heads-{uuid.uuid4().hex}")
    written = feature_rows(hashed, [(train, False)] + ([(dev, True)] if dev is not None else []), n_labels, bits_col, text_col)
    written.write.parquet(path)
    stored = spark.read.schema(written.schema).parquet(path)
    learned = stored.where("not dev")
    fitted = idf.fit(hashed(spark.createDataFrame([("",)], "__text string")) if learned.isEmpty() else learned)
    features, weight = PipelineModel([tokenizer, hashing, fitted]), fitted.idf.toArray()
    vector = F.unwrap_udt("__tf")
    rows = stored.where("bits is not null").select(vector["indices"].alias("indices"), vector["values"].alias("values"), "bits", "dev") \
        .coalesce(spark.sparkContext.defaultParallelism)
    n_tasks = rows.rdd.getNumPartitions()
    heads = [Descent(num_features + 1, tol) for _ in range(n_labels)]
    counts = np.zeros((3, n_labels))
    steps: list[dict] = []
    best, waited = (-math.inf, [h.x for h in heads]), 0
    for _ in range(max_passes):
        at = np.array([h.trial for h in heads]).reshape(n_labels, num_features + 1)
        grad, sums = _evaluate(rows, n_tasks, at[:, :-1] * weight, at[:, -1], threshold)
        moved = False
        for k, head in enumerate(heads):
            n = max(sums[1, k], 1.0)
            w = at[k, :-1]
            g = np.append(weight * grad[k] / n + reg * w, sums[2, k] / n)
            if head.told(sums[0, k] / n + reg / 2 * float(w @ w), g):
                counts[:, k], moved = sums[3:, k], True
        score = micro_f1(*counts)
        steps.append({"loss": float(np.mean([h.loss for h in heads])) if heads else 0.0, "dev_f1": score, "moved": moved})
        if dev is not None and moved:
            if score >= best[0]:
                best, waited = (score, [h.x for h in heads]), 0
            else:
                waited += 1
        if all(h.done for h in heads) or (dev is not None and waited >= patience):
            break
    kept = np.array(best[1] if dev is not None else [h.x for h in heads]).reshape(n_labels, num_features + 1)
    return LabelHeads(features, kept[:, :-1].copy(), kept[:, -1].copy(), threshold, steps)
