"""Logistic regressions of several labels over the same features, fitted together.

Each one goes the way that Spark ML's ``LogisticRegression`` goes without penalty: over features of unit
variance and mean 0, from the same start, by L-BFGS with a strong Wolfe line search, to the same end. But
all of them ask for loss and gradient at their next point in the same pass over the stored term
frequencies, which are never copied or cached: a fit takes some 20 to 30 passes, whatever the number of
labels. A task sums over its rows; sums of tasks meet by blocks of features, in groups of about the square
root of the number of tasks and in the order of the tasks, so reruns agree. The driver holds some 24 arrays
of all coefficients; of so many labels that this is over HELD_BYTES, some are fitted after the others.

Defined cases: a label that is null, negative or no whole number is an error; classes are 0 to the greatest
label; of a label with one class the intercept is infinite, as in Spark ML.
"""

from __future__ import annotations

import math
from collections.abc import Generator, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MEMORY = 10  # pairs of steps and gradient changes a descent keeps
TOL = 1e-6
TRIALS = 10  # points that a line search looks at before it has a bracket, and in it
HELD_BYTES = 512 << 20  # of the driver, for the descents that run at once
BLOCK = 1024  # features of a block of sums
SLICE = 1 << 18  # feature values worked on at once
ONE_LEVEL = 64  # tasks whose sums meet at once


def row_scores(indices: np.ndarray, values: np.ndarray, lengths: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Logits (heads x rows) of rows of so many features each, which lie one after the other."""
    out = np.zeros((len(bias), len(lengths)))
    full = np.flatnonzero(lengths)
    starts = (np.cumsum(lengths) - lengths)[full]
    for k in range(len(bias)):
        if len(full):
            out[k, full] = np.add.reduceat(weights[k].take(indices) * values, starts)
        out[k] += bias[k]
    return out


def cuts(lengths: np.ndarray, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most so many feature values, or one row."""
    ends, at, base = np.cumsum(lengths), 0, 0
    while at < len(lengths):
        end = max(at + 1, int(np.searchsorted(ends, base + size, "right")))
        yield at, end
        at, base = end, int(ends[end - 1])


def sent(grad: np.ndarray, sums: np.ndarray, size: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """A task's sums: blocks of the gradient, and the others as block -1."""
    task = TaskContext.get().partitionId()
    blocks, parts = [-1], [sums.tobytes()]
    for k, at in enumerate(range(0, grad.shape[1], size)):
        part = grad[:, at:at + size]
        if part.any():
            blocks.append(k)
            parts.append(part.tobytes())
    for k in range(0, len(blocks), 64):
        yield pa.RecordBatch.from_arrays([pa.array(blocks[k:k + 64], pa.int32()), pa.array([task] * len(blocks[k:k + 64]), pa.int32()),
                                          pa.array(parts[k:k + 64], pa.binary())], ["block", "task", "part"])


def _added(group: pa.Table) -> pa.Table:
    """Parts of a block added up in the order of their tasks."""
    group = group.sort_by("task")
    total = np.zeros(0)
    for part in group.column("part"):
        total = np.frombuffer(part.as_buffer()) + (total if len(total) else 0.0)
    return pa.table({"block": group.column("block")[:1], "task": group.column("task")[:1], "part": pa.array([total.tobytes()], pa.binary())})


def summed(rows: DataFrame, run, n_tasks: int, n_rows: int, n_features: int, n_sums: int,
           size: int = BLOCK, one_level: int = ONE_LEVEL) -> tuple[np.ndarray, np.ndarray]:
    """Over all tasks of ``run``: the gradient (n_rows x n_features) and the other sums (n_sums x n_rows)."""
    kind = "block int, task int, part binary"
    parts = rows.mapInArrow(run, kind)
    if n_tasks > one_level:
        span = math.isqrt(n_tasks) + 1
        parts = parts.groupBy("block", F.floor(F.col("task") / span)).applyInArrow(_added, kind)
    grad, sums = np.zeros((n_rows, n_features)), np.zeros((n_sums, n_rows))
    for r in parts.groupBy("block").applyInArrow(_added, kind).collect():  # one row per block of features
        part = np.frombuffer(r["part"])
        if r["block"] < 0:
            sums = part.reshape(n_sums, n_rows)
        else:
            grad[:, r["block"] * size:(r["block"] + 1) * size] = part.reshape(n_rows, -1)
    return grad, sums


# ------------------------------------------------------------------ one descent
Steps = Generator[np.ndarray, tuple[float, np.ndarray], "np.ndarray | None"]


def _direction(grad: np.ndarray, past: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray | None:
    """Downhill by the pairs of steps and gradient changes, newest first; None if they are no use."""
    way, shares = grad.copy(), []
    with np.errstate(all="ignore"):
        scale = past[0][0] @ past[0][1] / (past[0][1] @ past[0][1]) if past else 1.0
        if past and not past[0][0] @ past[0][1] >= 0:
            return None
        for moved, change in past:
            shares.append((moved @ way) / (moved @ change))
            if math.isnan(shares[-1]):
                return None
            way -= shares[-1] * change
        way *= scale
        for (moved, change), share in zip(reversed(past), reversed(shares)):
            way += (share - (change @ way) / (moved @ change)) * moved
    return -way


def _between(a: tuple, b: tuple) -> float:
    """Where a cubic through two points (place, slope, value) is least, a tenth of the way from either at least."""
    (t, slope, value), (u, slope2, value2) = sorted((a, b), key=lambda x: x[0])
    with np.errstate(all="ignore"):
        d1 = slope + slope2 - 3 * np.float64(value - value2) / (t - u)
        d2 = np.sqrt(d1 * d1 - slope * slope2)
        out = u - (u - t) * (slope2 + d2 - d1) / (slope2 - slope + 2 * d2)
    low, high = t + 0.1 * (u - t), t + 0.9 * (u - t)
    return float(low if out < low else high if out > high else out)


def _search(x: np.ndarray, loss: float, grad: np.ndarray, way: np.ndarray, t: float) -> Generator:
    """A step that meets the strong Wolfe conditions: (length, point, its loss, its gradient), None if none is found."""
    slope = float(grad @ way)
    if not slope <= 0:
        return None

    def at(t: float) -> Generator:
        point = x + t * way
        value, g = yield point
        return (t, float(g @ way), value), (t, point, value, g)

    def short(c: tuple) -> bool:
        return c[2] > loss + 1e-4 * c[0] * slope

    low, bracket = (0.0, slope, loss), None
    for i in range(TRIALS):
        c, found = yield from at(t)
        if not math.isfinite(c[2]):
            t /= 2
            continue
        if short(c) or (c[2] >= low[2] and i > 0):
            bracket = low, c
        elif abs(c[1]) <= 0.9 * abs(slope):
            return found
        elif c[1] >= 0:
            bracket = c, low
        if bracket:
            break
        low, t = c, t * 1.5
    if not bracket:
        return None
    low, high = bracket
    for _ in range(TRIALS):
        t = _between(low, high)
        if math.isnan(t):
            return None
        c, found = yield from at(t)
        if short(c) or c[2] >= low[2]:
            high = c
            continue
        if abs(c[1]) <= 0.9 * abs(slope):
            return found
        if c[1] * (high[0] - low[0]) >= 0:
            high = low
        low = c
    return None


def descent(x: np.ndarray, max_iter: int, tol: float = TOL) -> Steps:
    """L-BFGS, one evaluation at a time: gives points, gets loss and gradient there, returns the last point."""
    loss, grad = yield x
    first, seen, past, failed, k = loss, [math.inf], [], False, 0
    while not (k >= max_iter or (len(seen) > 1 and abs(loss - max(seen)) <= tol * first)
               or math.sqrt(grad @ grad) <= max(tol * abs(loss), 1e-8)):
        way, step = _direction(grad, past), None
        if way is not None:
            step = yield from _search(x, loss, grad, way, 1.0 if k else 1 / math.sqrt(way @ way))
        if step is None or step[0] * math.sqrt(grad @ grad) < 1e-10:
            if failed:
                break
            failed, past = True, []
            continue
        _, point, value, g = step
        past = [(point - x, g - grad), *past][:MEMORY]
        x, loss, grad, failed, k = point, value, g, False, k + 1
        seen = [*seen, loss][-20:]
    return x


# ------------------------------------------------------------------ all of them
@dataclass
class Regression:
    """Coefficients (one row, or one per class) of term frequencies, and intercepts."""

    weights: np.ndarray
    bias: np.ndarray


def label_class(label: Column) -> Column:
    """The class of a label, checked."""
    y = label.cast("double")
    return F.when(y.isNull() | F.isnan(y), F.raise_error(F.lit("Labels MUST NOT be Null or NaN"))) \
        .when((y < 0) | (y != F.floor(y)), F.raise_error(F.concat(F.lit("Labels MUST be classes from 0 on, but got "), y.cast("string")))) \
        .otherwise(y).cast("int")


def _batches(batches: Iterator[pa.RecordBatch], n_labels: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(places, term frequencies, features of each row, classes by row) of slices."""
    for batch in batches:
        lengths = batch.column("indices").value_lengths().to_numpy()
        off = np.append(0, np.cumsum(lengths))
        indices, values = batch.column("indices").flatten().to_numpy(), batch.column("values").flatten().to_numpy()
        labels = batch.column("labels").flatten().to_numpy().reshape(-1, n_labels)
        for lo, hi in cuts(lengths):
            yield indices[off[lo]:off[hi]].astype(np.intp), values[off[lo]:off[hi]], lengths[lo:hi], labels[lo:hi]


def _summary(n_labels: int, n_classes: int, n_features: int):
    """Sums and sums of squares of the term frequencies; rows by label and class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, counts = np.zeros((2, n_features)), np.zeros((n_labels, n_classes))
        for i, v, _, labels in _batches(batches, n_labels):
            total += [np.bincount(i, v, n_features), np.bincount(i, v * v, n_features)]
            for k in range(n_labels):
                counts[k] += np.bincount(labels[:, k], minlength=n_classes)
        yield from sent(total, np.append(counts.ravel(), np.zeros(counts.size % 2)))

    return run


def _pass(shared, n_labels: int, spans: list[tuple[int, int, int]]):
    """Losses, sums of the errors and sums of the errors times the term frequencies; spans: (label, its first row, rows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        grad, sums = np.zeros_like(weights), np.zeros((2, len(bias)))
        for i, v, lengths, labels in _batches(batches, n_labels):
            z = row_scores(i, v, lengths, weights, bias)
            for label, at, size in spans:
                y = labels[:, label]
                if size == 1:
                    sums[0, at] += np.logaddexp(0, np.where(y > 0, -z[at], z[at])).sum()
                    z[at] = 0.5 * (1 + np.tanh(z[at] / 2)) - y
                else:
                    own, place = z[at:at + size], (y, np.arange(len(y)))
                    own -= own.max(0)
                    power = np.exp(own)
                    total = power.sum(0)
                    sums[0, at] += (np.log(total) - own[place]).sum()
                    own[:] = power / total
                    own[place] -= 1
            sums[1] += z.sum(1)
            for k in range(len(bias)):
                grad[k] += np.bincount(i, v * np.repeat(z[k], lengths), grad.shape[1])
        yield from sent(grad, sums)

    return run


def _start(counts: np.ndarray, multinomial: bool, n_features: int) -> np.ndarray:
    """Coefficients 0, intercepts by the share of the classes: (rows x features + 1)."""
    if multinomial:
        bias = np.log1p(counts) - np.log1p(counts).mean()
    else:
        bias = np.log(counts[1:] / counts[:1])
    return np.concatenate([np.zeros((len(bias), n_features)), bias[:, None]], 1)


def fit(stored: DataFrame, labels: list[tuple[Column, str]], idf: np.ndarray, max_iter: int, tf_col: str = "__tf") -> list[Regression]:
    """A regression per label, in their order; a label's family is ``binomial``, ``multinomial`` or ``auto`` (by its classes)."""
    num_features = len(idf)
    vector = F.unwrap_udt(tf_col)
    rows = stored.select(vector["indices"].alias("indices"), vector["values"].alias("values"),
                         F.array(*[label_class(label) for label, _ in labels]).alias("labels"))
    n_tasks, n_labels = rows.rdd.getNumPartitions(), len(labels)
    top = rows.agg(*[F.max(F.col("labels")[k]) for k in range(n_labels)]).first()
    if top[0] is None:
        raise ValueError("there are no rows to learn from")
    for (_, family), last in zip(labels, top):
        if family == "binomial" and last > 1:
            raise ValueError(f"Binomial family only supports 1 or 2 outcome classes but found {last + 1}")
    n_classes = max(top) + 1
    size = n_labels * n_classes
    total, sums = summed(rows, _summary(n_labels, n_classes, num_features), n_tasks, 2, num_features, (size + size % 2) // 2)
    counts = sums.ravel()[:size].reshape(n_labels, n_classes)
    n = counts[0].sum()
    spread = np.sqrt(np.maximum(total[1] - total[0] * total[0] / n, 0) / (n - 1)) if n > 1 else np.zeros(num_features)
    scale = np.where((spread > 0) & (idf != 0), 1 / np.where(spread > 0, spread, 1), 0.0)  # a term that all rows have says nothing
    return _fitted(rows, n_tasks, [(family == "multinomial" or (family == "auto" and last > 1), counts[k, :last + 1])
                                   for k, ((_, family), last) in enumerate(zip(labels, top))], max_iter, scale, total[0] / n)


def _fitted(rows: DataFrame, n_tasks: int, jobs: list[tuple[bool, np.ndarray]], max_iter: int, scale: np.ndarray, mean: np.ndarray) -> list[Regression]:
    n_features, out, waiting = len(scale), {}, []
    for k, (multinomial, counts) in enumerate(jobs):
        if np.count_nonzero(counts) == 1:
            bias = np.where(counts > 0, math.inf, 0.0) if multinomial else np.array([math.inf if len(counts) == 2 else -math.inf])
            out[k] = Regression(np.zeros((len(bias), n_features)), bias)
        else:
            waiting.append(k)
    while waiting:
        held, group = 0, []
        while waiting and (not group or held < HELD_BYTES):
            group.append(waiting.pop(0))
            held += (2 * MEMORY + 4) * 8 * (n_features + 1) * (len(jobs[group[-1]][1]) if jobs[group[-1]][0] else 1)
        found = _together(rows, n_tasks, len(jobs), {k: _start(jobs[k][1], jobs[k][0], n_features) for k in group}, max_iter, scale, mean,
                          float(jobs[0][1].sum()))
        out |= {k: Regression(x[:, :-1] * scale, x[:, -1] - x[:, :-1] @ (scale * mean)) for k, x in found.items()}
        for k in group:
            if jobs[k][0]:
                out[k].weights -= out[k].weights.mean(0)
                out[k].bias -= out[k].bias.mean()
    return [out[k] for k in range(len(jobs))]


def _together(rows: DataFrame, n_tasks: int, n_labels: int, starts: dict[int, np.ndarray], max_iter: int, scale: np.ndarray,
              mean: np.ndarray, n: float) -> dict[int, np.ndarray]:
    """The descents from the starts, each of them by its label's column among n_labels; all take their steps in the same passes."""
    context, n_features, out = rows.sparkSession.sparkContext, len(scale), {}
    runs = {k: descent(x.ravel(), max_iter) for k, x in starts.items()}
    points = {k: next(run) for k, run in runs.items()}
    while points:
        at = {k: x.reshape(starts[k].shape) for k, x in points.items()}
        first = np.append(0, np.cumsum([len(x) for x in at.values()])).tolist()
        stacked = np.concatenate(list(at.values()))
        weights = stacked[:, :-1] * scale
        shared = context.broadcast((weights, stacked[:, -1] - weights @ mean))
        grad, sums = summed(rows, _pass(shared, n_labels, [(k, a, len(x)) for (k, x), a in zip(at.items(), first)]), n_tasks, len(stacked), n_features, 2)
        shared.destroy()
        grad = (grad - sums[1][:, None] * mean) * scale
        for (k, x), a in zip(at.items(), first):
            own = np.concatenate([grad[a:a + len(x)], sums[1, a:a + len(x), None]], 1).ravel() / n
            try:
                points[k] = runs[k].send((float(sums[0, a]) / n, own))
            except StopIteration as done:
                out[k] = done.value.reshape(x.shape)
                del points[k]
    return out


# ------------------------------------------------------------------ what they say
def logits(df: DataFrame, regressions: list[Regression], tf_col: str, out_col: str) -> DataFrame:
    """df with an array of all regressions' logits, one after the other."""
    shared = df.sparkSession.sparkContext.broadcast((np.concatenate([r.weights for r in regressions]), np.concatenate([r.bias for r in regressions])))

    @F.arrow_udf("array<double>")
    def score(indices: pa.Array, values: pa.Array) -> pa.Array:
        weights, bias = shared.value
        lengths = indices.value_lengths().to_numpy()
        off = np.append(0, np.cumsum(lengths))
        i, v = indices.flatten().to_numpy(), values.flatten().to_numpy()
        out = np.zeros((len(lengths), len(bias)))
        for lo, hi in cuts(lengths):
            out[lo:hi] = row_scores(i[off[lo]:off[hi]].astype(np.intp), v[off[lo]:off[hi]], lengths[lo:hi], weights, bias).T
        return pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1) * len(bias), pa.int32()), pa.array(out.ravel()))

    vector = F.unwrap_udt(tf_col)
    return df.withColumn(out_col, score(vector["indices"], vector["values"]))


def own_logits(regressions: list[Regression], col: str) -> list[Column]:
    """Of ``logits``, the array of each regression."""
    at = np.cumsum([0] + [len(r.bias) for r in regressions]).tolist()
    return [F.slice(col, a + 1, b - a) for a, b in zip(at, at[1:])]


def save(spark: SparkSession, path: str, regressions: dict[str, Regression]) -> None:
    rows = [(k, name, r.bias.tolist(), r.weights.tolist()) for k, (name, r) in enumerate(regressions.items())]
    spark.createDataFrame(rows, "k int, name string, bias array<double>, weights array<array<double>>").write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> dict[str, Regression]:
    rows = spark.read.parquet(path).orderBy("k").collect()  # one row per regression
    return {r["name"]: Regression(np.array(r["weights"]), np.array(r["bias"])) for r in rows}
