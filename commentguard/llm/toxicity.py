"""Toxicity by class-conditional Kneser-Ney language models.

Two interpolated bigram models, one of toxic and one of ordinary labelled texts, share their
backoff: a class's bigrams fall back to the bigrams of both classes together, those to the
class's continuation unigram, and that to the continuation counts of both. So an expression
that is rare in both classes says nothing about either, nor does one that a class only has
because its context never came up in the other. A text's evidence is the
difference of the two log-likelihoods: per word, and of its most toxic expression of
``PASSAGE`` words, so that a few such words in a long text still count. A logistic curve
turns both into a score; it is fitted to all texts of the sample, each fifth measured by a
model that did not see that fifth.

The models are fitted on a bounded sample of labelled texts: about equally many
words of each class, at most ``SAMPLE_WORDS``, whole texts chosen by a hash of the text (never by
id, source or language). Only labels of rows outside the held-out fold are read. The tables sent to
the tasks hold one line per distinct n-gram of the sample, so they are bounded by it.
Scoring is one row-local pass over all texts.

Defined cases: null and empty texts get the curve's value at no evidence, bounded to (0, 1);
documents with several label rows count as toxic if one says so; a null label is no label;
without labelled texts of both classes all scores are the share of toxic labels (0 without
any); repeated rows score alike; an empty table gives an empty result.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentguard.llm.common import ALNUM, Words, crc_mod, materialise, mix64, own_columns, own_fields, own_names, read_table, row_slices, shown

SAMPLE_WORDS = 4_000_000
RARE = 5  # n-grams seen less often in a class leave their whole mass to the backoff
DISCOUNT = 2.0  # of the others
PASSAGE = 1
CUTOFF = 0.3
FOLDS = 5
_START = np.uint64(0x5DEECE66D1CE4E5B)
_COUNTS = [f"{c}{k}" for c in "ot" for k in range(FOLDS)]  # texts by class and fold


def _bigrams(w: Words) -> np.ndarray:
    """Key of each word with the word before it (a start mark at the head of a text)."""
    before = np.empty_like(w.hash)
    if len(w.hash):
        before[1:] = w.hash[:-1]
        heads = w.row[:-1][np.diff(w.row) > 0]
        before[heads] = _START
    with np.errstate(over="ignore"):
        return mix64(before * np.uint64(0x9DDFEA08EB382D69) + w.hash)


def _collect(batches):
    """Per slice: bigrams (context, word) with the number of texts that hold them, by class and fold of the sample."""
    for batch in batches:
        for part in row_slices(batch, "text"):
            w = Words(part.column("text"), ALNUM)
            if not len(w.hash):
                continue
            before = np.empty_like(w.hash)
            before[1:] = w.hash[:-1]
            before[w.row[:-1][np.diff(w.row) > 0]] = _START
            group = part.column("toxic").to_numpy().astype(np.int64) * FOLDS + part.column("fold").to_numpy()
            key, of = _bigrams(w), w.of()
            # a text counts an expression once, however often it repeats it
            order = np.lexsort((key, of))
            order = order[np.append(True, (np.diff(of[order]) != 0) | (key[order][1:] != key[order][:-1]))]
            keys, first, inv = np.unique(key[order], return_index=True, return_inverse=True)
            n = np.bincount(inv * 2 * FOLDS + group[of[order]], minlength=2 * FOLDS * len(keys)).reshape(-1, 2 * FOLDS)
            yield pa.RecordBatch.from_arrays([pa.array(x[order][first].view(np.int64)) for x in (before, w.hash)] + [pa.array(c) for c in n.T],
                                             ["ctx", "word", *_COUNTS])


def _own(n: np.ndarray) -> np.ndarray:
    """Counts that stay with the class: all of a rare one is left to the backoff, else a fixed discount."""
    return np.where(n < RARE, 0.0, n - DISCOUNT)


class Model:
    """Log-ratio tables: ratio of a known bigram, weight of the backoff after a context, ratio of a word."""

    def __init__(self, totals, words, contexts, bigrams):
        """From gram_statistics: type totals per class, columns of words, contexts and bigrams (classes: ordinary, toxic)."""
        word, cont = words["word"], np.stack([words["o"], words["t"]], 1)
        order = np.argsort(word)
        word, cont = word[order], cont[order]
        total = np.maximum(np.asarray(totals[:2], float), 1)
        shared = (cont.sum(1) + 0.5) / (total.sum() + 0.5)
        gamma = 1 - np.asarray(totals[2:], float) / total
        uni = _own(cont) / total + gamma * shared[:, None]
        self.words, self.uni = word, np.log(uni[:, 1] / uni[:, 0])
        self.unseen = float(np.log(gamma[1] / gamma[0]))
        ctx = contexts["ctx"]
        order = np.argsort(ctx)
        ctx = ctx[order]
        seen, held = (np.stack([contexts[f"{c}{kind}"] for c in "ot"], 1)[order] for kind in ("_seen", "_own"))
        left = np.where(seen > 0, 1 - held / np.maximum(seen, 1), 1.0)
        pool, pool_own = seen.sum(1), contexts["pool_own"][order]
        self.contexts, self.left = ctx, np.log(left[:, 1] / left[:, 0])
        # bigrams that keep mass in a class or in both together; their contexts are all among those above
        n = np.stack([bigrams["o"], bigrams["t"]], 1)
        ci = np.searchsorted(ctx, bigrams["ctx"])
        wi = np.minimum(np.searchsorted(word, bigrams["word"]), max(len(word) - 1, 0))
        known = word[wi] == bigrams["word"] if len(word) else np.zeros(len(n), bool)
        back = np.where(known[:, None], uni[wi], gamma * (RARE / total.sum())) if len(word) else np.tile(gamma * RARE / total.sum(), (len(n), 1))
        back = (_own(n.sum(1)) / np.maximum(pool[ci], 1))[:, None] + (1 - pool_own[ci] / np.maximum(pool[ci], 1))[:, None] * back
        p = _own(n) / np.maximum(seen[ci], 1) + left[ci] * back
        with np.errstate(over="ignore"):
            key = mix64(bigrams["ctx"] * np.uint64(0x9DDFEA08EB382D69) + bigrams["word"])
        order = np.argsort(key)
        self.keys, self.ratio = key[order], np.log(p[order, 1] / p[order, 0]).astype(np.float32)

    def evidence(self, w: Words) -> np.ndarray:
        """log P(word | before, toxic) - log P(word | before, ordinary) of every word."""
        if not len(w.hash) or not len(self.keys):
            return np.zeros(len(w.hash))
        key = _bigrams(w)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        out = self.ratio[at].astype(float)
        miss = np.flatnonzero(self.keys[at] != key)
        h = w.hash[miss]
        uni = np.full(len(h), self.unseen)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
            uni = np.where(self.words[at] == h, self.uni[at], self.unseen)
        first = np.zeros(len(w.hash), bool)
        first[w.row[:-1][np.diff(w.row) > 0]] = True
        before = np.where(first[miss], _START, w.hash[np.maximum(miss - 1, 0)])
        at = np.minimum(np.searchsorted(self.contexts, before), len(self.contexts) - 1)
        out[miss] = uni + np.where(self.contexts[at] == before, self.left[at], 0.0)
        return out

    def features(self, w: Words) -> np.ndarray:
        """Per text: one, evidence per word, and the evidence of its most toxic expression."""
        e = self.evidence(w)
        n = w.counts()
        pre = np.append(0, np.cumsum(e))
        mean = (pre[w.row[1:]] - pre[w.row[:-1]]) / np.maximum(n, 1)
        best = np.zeros(len(n))
        full = np.flatnonzero(n)
        if len(full):
            row_end = np.repeat(w.row[1:], n)
            stop = np.minimum(np.arange(len(e)) + PASSAGE, row_end)
            best[full] = np.maximum.reduceat(pre[stop] - pre[:-1], w.row[:-1][full])
        return np.stack([np.ones(len(n)), mean, best], 1)


def gram_statistics(grams: DataFrame, o: F.Column, t: F.Column) -> Model:
    """The model of bigram counts ``o`` (ordinary) and ``t`` (toxic) of the grams table.

    Only what differs between the classes reaches the driver: words, contexts and bigrams that keep
    mass of their own, a small share of the bounded sample.
    """
    own = lambda c: F.when(c < RARE, 0.0).otherwise(c - DISCOUNT)
    n = grams.select("ctx", "word", o.cast("double").alias("o"), t.cast("double").alias("t")).where("o + t > 0")
    cont = n.groupBy("word").agg(F.sum((F.col("o") > 0).cast("double")).alias("o"), F.sum((F.col("t") > 0).cast("double")).alias("t"))
    totals = cont.agg(*[F.coalesce(x, F.lit(0.0)) for x in (F.sum("o"), F.sum("t"), F.sum(own(F.col("o"))), F.sum(own(F.col("t"))))]).first()
    words = cont.where((F.col("o") >= RARE) | (F.col("t") >= RARE))
    contexts = n.groupBy("ctx").agg(F.sum("o").alias("o_seen"), F.sum("t").alias("t_seen"), F.sum(own(F.col("o"))).alias("o_own"),
                                    F.sum(own(F.col("t"))).alias("t_own"), F.sum(own(F.col("o") + F.col("t"))).alias("pool_own")).where("pool_own > 0")
    bigrams = n.where(F.col("o") + F.col("t") >= RARE)

    def columns(df: DataFrame) -> dict[str, np.ndarray]:
        table = df.toArrow().combine_chunks()
        got = {c: table[c].to_numpy() for c in table.column_names}
        return {c: v.view(np.uint64) if c in ("word", "ctx") else v for c, v in got.items()}

    return Model(tuple(totals), columns(words), columns(contexts), columns(bigrams))


def _measure(shared):
    def go(batches):
        model = shared.value
        for batch in batches:
            for part in row_slices(batch, "text"):
                x = model.features(Words(part.column("text"), ALNUM))
                yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(x[:, 1]), pa.array(x[:, 2])], ["toxic", "mean", "best"])
    return go


def _fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a slight ridge."""
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (y - p) - 1e-2 * beta
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1])
        step = np.linalg.solve(hess, grad)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def fit(docs: DataFrame, labels: DataFrame, sample_words: int = SAMPLE_WORDS) -> tuple[Model | None, np.ndarray, float]:
    """Model, curve and share of toxic labels, from the texts of docs that labels (doc_id, toxic) name.

    The sample is chosen on text hashes and lengths alone; then its bounded list of keys is sent to the texts.
    """
    draw = F.xxhash64(F.lit(9), F.coalesce("text", F.lit("")))
    size = F.coalesce(F.length("text"), F.lit(0)) / 6.0 + 1
    slim = materialise(docs.select("doc_id", draw.alias("draw"), size.alias("words")).join(labels, "doc_id"), "tox-labelled")
    totals = {r["toxic"]: r for r in slim.groupBy("toxic").agg(F.count(F.lit(1)).alias("n"), F.sum("words").alias("words")).collect()}
    rows = sum(r["n"] for r in totals.values())
    share = totals[1]["n"] / rows if 1 in totals else 0.0
    if len(totals) < 2:
        return None, np.zeros(3), share
    budget = min(sample_words, totals[0]["words"], totals[1]["words"])  # equal classes give equal backoff weights
    rate = F.when(F.col("toxic") == 1, budget / totals[1]["words"]).otherwise(budget / totals[0]["words"])
    chosen = slim.where(F.pmod("draw", F.lit(1 << 30)) / float(1 << 30) < rate).groupBy("draw", "toxic").agg(F.min("doc_id").alias("doc_id"))
    chosen = F.broadcast(materialise(chosen, "tox-chosen"))  # copies say nothing new; at most one row per text of the sample
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), draw.alias("draw")).join(chosen, ["doc_id", "draw"])
    sample = materialise(texts.select("text", "toxic", F.pmod(F.shiftright("draw", 32), F.lit(FOLDS)).cast("int").alias("fold")), "tox-sample")
    grams = materialise(sample.mapInArrow(_collect, ", ".join(["ctx bigint, word bigint", *[f"{c} bigint" for c in _COUNTS]]))
                        .groupBy("ctx", "word").agg(*[F.sum(c).alias(c) for c in _COUNTS]), "tox-grams")
    counts = lambda c, without=None: functools.reduce(F.Column.__add__, [F.col(f"{c}{k}") for k in range(FOLDS) if k != without])
    measured = []
    for k in range(FOLDS):
        shared = docs.sparkSession.sparkContext.broadcast(gram_statistics(grams, counts("o", k), counts("t", k)))
        measured.append(sample.where(F.col("fold") == k).mapInArrow(_measure(shared), "toxic int, mean double, best double").toArrow())
        shared.unpersist()
    x = pa.concat_tables(measured)
    y = x["toxic"].to_numpy().astype(float)
    beta = _fit_curve(np.stack([np.ones(len(y)), x["mean"].to_numpy(), x["best"].to_numpy()], 1), y)
    # back from the sample's share of toxic texts to that of all labelled ones
    if 0 < y.mean() < 1 and 0 < share < 1:
        beta[0] += np.log(share / (1 - share)) - np.log(y.mean() / (1 - y.mean()))
    return gram_statistics(grams, counts("o"), counts("t")), beta, share


def _score(shared, own: list[str]):
    def go(batches):
        model, beta, share = shared.value
        for batch in batches:
            for part in row_slices(batch, "tox_text"):
                if model is None:
                    score = np.full(part.num_rows, share)
                else:
                    z = model.features(Words(part.column("tox_text"), ALNUM)) @ beta
                    score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                yield pa.RecordBatch.from_arrays([part.column(c) for c in own] + [pa.array(score)], names=own + ["tox_score"])
    return go


def score_texts(rows: DataFrame, keep: list[str], fitted: tuple, text: str = "text") -> DataFrame:
    """The ``keep`` columns of every row with tox_score."""
    shared = rows.sparkSession.sparkContext.broadcast(fitted)
    schema = T.StructType(own_fields(rows, keep) + [T.StructField("tox_score", T.DoubleType())])
    slim = rows.select(*own_columns(keep), F.col(text).alias("tox_text"))
    return shown(slim.mapInArrow(_score(shared, own_names(keep)), schema), keep, ["tox_score"])


def training_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of labels outside the held-out fold."""
    said = labels.where("toxic in (0, 1) and doc_id is not null").where(crc_mod("doc_id", 4) != 2)
    return said.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: toxicity of every document."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    fitted = fit(docs, training_labels(labels))
    out = score_texts(docs.select("doc_id", "text"), ["doc_id"], fitted)
    return out.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), F.col("tox_score").alias("score"),
                      F.when(F.col("tox_score") >= CUTOFF, 1).otherwise(0).cast("int").alias("predicted"))


QUERIES = {"op4_toxicity": (op4_toxicity, None)}
