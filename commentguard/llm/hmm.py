"""A hidden Markov language model, trained by Baum-Welch over all training texts.

Tokens are words (runs of anything but ASCII white space, A-Z lower-cased) and one end per text.
Counts of all training words are grouped exactly. A word with at least a ``1/HOT`` share of the
training tokens (so at most ``HOT`` words) is a symbol of its own; every other word is emitted as
a symbol for its class (by its last two bytes) and, within it, by its add-one share, so that
seen and unseen rare words have a probability.

Baum-Welch: each round is one pass over the symbol table; tasks return expected counts of
states, transitions and emissions, which are summed by group and turned into the next model
(its size does not grow with the input). For the expected counts texts are cut into runs of
``RUN`` tokens (a run that goes on starts with its own learnt distribution); scoring is exact:
the scaled forward recursion runs over each whole text.

The rare words' counts reach the texts by one exchange: slices of texts send their rare words,
as packed columns, to hash buckets that hold the counts, and get sums per text back. Frequent
words never take part, so buckets stay even.

Defined cases: null and empty texts are their end alone; repeated rows are all counted and score
alike; without training texts all counts are 0 and the model is uniform; an empty table gives an
empty result. A null id is hashed as the empty text.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commentguard.llm.common import SPACED, Words, crc_mod, materialise, read_table, row_slices

HOT = 8192
STATES = 8
ROUNDS = 4
RUN = 256
CLASSES = 64
BUCKET_WORDS = 1_000_000
_PART = 1024  # symbols per row of expected counts


def _classes(w: Words) -> np.ndarray:
    """Class of each word by its last two bytes."""
    last = w.buf[w.end - 1].astype(np.int64)
    before = np.where(w.end - w.start > 1, w.buf[np.maximum(w.end - 2, 0)], 0).astype(np.int64)
    return (last * 131 + before * 7919) % CLASSES


def _count_words(batches):
    for batch in batches:
        hashes, classes, counts = [], [], []
        for part in row_slices(batch, "text"):
            w = Words(part.column("text"), SPACED)
            h, first, n = np.unique(w.hash, return_index=True, return_counts=True)
            hashes.append(h)
            classes.append(_classes(w)[first])
            counts.append(n)
        if not hashes:
            continue
        h, first, inv = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(h.view(np.int64)), pa.array(np.concatenate(classes)[first].astype(np.int32)),
             pa.array(np.bincount(inv, np.concatenate(counts), minlength=len(h)).astype(np.int64))], ["hash", "cls", "n"])


class Vocabulary:
    """What the tasks need of the counts: frequent words, class totals, overall numbers."""

    def __init__(self, hot: np.ndarray, hot_n: np.ndarray, class_total: np.ndarray, class_n: np.ndarray, ends: int, tokens: int, distinct: int):
        self.hot, self.hot_n, self.class_total, self.class_n = hot, hot_n, class_total, class_n
        self.ends, self.tokens, self.distinct = ends, tokens, distinct

    @property
    def symbols(self) -> int:
        return len(self.hot) + CLASSES + 1  # frequent words, classes, end

    def shares(self) -> np.ndarray:
        n = np.concatenate([self.hot_n, self.class_n, [self.ends]]).astype(float) + 0.5
        return n / n.sum()

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Number of the frequent word, or -1."""
        if not len(self.hot) or not len(h):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.hot, h), len(self.hot) - 1)
        return np.where(self.hot[at] == h, at, -1)


def count_vocabulary(train: DataFrame) -> tuple[DataFrame, Vocabulary]:
    """From rows with text: the table of counts (hash, cls, n) and the vocabulary."""
    counts = materialise(train.where("text is not null").select("text").mapInArrow(_count_words, "hash bigint, cls int, n bigint")
                         .groupBy("hash", "cls").agg(F.sum("n").alias("n")), "hmm-counts")
    ends = train.count()
    words, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    tokens = words + ends
    cut = max(1, math.ceil(tokens / HOT))
    hot = counts.where(F.col("n") >= cut).select("hash", "n").toArrow().combine_chunks()
    h, n = hot["hash"].to_numpy().view(np.uint64), hot["n"].to_numpy()
    order = np.argsort(h)
    class_total, class_n = np.ones(CLASSES), np.zeros(CLASSES)
    for r in counts.where(F.col("n") < cut).groupBy("cls").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).collect():
        class_total[r["cls"]] += r["n"] + r["k"]
        class_n[r["cls"]] = r["n"]
    return counts.where(F.col("n") < cut), Vocabulary(h[order], n[order], class_total, class_n, ends, tokens, distinct + (ends > 0))


def _symbolise(shared):
    """Per text its symbols, and what the frequent words and classes add to the scores."""
    def go(batches):
        v = shared.value
        hot_log = np.log10(np.append(v.hot_n, 0) + 1.0)
        class_log = np.log10(v.class_total)
        for batch in batches:
            for part in row_slices(batch, "text"):
                w = Words(part.column("text"), SPACED)
                at, cls, row, docs = v.lookup(w.hash), _classes(w), w.of(), part.num_rows
                rare = at < 0
                sym = np.where(rare, len(v.hot) + cls, at).astype(np.int16)
                blobs = [np.append(sym[a:b], np.int16(v.symbols - 1)).tobytes() for a, b in zip(w.row[:-1], w.row[1:])]
                base = np.bincount(row[~rare], hot_log[at[~rare]], minlength=docs) + math.log10(v.ends + 1)
                less = np.bincount(row[rare], class_log[cls[rare]], minlength=docs).astype(float)
                known = np.bincount(row[~rare], minlength=docs) + (v.ends > 0)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), part.column("k1"), part.column("k2"), pa.array(blobs, pa.binary()),
                     pa.array((w.counts() + 1).astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(base), pa.array(less)],
                    ["doc_id", "held_out", "k1", "k2", "symbols", "n_tokens", "hot_known", "hot_log", "class_log"])
    return go


class Hmm:
    """start and carry (distributions over states at the head of a text and of a run that goes on), move, emit [state, symbol]."""

    def __init__(self, start, carry, move, emit):
        self.start, self.carry, self.move, self.emit = start, carry, move, emit

    @classmethod
    def first(cls, shares: np.ndarray, states: int = STATES, seed: int = 5) -> Hmm:
        rng = np.random.default_rng(seed)
        emit = shares * np.exp(rng.normal(0, 0.7, (states, len(shares))))
        move = np.full((states, states), 0.5 / max(states - 1, 1)) + np.eye(states) * 0.5
        return cls(np.full(states, 1 / states), np.full(states, 1 / states), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))


def _by_length(start: np.ndarray, size: np.ndarray):
    """Sequences from the longest to the shortest, and how many are longer than t for t = 0, 1, ..."""
    order = np.argsort(-size, kind="stable")
    live = len(size) - np.searchsorted(np.sort(size), np.arange(size.max()), "right")
    return order, start[order], live


def log_likelihood(model: Hmm, sym: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """log10 probability of each sequence by the scaled forward recursion."""
    order, at, live = _by_length(start, size)
    emit = np.ascontiguousarray(model.emit.T)
    scale = np.empty(len(sym))
    alpha = None
    for t, n in enumerate(live):
        here = at[:n] + t
        alpha = (np.broadcast_to(model.start, (n, len(model.start))) if alpha is None else alpha[:n] @ model.move) * emit[sym[here]]
        total = alpha.sum(1)
        scale[here] = total
        alpha /= total[:, None]
    out = np.empty(len(size))
    out[order] = np.add.reduceat(np.log10(scale), start)[order]
    return out


def expected_counts(model: Hmm, sym: np.ndarray, start: np.ndarray, size: np.ndarray, head: np.ndarray):
    """Baum-Welch counts of the sequences (head: starts a text): start, carry, move, emit [state, symbol]."""
    order, at, live = _by_length(start, size)
    head, k = head[order], len(model.start)
    move, emit = model.move.astype(np.float32), np.ascontiguousarray(model.emit.T.astype(np.float32))
    first = np.where(head[:, None], model.start, model.carry).astype(np.float32)
    alphas, scales = [], []
    for t, n in enumerate(live):
        e = emit[sym[at[:n] + t]]
        a = (first if t == 0 else alphas[-1][:n] @ move) * e
        s = a.sum(1, keepdims=True)
        alphas.append(a / s)
        scales.append(s)
    moves = np.zeros((k, k))
    gamma = np.empty((len(sym), k), np.float32)
    beta = np.ones((live[-1], k), np.float32)
    gamma[at[:live[-1]] + len(live) - 1] = alphas[-1]
    for t in range(len(live) - 2, -1, -1):
        n, m = live[t], live[t + 1]
        back = emit[sym[at[:m] + t + 1]] * beta / scales[t + 1]
        moves += (alphas[t][:m].T @ back) * move
        beta = np.ones((n, k), np.float32)
        beta[:m] = back @ move.T
        gamma[at[:n] + t] = alphas[t] * beta
    begin = gamma[at]
    emits = np.stack([np.bincount(sym, gamma[:, j], minlength=model.emit.shape[1]) for j in range(k)])
    return begin[head].sum(0), begin[~head].sum(0), moves, emits


def _texts(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of packed texts, with starts and sizes."""
    blobs = col.to_pylist()
    size = np.array([len(b) // 2 for b in blobs], np.int64)
    return np.frombuffer(b"".join(blobs), np.int16).astype(np.int64), np.cumsum(size) - size, size


def _train(shared):
    def go(batches):
        model = shared.value
        k, s = model.emit.shape
        total = [np.zeros(k), np.zeros(k), np.zeros((k, k)), np.zeros((k, s))]
        for batch in batches:
            for part in row_slices(batch, "symbols", 1 << 20):
                sym, start, size = _texts(part.column("symbols"))
                runs = -(-size // RUN)
                nth = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
                begin = np.repeat(start, runs) + nth * RUN
                length = np.minimum(RUN, np.repeat(start + size, runs) - begin)
                for x, y in zip(total, expected_counts(model, sym, begin, length, nth == 0)):
                    x += y
        rows = [(-1, np.concatenate([total[0], total[1], total[2].ravel()]))]
        rows += [(p, total[3][:, p * _PART:(p + 1) * _PART].ravel()) for p in range(-(-s // _PART))]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.int32()), pa.array([x.tobytes() for _, x in rows], pa.binary())], ["part", "counts"])
    return go


def _add(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, np.float64) for x in group.column("counts").to_pylist())
    return pa.table({"part": group.column("part").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})


def train(symbols: DataFrame, vocabulary: Vocabulary, states: int = STATES, rounds: int = ROUNDS) -> Hmm:
    """Baum-Welch over rows with packed symbols."""
    sc = symbols.sparkSession.sparkContext
    shares = vocabulary.shares()
    model = Hmm.first(shares, states)
    for _ in range(rounds if vocabulary.tokens else 0):
        shared = sc.broadcast(model)
        sums = symbols.select("symbols").mapInArrow(_train(shared), "part int, counts binary") \
            .groupBy("part").applyInArrow(_add, "part int, counts binary").collect()
        got = {r["part"]: np.frombuffer(bytes(r["counts"]), np.float64) for r in sums}
        shared.unpersist()
        k = states
        emit = np.concatenate([got[p].reshape(k, -1) for p in sorted(got) if p >= 0], 1) + shares  # one token's worth of smoothing
        start, carry, move = got[-1][:k] + 1, got[-1][k:2 * k] + 1, got[-1][2 * k:].reshape(k, k) + 1
        model = Hmm(start / start.sum(), carry / carry.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))
    return model


def _forward(shared):
    def go(batches):
        model = shared.value
        for batch in batches:
            for part in row_slices(batch, "symbols", 1 << 20):
                ll = log_likelihood(model, *_texts(part.column("symbols")))
                yield pa.RecordBatch.from_arrays([part.column(c) for c in part.schema.names if c != "symbols"] + [pa.array(ll)],
                                                 [c for c in part.schema.names if c != "symbols"] + ["forward"])
    return go


_ASK = "bucket int, kind int, slice bigint, h binary, d binary, n binary"


def _ask(shared, buckets: int):
    """Rare words of each slice, packed by bucket (kind 1), and its texts' keys (kind 2)."""
    def go(batches):
        v, base, nth = shared.value, TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for part in row_slices(batch, "text"):
                w = Words(part.column("text"), SPACED)
                rare = v.lookup(w.hash) < 0
                h, row = w.hash[rare], w.of()[rare]
                b = (h >> np.uint64(40)) % np.uint64(buckets)
                order = np.lexsort((row, h, b))
                h, row, b = h[order], row[order], b[order]
                new = np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1]))[:len(h)]
                first = np.flatnonzero(new)
                n = np.diff(np.append(first, len(h))).astype(np.uint32)
                h, row, b = h[first], row[first].astype(np.uint32), b[first]
                cuts = np.searchsorted(b, np.arange(buckets + 1).astype(np.uint64))
                full = [k for k in range(buckets) if cuts[k + 1] > cuts[k]]
                pack = lambda x: [x[cuts[k]:cuts[k + 1]].tobytes() for k in full]
                keys = np.stack([part.column(c).to_numpy() for c in ("k1", "k2")], 1)
                at = base + nth
                nth += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*full, at % buckets], pa.int32()), pa.array([1] * len(full) + [2], pa.int32()), pa.array([at] * (len(full) + 1), pa.int64()),
                     pa.array([*pack(h), keys.tobytes()], pa.binary()), pa.array([*pack(row), None], pa.binary()), pa.array([*pack(n), None], pa.binary())],
                    ["bucket", "kind", "slice", "h", "d", "n"])
    return go


def _offer(buckets: int):
    """Counts packed by bucket (kind 0)."""
    def go(batches):
        for batch in batches:
            h, n = batch.column("hash").to_numpy().view(np.uint64), batch.column("n").to_numpy()
            b = (h >> np.uint64(40)) % np.uint64(buckets)
            order = np.lexsort((h, b))
            h, n = h[order], n[order]
            cuts = np.searchsorted(b[order], np.arange(buckets + 1).astype(np.uint64))
            full = [k for k in range(buckets) if cuts[k + 1] > cuts[k]]
            none = [None] * len(full)
            yield pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()), pa.array([0] * len(full), pa.int32()), pa.array(none, pa.int64()),
                 pa.array([h[cuts[k]:cuts[k + 1]].tobytes() for k in full], pa.binary()), pa.array(none, pa.binary()),
                 pa.array([n[cuts[k]:cuts[k + 1]].tobytes() for k in full], pa.binary())], ["bucket", "kind", "slice", "h", "d", "n"])
    return go


def _answer(batches):
    """Rows come by bucket, counts first: sums of each slice's texts over the bucket's words (kind 1), keys as they are (kind 2)."""
    bucket, held, table = None, [], None
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if r["bucket"] != bucket:
                bucket, held, table = r["bucket"], [], None
            if r["kind"] == 0:
                held.append((np.frombuffer(r["h"], np.uint64), np.frombuffer(r["n"], np.int64)))
                continue
            if r["kind"] == 2:
                out.append((r["slice"], 2, r["h"], None, None))
                continue
            if table is None:
                words = np.concatenate([x for x, _ in held]) if held else np.zeros(0, np.uint64)
                order = np.argsort(words)
                table = words[order], np.append(np.concatenate([n for _, n in held])[order] if held else [], 0).astype(np.int64)
                held = []
            h, d, n = (np.frombuffer(r[c], t) for c, t in (("h", np.uint64), ("d", np.uint32), ("n", np.uint32)))
            words, counts = table
            at = np.searchsorted(words, h)
            c = np.zeros(len(h), np.int64)
            if len(words):
                spot = np.minimum(at, len(words) - 1)
                c = np.where(words[spot] == h, counts[spot], 0)
            docs, inv = np.unique(d, return_inverse=True)
            out.append((r["slice"], 1, docs.tobytes(), np.bincount(inv, n * np.log10(c + 1.0)).tobytes(),
                        np.bincount(inv, n * (c > 0)).astype(np.uint32).tobytes()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
                                             ["slice", "kind", "d", "logs", "known"])


def _merge(group: pa.Table) -> pa.Table:
    rows = group.to_pylist()
    keys = next(np.frombuffer(r["d"], np.int64) for r in rows if r["kind"] == 2).reshape(-1, 2)
    logs, known = np.zeros(len(keys)), np.zeros(len(keys), np.int64)
    for r in rows:
        if r["kind"] == 1:
            d = np.frombuffer(r["d"], np.uint32)
            logs[d] += np.frombuffer(r["logs"], np.float64)
            known[d] += np.frombuffer(r["known"], np.uint32)
    return pa.table({"k1": keys[:, 0].copy(), "k2": keys[:, 1].copy(), "rare_log": logs, "rare_known": known})


def rare_words(texts: DataFrame, counts: DataFrame, shared, distinct: int) -> DataFrame:
    """(k1, k2, rare_log, rare_known) of every distinct text: sum of log10(count + 1) over its rare words and how many are known."""
    spark = texts.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(distinct / BUCKET_WORDS))
    rows = texts.mapInArrow(_ask(shared, buckets), _ASK).unionByName(counts.select("hash", "n").mapInArrow(_offer(buckets), _ASK))
    answers = rows.repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind") \
        .mapInArrow(_answer, "slice bigint, kind int, d binary, logs binary, known binary")
    each = answers.groupBy("slice").applyInArrow(_merge, "k1 bigint, k2 bigint, rare_log double, rare_known bigint")
    return each.groupBy("k1", "k2").agg(F.max("rare_log").alias("rare_log"), F.max("rare_known").alias("rare_known"))  # copies agree


def score_texts(docs: DataFrame, held_out: F.Column, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, Hmm, Vocabulary]:
    """Scores of all rows (see op7), the model and the vocabulary, learnt from rows that are not held out."""
    value = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out.alias("held_out"), value.alias("text"),
                       F.xxhash64(value).alias("k1"), F.xxhash64(F.lit(2), value).alias("k2"))
    counts, vocabulary = count_vocabulary(rows.where(~F.col("held_out")).select("text"))
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = (f"doc_id {docs.schema[doc_id].dataType.simpleString()}, held_out boolean, k1 bigint, k2 bigint, symbols binary, n_tokens bigint, "
              "hot_known bigint, hot_log double, class_log double")
    symbols = materialise(rows.mapInArrow(_symbolise(shared), schema), "hmm-symbols")
    model = train(symbols.where("not held_out"), vocabulary)
    slim = [c for c in symbols.columns if c != "symbols"]
    ahead = symbols.mapInArrow(_forward(docs.sparkSession.sparkContext.broadcast(model)),
                               ", ".join(f"{c} {symbols.schema[c].dataType.simpleString()}" for c in slim) + ", forward double")
    rare = materialise(rare_words(rows.select("text", "k1", "k2"), counts, shared, vocabulary.distinct), "hmm-rare")
    out = ahead.join(rare, ["k1", "k2"], "left")
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    norm = math.log10(vocabulary.tokens + vocabulary.distinct + 1)
    return out.select("doc_id", "held_out", "n_tokens", (F.col("hot_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
                      F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
                      (F.col("hot_log") + rare_log - F.col("n_tokens") * norm).alias("base_score"),
                      (F.col("forward") + rare_log - F.col("class_log")).alias("score")), model, vocabulary


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: log10 probability of every document."""
    return score_texts(read_table(spark, sf_dir, "documents"), crc_mod("doc_id", 7) == 2)[0]


QUERIES = {"op7_lm_score": (op7_lm_score, None)}
