"""Best-fit packing: patterns of few lengths, fitted to the length histogram by non-negative least squares.

Documents are tokenised whole (a public tokenizer's file, its path a parameter), closed by an end
token and cut, only where longer than a sequence, into full pieces and one shorter first piece.
How many pieces have which length is all that the plan needs: a histogram of ``capacity`` counts,
however large the corpus.

1. Patterns that fill a sequence are enumerated: pairs and triples of lengths, and repeats of one
   length topped up with one or two more. Where the exact rest has no pieces, the next shorter
   length that has takes its place.
2. Non-negative least squares finds how often each pattern is repeated so that together they
   reproduce the histogram.
3. Repeats are rounded down and taken, patterns with the longest pieces first, while there are pieces left; patterns
   without a piece longer than half a sequence open no more sequences than the number of tokens calls for.
4. Residual pieces are packed best fit, longest first, on counts instead of pieces.

On the test tables that comes to within 0.2 % of the fewest sequences possible. The plan is bounded by ``capacity``
(some thousand lines, whatever the corpus) and goes to the tasks. On Spark, a piece's rank among the
pieces of its length (its rank in the task that cut it plus the pieces of that length in earlier
tasks) picks its slot: sequence and offset. No group of pieces is gathered anywhere, so a length
that a third of all pieces share is no harder than the rest.

A tokenizer file that holds a byte-level BPE whose ids follow its merges (the public one does) is run by the
faster of the two libraries that read such vocabularies; the ids are the same (``tests/llm`` compare them over
every code point's class and on random texts). Any other file is run by the tokenizer library itself.

Defined cases: a null or empty text is one piece with the end token only; repeated rows, and rows
with equal or null ids, are packed one by one; very long texts are cut like any other, in one
task; ties between equal lengths go by task and position; an empty table gives an empty result;
passing columns keep their names, a result replaces a column of its name.
"""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentguard.llm.common import materialise, own_columns, own_fields, own_names, read_table, row_slices, shown
from commentguard.sizing import maybe_broadcast

CAPACITY = 1024
END = 2
TOKENIZER = "byte_bpe_50k.json"
ROUNDS = 600  # of the fit at most
_RANK_BITS = 40


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


#: The splitting rule of byte-level BPE files that name none of their own (fixed value).
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _bytes_of() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from U+0100 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Function of a text to its ids, special tokens in it included, none added."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    plain = not spec.get("normalizer") and model["type"] == "BPE" and not any(
        model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")) \
        and before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex")
    added = spec.get("added_tokens", [])
    plain = plain and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added)
    if plain:
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        plain = all(model["vocab"][x + y] == 256 + k for k, (x, y) in enumerate(pairs))
    if not plain:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
    import tiktoken
    byte, special = _bytes_of(), {t["content"]: t["id"] for t in added}
    ranks = {bytes(byte[c] for c in token): k for token, k in model["vocab"].items() if token not in special}
    bpe = tiktoken.Encoding("own", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: np.array(bpe.encode(text, allowed_special="all"), np.uint32)


def encode(texts: list[str | None], path: str, end: int = END) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of texts, each closed by ``end``, and offsets of the texts into them."""
    run, close = encoder(path), np.array([end], np.uint32)
    parts = [x for t in texts for x in (run(t or ""), close)]
    size = np.array([len(x) for x in parts], np.int64).reshape(-1, 2).sum(1)
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32), np.append(0, np.cumsum(size))


def cut(docs: DataFrame, columns: list[str], text_col: str = "text", path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """One row per piece: the columns, piece, start, length, ids (little-endian unsigned 32-bit), and task and rank.

    ``rank`` counts the pieces of that length that the task cut before. Both hold for this run of the tasks only, so
    the rows must be written before they are used (``place`` does).
    """
    path = path or tokenizer_path()
    own = own_names(columns)
    results = [T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
               T.StructField("ids", T.BinaryType()), T.StructField("task", T.IntegerType()), T.StructField("rank", T.LongType())]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(capacity + 1, np.int64)
        task = TaskContext.get().partitionId()
        for batch in batches:
            for part in row_slices(batch, "pack_text"):
                ids, off = encode(part.column("pack_text").to_pylist(), path, end)
                total = np.diff(off)
                count = -(-total // capacity)
                row = np.repeat(np.arange(len(total)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                head = total - (count - 1) * capacity
                start = np.where(piece > 0, head[row] + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, head[row])
                order = np.argsort(length, kind="stable")
                by = length[order]
                rank = np.empty(len(row), np.int64)
                rank[order] = seen[by] + np.arange(len(by)) - np.searchsorted(by, by)
                seen += np.bincount(length, minlength=capacity + 1)
                at = np.append(0, np.cumsum(length)).astype(np.int32) * 4
                blocks = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(ids))])
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c).take(take) for c in own]
                    + [pa.array(piece, pa.int32()), pa.array(start), pa.array(length), blocks, pa.array(np.full(len(row), task), pa.int32()), pa.array(rank)],
                    [*own, *(f.name for f in results)])

    rows = docs.select(*own_columns(columns), F.col(text_col).alias("pack_text"))
    return rows.mapInArrow(pieces, T.StructType([*own_fields(docs, columns), *results]))


def patterns(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Few-document patterns over the lengths that occur: rows of (a, times, b, c), 0 for none, that fill a sequence or nearly so."""
    have = np.zeros(capacity + 1, np.int64)
    have[lengths] = lengths
    below = np.maximum.accumulate(have)  # the greatest length that occurs, at most this long
    a = np.sort(lengths)
    made = []
    # pairs and triples, a >= b >= c
    x, y = np.meshgrid(a, a, indexing="ij")
    keep = (x >= y) & (x + y <= capacity)
    x, y = x[keep], y[keep]
    z = below[np.minimum(capacity - x - y, y)]
    made.append(np.stack([x, np.ones_like(x), y, z], 1))
    # repeats of one length, topped up with one or two more
    times = [(int(l), k) for l in a for k in range(1, capacity // int(l) + 1)]
    l, k = np.array(times, np.int64).reshape(-1, 2).T
    rest = capacity - l * k
    b = below[rest]
    made.append(np.stack([l, k, b, below[rest - b]], 1))
    out = np.concatenate(made)
    out = out[np.lexsort(out.T)]
    waste = capacity - out[:, 0] * out[:, 1] - out[:, 2] - out[:, 3]
    return np.unique(out[waste < np.maximum(lengths.min(), 1)], axis=0)  # one that another piece fits in is not full


def fit(pats: np.ndarray, histogram: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Repeats (not whole, never negative) of the patterns that reproduce the histogram by weighted least squares.

    A length's error is measured in tokens, relative to how many pieces it has. Each round minimises exactly over
    patterns of steepest gain that share no length, so none of them disturbs another; gains from far along keep most
    patterns at zero.
    """
    length = np.arange(len(histogram))
    weight = length ** 2.0 / (histogram + 1.0)
    weight[0] = 0
    at, times = pats[:, [0, 2, 3]], np.stack([pats[:, 1], (pats[:, 2] > 0) + 0, (pats[:, 3] > 0) + 0], 1).astype(float)
    # a length named twice counts with all its times
    same01, same12, same02 = at[:, 0] == at[:, 1], at[:, 1] == at[:, 2], at[:, 0] == at[:, 2]
    w = weight[at]
    curve = (times ** 2 * w).sum(1) + 2 * (same01 * times[:, 0] * times[:, 1] * w[:, 0] + same12 * times[:, 1] * times[:, 2] * w[:, 1]
                                           + same02 * times[:, 0] * times[:, 2] * w[:, 0])
    x, left = np.zeros(len(pats)), histogram.astype(float)
    rows, unit = at.tolist(), 0.25
    for _ in range(rounds):
        slope = (times * (weight * left)[at]).sum(1)
        step = np.maximum(slope / curve, -x)
        gain = step * (2 * slope - step * curve)
        top = np.argpartition(-gain, min(4 * len(histogram), len(gain) - 1))[:4 * len(histogram)]
        top = top[np.argsort(-gain[top], kind="stable")]
        taken, chosen = {0}, []
        for k in top.tolist():
            a, b, c = rows[k]
            if a in taken or (b and b in taken) or (c and c in taken):
                continue
            taken.update((a, b, c))
            chosen.append(k)
        chosen = np.array(chosen)
        x[chosen] += step[chosen]
        np.add.at(left, at[chosen].ravel(), -(times[chosen] * step[chosen, None]).ravel())
        left[0] = 0
        if np.abs(step[chosen]).max() < unit:
            break
    return x


def best_fit(histogram: np.ndarray, capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Best fit, longest first, on counts: (pattern as length -> times, repeats)."""
    room: dict[int, list[tuple[dict[int, int], int]]] = {}
    for length in range(len(histogram) - 1, 0, -1):
        left = int(histogram[length])
        for space in range(length, capacity + 1):
            if not left:
                break
            groups, keep, each = room.pop(space, []), [], space // length
            for pattern, n in groups:
                if not left:
                    keep.append((pattern, n))
                    continue
                full = min(n, left // each)
                part = left - full * each if full < n else 0
                part = part if part < each else 0
                for times, k in ((each, full), (part, 1)):
                    if times and k:
                        room.setdefault(space - times * length, []).append(({**pattern, length: times}, k))
                        left -= times * k
                        n -= k
                if n:
                    keep.append((pattern, n))
            if keep:
                room.setdefault(space, []).extend(keep)
        if left:
            each = capacity // length
            for times, k in ((each, left // each), (left % each, 1)):
                if times and k:
                    room.setdefault(capacity - times * length, []).append(({length: times}, k))
    return [g for groups in room.values() for g in groups]


def plan(histogram: np.ndarray, capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """(pattern as length -> times, repeats) that use every piece of the histogram (counts by length, index 0 unused) once."""
    left = histogram.astype(np.int64).copy()
    length = np.arange(capacity + 1)
    out = []
    if left[capacity]:
        out.append(({capacity: 1}, int(left[capacity])))
        left[capacity] = 0
    # a piece longer than half a sequence opens one in any case; others may open as many more as all tokens need at least
    spare = max(0, -(-int((left * length).sum()) // capacity) - int(left[capacity // 2 + 1:].sum()))
    lengths = np.flatnonzero(left)
    pats = patterns(lengths, capacity) if len(lengths) else np.zeros((0, 4), np.int64)
    x = fit(pats, left) if len(pats) else np.zeros(0)
    used = np.flatnonzero(x >= 1)
    for k in used[np.lexsort((-x[used], -pats[used, 0]))]:
        p = {}
        a, times, b, c = (int(v) for v in pats[k])
        for l, n in ((a, times), (b, 1), (c, 1)):
            if l:
                p[l] = p.get(l, 0) + n
        opens = 2 * max(p) <= capacity
        repeats = min([int(x[k]), *(int(left[l]) // n for l, n in p.items()), *([spare] if opens else [])])
        if repeats:
            out.append((p, repeats))
            spare -= repeats if opens else 0
            for l, n in p.items():
                left[l] -= n * repeats
    return out + best_fit(left, capacity)


def slots(packed: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """The plan by length: pieces of a length from rank ``base`` on go, ``times`` to a sequence, into sequences from ``first`` on at ``offset``."""
    rows, first, ranks = [], 0, {}
    for pattern, repeats in packed:
        offset = 0
        for length in sorted(pattern, reverse=True):
            times = pattern[length]
            base = ranks.get(length, 0)
            rows.append((length, base, times, first, offset))
            ranks[length] = base + times * repeats
            offset += times * length
        first += repeats
    out = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return {"key": (out[:, 0] << _RANK_BITS) + out[:, 1], "base": out[:, 1], "times": out[:, 2], "first": out[:, 3], "offset": out[:, 4]}


def place(pieces: DataFrame, name: str = "pieces", capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces from ``cut`` (which it writes); task and rank go."""
    spark = pieces.sparkSession
    pieces = materialise(pieces, name, "zstd")
    counts = materialise(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), f"{name}-counts")
    histogram = np.zeros(capacity + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row per length at most
        histogram[r["length"]] = r["n"]
    shared = spark.sparkContext.broadcast(slots(plan(histogram, capacity)))

    @F.pandas_udf("sequence_id long, offset long")
    def slot(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        s = shared.value
        length, rank = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        at = np.searchsorted(s["key"], (length << _RANK_BITS) + rank, "right") - 1
        nth = rank - s["base"][at]
        return pd.DataFrame({"sequence_id": s["first"][at] + nth // s["times"][at], "offset": s["offset"][at] + nth % s["times"][at] * length})

    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(F.col("task").alias("t2"), F.col("length").alias("l2"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    placed = pieces.join(maybe_broadcast(before, bound_by=[counts]), (F.col("task") == F.col("t2")) & (F.col("length") == F.col("l2")))
    placed = placed.withColumn("slot", slot("length", F.col("rank") + F.col("before")))
    keep = [c for c in pieces.columns if c not in ("task", "rank")]
    return placed.select(*keep, F.col("slot.sequence_id").alias("sequence_id"), F.col("slot.offset").alias("offset"))


def pack(docs: DataFrame, columns: list[str], text_col: str = "text", path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """The columns and, per piece, piece, start, length, ids, sequence_id and offset."""
    placed = place(cut(docs, columns, text_col, path, capacity, end), "pack", capacity)
    return shown(placed, columns, ["piece", "start", "length", "ids", "sequence_id", "offset"])


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, lengths): the packed sequences themselves, pieces by offset; at most ``capacity`` tokens each."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "length", "ids"))).alias("parts"))
    ids = F.aggregate("parts", F.lit(b"").cast("binary"), lambda done, p: F.concat(done, p["ids"]))
    return parts.select("sequence_id", ids.alias("ids"), F.transform("parts", lambda p: p["length"]).alias("lengths"))


def op12_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = cut(read_table(spark, sf_dir, "documents"), ["doc_id"]).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return shown(place(pieces, "op12"), ["doc_id"], ["piece", "start", "length", "ids_crc32", "sequence_id", "offset"])


QUERIES = {"op12_pack": (op12_pack, None)}
