"""Shared pieces of the training-data operators: tables, scratch tables, bounded
broadcasts and vectorised tokenising of Arrow text columns.

Texts are cut into words on their UTF-8 bytes. Every pattern used here only names
ASCII characters, so a byte test is exact: all bytes of a non-ASCII character are
0x80 or above and fall in the same class.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentguard.session import scratch_path

# Bytes of text that a task works on at once (a single longer text is worked on alone).
SLICE_BYTES = 4 << 20
# The same where the arrays of a slice take many times its bytes and longer ones save no time.
PART_BYTES = 256 << 10
_HASH_BASE = np.uint64(0x9E3779B97F4A7C15)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write df to the shared scratch folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast if df, a written table of narrow rows, has at most max_rows; else leave the join to AQE."""
    return F.broadcast(df) if df.count() <= max_rows else df


def own_names(columns: list[str]) -> list[str]:
    """Inner names for columns that pass through, so that they can't clash with an operator's own."""
    return [f"own{k}_" for k in range(len(columns))]


def own_columns(columns: list[str]) -> list[F.Column]:
    return [F.col(f"`{c}`").alias(x) for c, x in zip(columns, own_names(columns))]


def carried(columns: list[str], text: str, name: str) -> tuple[list[F.Column], str]:
    """Passing columns and the text, which goes along once only, and the text's inner name."""
    if text in columns:
        return own_columns(columns), own_names(columns)[columns.index(text)]
    return [*own_columns(columns), F.col(text).alias(name)], name


def own_fields(df: DataFrame, columns: list[str]) -> list[T.StructField]:
    return [T.StructField(x, df.schema[c].dataType) for c, x in zip(columns, own_names(columns))]


def shown(df: DataFrame, columns: list[str], results: list[str]) -> DataFrame:
    """Columns under their own names again, then the results; a result replaces a column of its name."""
    taken = {r.lower() for r in results}
    return df.select(*[F.col(x).alias(c) for c, x in zip(columns, own_names(columns)) if c.lower() not in taken], *results)


def one_per_text(docs: DataFrame, id_col: str, text: str, name: str, max_rows: int = 200_000) -> tuple[DataFrame, DataFrame]:
    """(rows, texts). rows: doc_id, node (a 64-bit key of the text) and low, the least id with that text, of every
    row with a text. texts: node and text, once for each distinct text.

    Only the keys of the other copies are joined to the texts, which are not shuffled while those are few.
    """
    rows = docs.where(F.col(text).isNotNull()).select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("node"))
    rows = materialise(rows, f"{name}-rows")
    mine = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id")
    lows = rows.groupBy("node").agg(F.min(mine).alias("low"))
    each = rows.groupBy("node", "doc_id").agg(F.count(F.lit(1)).alias("copies")).join(lows, "node")
    other = each.select("node", "doc_id", (mine == F.col("low")).alias("first"), "copies").where("not first or copies > 1")
    other = small(materialise(other, f"{name}-copies"), max_rows).select(F.col("node").alias("n2"), F.col("doc_id").alias("d2"), "first")
    own = docs.where(F.col(text).isNotNull()).select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("node"), F.col(text).alias("text"))
    on = lambda o: (own["node"] == o["n2"]) & own["doc_id"].eqNullSafe(o["d2"])
    texts = own.join(other, on(other), "left_anti").select("node", "text")
    twins = other.where("first")  # one row of those that repeat id and text
    if twins.take(1):
        texts = texts.unionByName(own.join(twins, on(twins), "left_semi").dropDuplicates(["node"]).select("node", "text"))
    return rows.join(lows.select("node", F.col("low.doc_id").alias("low")), "node"), texts


def row_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that no slice holds more than ``limit`` bytes of the column, or one row."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64))
    at, base = 0, 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(at, end - at)
        at, base = end, int(ends[end - 1])


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column (null as empty) and row offsets into them, starting at 0."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_null(col.type):
        col = pa.nulls(len(col), pa.string())
    if col.null_count:
        col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64) \
        if off is not None and len(col) else np.zeros(len(col) + 1, np.int64)
    buf = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return buf, off - off[0]


def _table(pred) -> np.ndarray:
    return np.array([bool(pred(b)) for b in range(256)])


#: Runs of anything but ASCII white space.
SPACED = _table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: Runs of digits, ASCII letters and everything beyond ASCII.
ALNUM = _table(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)
#: Lower-cases A-Z only.
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective), so that close inputs get unrelated values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_POW = [np.ones(1, np.uint64), np.ones(1, np.uint64)]  # powers of the base and of its inverse


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW[0]) <= n:
        size = 1 << int(n).bit_length()
        with np.errstate(over="ignore"):
            for k, b in enumerate((int(_HASH_BASE), pow(int(_HASH_BASE), -1, 1 << 64))):
                p = np.full(size + 1, np.uint64(b), np.uint64)
                p[0] = 1
                _POW[k] = np.multiply.accumulate(p)
    return _POW[0], _POW[1]


class Words:
    """Words of a slice of texts: byte starts and ends, word offsets per row, 64-bit hashes."""

    def __init__(self, col: pa.Array, word: np.ndarray, fold: bool = True, hashes: bool = True):
        self.buf, self.off = text_bytes(col)
        if fold:
            self.buf = LOWER[self.buf]
        n = len(self.buf)
        mask = np.zeros(n + 1, bool)
        mask[:n] = word[self.buf]
        edge = np.zeros(n + 1, bool)
        edge[self.off] = True
        before = np.empty(n + 1, bool)
        before[0], before[1:] = False, mask[:-1]
        self.start = np.flatnonzero(mask & (~before | edge))
        self.end = np.flatnonzero(before & (~mask | edge))
        #: word offsets: row r has words row[r]:row[r+1]
        self.row = np.searchsorted(self.start, self.off)
        self.hash = self._hash() if hashes else None

    def _hash(self) -> np.ndarray:
        """Polynomial hash of each word's bytes, mixed with its length; worked out in bounded pieces."""
        out = np.empty(len(self.start), np.uint64)
        at = 0
        with np.errstate(over="ignore"):
            while at < len(self.start):
                b0 = self.start[at]
                to = max(at + 1, int(np.searchsorted(self.end, b0 + (1 << 20), "right")))
                b1 = self.end[to - 1]
                up, down = _powers(int(b1 - b0))
                pre = np.zeros(b1 - b0 + 1, np.uint64)
                np.cumsum(_BYTE[self.buf[b0:b1]] * up[:b1 - b0], out=pre[1:])
                s, e = self.start[at:to] - b0, self.end[at:to] - b0
                out[at:to] = mix64((pre[e] - pre[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
                at = to
        return out

    def counts(self) -> np.ndarray:
        return np.diff(self.row)

    def of(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(len(self.off) - 1), self.counts())


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive word hashes (positions 0 .. len-n)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = out * np.uint64(0x9DDFEA08EB382D69) + h[k:k + m]
    return mix64(out)


def signed(x: np.ndarray) -> np.ndarray:
    """uint64 as the long of the same bits, as Spark has no unsigned type."""
    return x.view(np.int64)


def crc_mod(col: str, mod: int) -> F.Column:
    """crc32 of the id as text, mod ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % mod
