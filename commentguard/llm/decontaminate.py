"""Benchmark decontamination with suffix arrays over the training side.

Every slice of a task's documents is a shard: its words become ids of the benchmark's
vocabulary (0 for any other word and at document ends), and the suffixes that can hold a
whole window are sorted into a suffix array. Each suffix of each benchmark item is then
binary-searched, which gives the range of all locations where its window (``window`` words;
a shorter item is one window) occurs. Hits that follow each other on one diagonal are the
longest verbatim matches: those inside no other match of the same document and item. In an item
that repeats a window, a place lies on many diagonals; there a suffix automaton of the item reads the
document's run of hits once, so that time and memory follow the words, not their product. Leaving out suffixes that run into a word the benchmark does not
have loses nothing: no window can occur there.

The benchmark is cut into blocks of at most ``block_words`` words (an item stays whole), each
sent to the tasks on its own; the documents are read once for each block. No shuffle for a
single block; for several, the rows are written once with a number each, on which the blocks' hits are merged.

Defined cases: null and empty texts have no words, no hits and are clean; items without words
occur nowhere; an item with a null id marks words but is not listed; repeated document rows
are judged row by row; repeated items count once; empty tables give empty or clean results;
very long texts are read whole, in slices of rows; columns of the documents pass through, whatever
their names, the results are named ``hit_*``; matches of equal start are listed by item.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentguard.llm.common import ALNUM, PART_BYTES, Words, carried, materialise, own_fields, own_names, read_table, row_slices, shown

WINDOW = 10
BLOCK_WORDS = 2_000_000
_LINES = 1 << 21  # (place, item) lines worked on at once, or one document
_AUTOMATA = 100_000  # words of items whose automata are kept
_MATCH = "array<struct<item:string,start:int,length:int>>"


def _item_words(batches):
    for batch in batches:
        for part in row_slices(batch, "text", PART_BYTES):
            w = Words(part.column("text"), ALNUM)
            blobs = [w.hash[a:b].tobytes() for a, b in zip(w.row[:-1], w.row[1:])]
            yield pa.RecordBatch.from_arrays([part.column("item"), pa.array(w.counts(), pa.int64()), pa.array(blobs, pa.binary())],
                                             ["item", "n", "words"])


class Automaton:
    """Suffix automaton of one item's words: the states of all its passages."""

    def __init__(self, words: list[int]):
        self.next, self.link, self.size = [{}], [-1], [0]
        last = 0
        for x in words:
            state, at = self._add({}, 0, self.size[last] + 1), last
            while at >= 0 and x not in self.next[at]:
                self.next[at][x] = state
                at = self.link[at]
            if at >= 0:
                to = self.next[at][x]
                if self.size[to] > self.size[at] + 1:  # passages of two lengths part here
                    short = self._add(dict(self.next[to]), self.link[to], self.size[at] + 1)
                    while at >= 0 and self.next[at].get(x) == to:
                        self.next[at][x] = short
                        at = self.link[at]
                    self.link[to] = to = short
                self.link[state] = to
            last = state

    def _add(self, moves: dict[int, int], link: int, size: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.size.append(size)
        return len(self.next) - 1

    def longest(self, words: list[int]) -> np.ndarray:
        """Length of the longest passage of the item that ends at each word."""
        out, state, length = np.zeros(len(words), np.int64), 0, 0
        for i, x in enumerate(words):
            while state > 0 and x not in self.next[state]:
                state = self.link[state]
                length = self.size[state]
            if x in self.next[state]:
                state, length = self.next[state][x], length + 1
            out[i] = length
        return out


class Searcher:
    """One block of the benchmark, ready to be searched for in shards."""

    def __init__(self, items: list[str | None], words: list[np.ndarray], window: int):
        self.items, self.window = items, window
        self.vocab = np.unique(np.concatenate(words)) if words else np.zeros(0, np.uint64)
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(self.vocab & np.uint64(0xFFFF)).astype(np.int64)] = True
        keys, lens, at, of = [], [], [], []
        for k, w in enumerate(words):
            size = min(window, len(w))
            if not size:
                continue
            ids = np.searchsorted(self.vocab, w).astype(np.uint32) + 1
            n = len(w) - size + 1
            mat = np.zeros((n, window), ">u4")
            mat[:, :size] = np.lib.stride_tricks.sliding_window_view(ids, size)
            keys.append(mat)
            lens.append(np.full(n, size))
            at.append(np.arange(n))
            of.append(np.full(n, k))
        if keys:
            mat = np.ascontiguousarray(np.concatenate(keys).astype(">u4"))  # big-endian: byte order is word order
            all_keys = mat.view(f"S{4 * window}").ravel()
            # equal windows (same words, same length) are searched once
            self.low, first, inv = np.unique(all_keys, return_index=True, return_inverse=True)
            self.len = np.concatenate(lens)[first]
            top = mat[first].copy()
            top[np.arange(window)[None, :] >= self.len[:, None]] = 0xFFFFFFFF
            self.high = np.ascontiguousarray(top).view(f"S{4 * window}").ravel()
            order = np.argsort(inv, kind="stable")
            use_at, use_of, use_win = np.concatenate(at)[order], np.concatenate(of)[order], inv[order]
            # each item once per window
            new = np.append(True, (np.diff(use_win) != 0) | (np.diff(use_of) != 0))
            self.loops = np.zeros(len(items), bool)
            self.loops[use_of[~new]] = True
            self.use_at, self.use_of = use_at[new], use_of[new]
            self.use = np.searchsorted(use_win[new], np.arange(len(self.low) + 1))
            self.words, self.automata, self.kept = words, {}, 0
            self.least = int(self.len.min())
        else:
            self.low = np.zeros(0, f"S{4 * window}")

    def automaton(self, item: int) -> Automaton:
        if item not in self.automata:
            if self.kept > _AUTOMATA:
                self.automata, self.kept = {}, 0
            self.automata[item] = Automaton(self.words[item].tolist())
            self.kept += len(self.words[item])
        return self.automata[item]

    def hits(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(word position, searched window) of every occurrence in the shard."""
        none = np.zeros(0, np.int64)
        if not len(self.low) or not len(w.hash):
            return none, none
        ids = np.zeros(len(w.hash) + self.window, np.uint32)
        maybe = np.flatnonzero(self.seen[(w.hash & np.uint64(0xFFFF)).astype(np.int64)])
        spot = np.minimum(np.searchsorted(self.vocab, w.hash[maybe]), len(self.vocab) - 1)
        ok = self.vocab[spot] == w.hash[maybe]
        ids[maybe[ok]] = spot[ok] + 1
        n = len(w.hash)
        stops = np.unique(np.concatenate([np.flatnonzero(ids[:n] == 0), w.row[1:]]))
        known = np.flatnonzero(ids[:n])
        run = np.minimum(stops[np.searchsorted(stops, known, "right")], n) - known
        # a document that ends here also stops the run that starts before its end
        keep = run >= self.least
        pos, run = known[keep], np.minimum(run[keep], self.window)
        if not len(pos):
            return none, none
        mat = ids[pos[:, None] + np.arange(self.window)[None, :]].astype(">u4")
        mat[np.arange(self.window)[None, :] >= run[:, None]] = 0
        suffix = np.ascontiguousarray(mat).view(f"S{4 * self.window}").ravel()
        order = np.argsort(suffix, kind="stable")
        array = suffix[order]
        lo, hi = np.searchsorted(array, self.low, "left"), np.searchsorted(array, self.high, "right")
        count = hi - lo
        found = np.repeat(np.arange(len(self.low)), count)
        inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return pos[order[np.repeat(lo, count) + inside]], found


def _scan(block, keep: list[str], window: int, text: str):
    def go(batches):
        items, words = block.value
        searcher = Searcher(items, [np.frombuffer(x, np.uint64) for x in words], window)
        for batch in batches:
            for part in row_slices(batch, text, 2 * PART_BYTES):
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + _judge(searcher, part.column(text)), names=keep + _NEW)
    return go


_NEW = ["hit_words", "hit_spans", "hit_items", "hit_matches"]


def _matches(s: Searcher, w: Words, row_of: np.ndarray, pos: np.ndarray, win: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, words, item) of the longest matches behind the hits of some documents."""
    # one line for each item that has the window at a place
    count = s.use[win + 1] - s.use[win]
    at = np.repeat(s.use[win], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    p, size, item = np.repeat(pos, count), np.repeat(s.len[win], count), s.use_of[at]
    diag = np.where(s.loops[item], 0, p - s.use_at[at])
    order = np.lexsort((p, diag, item, row_of[p]))
    p, size, item, diag = (x[order] for x in (p, size, item, diag))
    new = np.append(True, (np.diff(row_of[p]) != 0) | (np.diff(item) != 0) | (np.diff(diag) != 0) | (np.diff(p) != 1))
    head = np.flatnonzero(new)
    start, length, item = p[head], p[np.append(head[1:], len(p)) - 1] + size[head] - p[head], item[head]
    loops = s.loops[item]
    out = [(start[~loops], length[~loops], item[~loops])]
    for a, n, k in zip(start[loops], length[loops], item[loops]):
        ending = s.automaton(int(k)).longest(w.hash[a:a + n].tolist())
        stop = np.flatnonzero((np.append(ending[1:], 0) != ending + 1) & (ending >= s.window))
        out.append((a + stop + 1 - ending[stop], ending[stop], np.full(len(stop), k)))
    return tuple(np.concatenate(x) for x in zip(*out))


def _judge(s: Searcher, texts: pa.Array) -> list[pa.Array]:
    w = Words(texts, ALNUM)
    pos, win = s.hits(w)
    docs = len(w.off) - 1
    mark = np.zeros(len(w.hash) + 1, np.int32)
    items, matches, spans = [[]] * docs, [[]] * docs, [[]] * docs
    if len(pos):
        np.add.at(mark, pos, 1)
        np.add.at(mark, pos + s.len[win], -1)
        row_of = w.of()
        order = np.argsort(pos, kind="stable")
        pos, win = pos[order], win[order]
        lines = np.cumsum(s.use[win + 1] - s.use[win])
        ends = np.append(np.flatnonzero(np.diff(row_of[pos])) + 1, len(pos))  # of each document's hits
        at = 0
        while at < len(pos):
            most = _LINES + (lines[at - 1] if at else 0)
            end = int(ends[max(np.searchsorted(ends, at, "right"), np.searchsorted(lines[ends - 1], most, "right") - 1)])
            p, length, item = _matches(s, w, row_of, pos[at:end], win[at:end])
            doc = row_of[p]
            order = np.lexsort((length, item, p))
            p, length, item, doc = (x[order] for x in (p, length, item, doc))
            cut = np.flatnonzero(np.append(True, np.diff(doc) != 0))
            for a, b in zip(cut, np.append(cut[1:], len(doc))):
                d = doc[a]
                names = [s.items[k] for k in item[a:b]]
                items[d] = sorted({x for x in names if x is not None})
                matches[d] = [{"item": x, "start": int(q - w.row[d]), "length": int(n)} for x, q, n in zip(names, p[a:b], length[a:b])]
            at = end
        hit = np.cumsum(mark[:-1]) > 0
        inner = hit[1:] & hit[:-1]
        inner[np.intersect1d(w.row[1:-1] - 1, np.arange(len(inner)))] = False  # runs end with their document
        first = np.flatnonzero(hit & ~np.append(False, inner))
        last = np.flatnonzero(hit & ~np.append(inner, False))
        rows = row_of[first]
        cut = np.flatnonzero(np.append(True, np.diff(rows) != 0)) if len(rows) else []
        for a, b in zip(cut, np.append(cut[1:], len(rows))):
            d = rows[a]
            spans[d] = [{"start": int(x - w.row[d]), "stop": int(y + 1 - w.row[d])} for x, y in zip(first[a:b], last[a:b])]
    span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    match = pa.list_(pa.struct([("item", pa.string()), ("start", pa.int32()), ("length", pa.int32())]))
    return [pa.array(w.counts(), pa.int64()), pa.array(spans, span), pa.array(items, pa.list_(pa.string())), pa.array(matches, match)]


def _blocks(bench: DataFrame, item: str, text: str, block_words: int):
    """The benchmark's words in blocks of proven size: number of blocks, (item ids as strings, word hashes)."""
    words = bench.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")) \
        .mapInArrow(_item_words, "item string, n bigint, words binary")
    words = materialise(words.where("n > 0"), "decon-items")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = max(1, math.ceil(total / block_words))
    for k in range(parts):
        rows = words.where(F.pmod(F.xxhash64("words"), F.lit(parts)) == k).collect()
        yield parts, ([r["item"] for r in rows], [bytes(r["words"]) for r in rows])


def find_benchmark(docs: DataFrame, bench: DataFrame, keep: list[str], text: str = "text", item: str = "item_id",
                   item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The ``keep`` columns of each document row with hit_words (its number of words), hit_spans
    (word ranges inside occurrences), hit_items (ids as strings, sorted) and hit_matches (longest
    verbatim matches: item, first word, number of words).
    """
    return shown(_find(docs, bench, keep, text, item, item_text, window, block_words), keep, _NEW)


def _find(docs: DataFrame, bench: DataFrame, keep: list[str], text: str, item: str, item_text: str, window: int,
          block_words: int) -> DataFrame:
    sc = docs.sparkSession.sparkContext
    out, own = None, own_names(keep)
    schema = T.StructType(own_fields(docs, keep) + T._parse_datatype_string(
        f"hit_words long, hit_spans array<struct<start:int,stop:int>>, hit_items array<string>, hit_matches {_MATCH}").fields)
    columns, name = carried(keep, text, "hit_text")
    slim = docs.select(*columns)
    more = []
    for parts, block in _blocks(bench, item, item_text, block_words):
        shared = sc.broadcast(block)
        if parts == 1:
            return slim.mapInArrow(_scan(shared, own, window, name), schema)
        if out is None:  # rows get numbers of their own, written, so that every block sees the same ones
            number = T.StructField("hit_row", T.LongType(), False)
            slim = materialise(slim.withColumn("hit_row", F.monotonically_increasing_id()), "decon-rows")
            out = slim.mapInArrow(_scan(shared, [*own, "hit_row"], window, name), T.StructType([*schema.fields[:len(own)], number, *schema.fields[len(own):]]))
        else:
            narrow = slim.select("hit_row", name).mapInArrow(_scan(shared, ["hit_row"], window, name), T.StructType([number, *schema.fields[len(own):]]))
            more.append(narrow.where(F.size("hit_spans") > 0).drop("hit_words"))
    if more:
        lists = ("hit_spans", "hit_items", "hit_matches")
        rest = functools.reduce(DataFrame.unionByName, more).groupBy("hit_row").agg(*[F.flatten(F.collect_list(c)).alias(f"more_{c}") for c in lists])
        rest = materialise(rest, "decon-hits")
        out = out.join(rest, "hit_row", "left").withColumns(
            {c: F.concat(c, F.coalesce(f"more_{c}", F.array().cast(schema[c].dataType))) for c in lists}).drop("hit_row", *[f"more_{c}" for c in lists])
        out = out.withColumn("hit_items", F.array_sort(F.array_distinct("hit_items")))
        merged = F.aggregate(F.array_sort("hit_spans"), F.array().cast("array<struct<start:int,stop:int>>"), lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["stop"] >= x["start"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1)["start"].alias("start"),
                F.greatest(F.element_at(acc, -1)["stop"], x["stop"]).alias("stop"))))).otherwise(F.concat(acc, F.array(x))))
        out = out.withColumn("hit_spans", merged)
    return out


def hit_words(spans: str = "hit_spans") -> F.Column:
    """Words inside the spans of find_benchmark."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + (s["stop"] - s["start"]).cast("long"))


def remove_contaminated(docs: DataFrame, bench: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
                        window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The document rows in which no benchmark window occurs, with their own columns."""
    found = _find(docs, bench, docs.columns, text, item, item_text, window, block_words)
    return shown(found.where(F.size("hit_spans") == 0), docs.columns, [])


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: what of the benchmark occurs in every document."""
    docs, bench = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    found = find_benchmark(docs.select("doc_id", "text"), bench, ["doc_id"])
    return found.select("doc_id", F.col("hit_words").alias("n_words"), hit_words().alias("n_hit"),
                        F.size("hit_items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"),
                        (F.size("hit_spans") > 0).alias("contaminated"))


_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS ws FROM benchmark),
bw AS (SELECT item, least({WINDOW}, len(ws)) AS k, ws, unnest(range(1, len(ws) - least({WINDOW}, len(ws)) + 2)) AS i
       FROM b WHERE len(ws) > 0),
keys AS (SELECT DISTINCT item, k, array_to_string(ws[i:i + k - 1], ' ') AS w FROM bw),
sizes AS (SELECT DISTINCT k FROM keys),
dw AS (SELECT rid, k, ws, unnest(range(1, len(ws) - k + 2)) AS i FROM d, sizes WHERE len(ws) >= k),
dk AS (SELECT rid, k, i, array_to_string(ws[i:i + k - 1], ' ') AS w FROM dw),
hits AS (SELECT rid, dk.k, i, item FROM dk JOIN keys ON dk.k = keys.k AND dk.w = keys.w),
pos AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM hits) GROUP BY rid),
its AS (SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT rid, item FROM hits WHERE item IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(pos.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items,
       sha256(coalesce(its.ids, '')) AS items_sha256, coalesce(pos.n, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN its USING (rid)
"""

QUERIES = {"op6_decontaminate": (op6_decontaminate, SQL)}
