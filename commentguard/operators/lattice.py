"""Compound segmentation in context (B6): a lattice of words and compounds, the likeliest path taken.

Where words of a text make up compounds of the lexicon, each of them may stand alone or in one of
those compounds. A text's units are chosen together, by the product over neighbouring units of

    (n(u, v) + PRIOR * n(v) / N) / (n(u) + PRIOR)

with n(u) the places of the corpus where the words of u stand, n(u, v) those where the words of v
follow them, and N all words; the text's ends count as a unit each. Viterbi's recursion finds the
best path (ties: the longer unit before). The greedy choice is ``cleaning.clean_comments``.

Matches with the lexicon are found in each distinct text; only these, with the word
before and behind them, are grouped by text. Costs are worked out per pair of units that occurs and
joined with the lattices' edges (broadcast where proven small), so a frequent word is looked up once
per neighbour, not once per place. Texts come in again only to be written out.

Defined cases: a null or blank text becomes an empty one; words are what lies between single spaces of
the normalised text, a full stop that ends a longer word being one of its own; equal texts get equal
results and count as often as they stand there; phrases of less than two words are ignored; an empty
lexicon or corpus joins nothing, or goes by the corpus' counts of zero; only the columns named are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from ..functions.text import offline_text, online_text
from ..session import scratch_path
from ..sizing import BROADCAST_BYTES, fits, maybe_broadcast
from .lookup import slices, words_of

PRIOR = 1.0
_PATH = StructType().add("start", IntegerType()).add("n", IntegerType())
_EDGE = StructType().add("start", IntegerType()).add("n", IntegerType()).add("m", IntegerType()).add("u", StringType()).add("v", StringType())


@dataclass
class LatticeModel:
    """``units``: unit, n (words joined by a space; "" is a text's begin). ``pairs``: u, v, n. ``total``: words of the corpus."""

    units: DataFrame
    pairs: DataFrame
    total: int


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _words(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda w: w != "")


def _normal(docs: DataFrame, text_col: str, mode: str) -> Column:
    if mode not in ("online", "offline"):
        raise ValueError(f"mode must be 'online' or 'offline', not {mode!r}")
    text = online_text(text_col) if mode == "online" else offline_text(text_col)
    return F.array_join(_words(F.regexp_replace(text, r"(?<=[^ ])\.(?= |$)", " .")), " ")


def phrases(compounds: DataFrame) -> DataFrame:
    """The lexicon's phrases of two or more words, joined by a space."""
    syllables = F.filter(F.split(F.regexp_replace("phrase", "_", " "), " "), lambda x: x != "")
    return compounds.select(syllables.alias("s")).where(F.size("s") >= 2).select(F.array_join("s", " ").alias("phrase"), F.size("s").alias("n")).distinct()


class PhraseTable:
    """Phrases as a trie of word numbers: a step is a key (state * words + word) and the state it leads to."""

    def __init__(self, phrases: list[str]):
        cut = [p.split(" ") for p in phrases]
        self.words = sorted({w for p in cut for w in p})
        self.longest = max((len(p) for p in cut), default=0)
        number = {w: k for k, w in enumerate(self.words)}
        state = {(w,): k for k, w in enumerate(self.words)}  # a first word is its own state
        steps = {}
        for p in cut:
            for n in range(2, len(p) + 1):
                to = state.setdefault(tuple(p[:n]), len(state))
                steps[state[tuple(p[:n - 1])] * len(self.words) + number[p[n - 1]]] = to
        self.keys = np.array(sorted(steps), np.int64)
        self.to = np.array([steps[k] for k in sorted(steps)], np.int64)
        self.phrase = {state[tuple(p)]: " ".join(p) for p in cut}
        self.ends = np.array(sorted(self.phrase), np.int64)

    def find(self, distinct: pa.Array, codes: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, words, state) of all phrases that stand in the texts, by first word and length."""
        known = pc.index_in(distinct, pa.array(self.words, pa.string())).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        word = known[codes] if len(codes) else np.zeros(0, np.int64)
        last = np.repeat(off[1:], np.diff(off))  # end of each word's text
        at = np.flatnonzero(word >= 0)
        state = word[at]
        first, size, end = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for n in range(2, self.longest + 1):
            go = at + n - 1 < last[at]
            at, state = at[go], state[go]
            go = word[at + n - 1] >= 0
            at, state = at[go], state[go]
            key = state * len(self.words) + word[at + n - 1]
            k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            go = self.keys[k] == key
            at, state = at[go], self.to[k[go]]
            hit = np.isin(state, self.ends)
            first.append(at[hit])
            size.append(np.full(int(hit.sum()), n))
            end.append(state[hit])
        first, size, end = np.concatenate(first), np.concatenate(size), np.concatenate(end)
        order = np.lexsort((size, first))
        return first[order], size[order], end[order]


_MATCH = "array<struct<pos:int,n:int,phrase:string,before:string,after:string>>"
_PLACES = pa.list_(pa.struct([("pos", pa.int32()), ("n", pa.int32()), ("phrase", pa.string()), ("before", pa.string()), ("after", pa.string())]))


def _found(shared):
    @F.arrow_udf(_MATCH)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = shared.value
        for texts in batches:
            out = []
            for part in slices(texts):
                distinct, codes, off = words_of(part)
                first, size, end = table.find(distinct, codes, off)
                row = np.searchsorted(off, first, "right") - 1
                named = pa.array([table.phrase[s] for s in end.tolist()], pa.string())
                before = np.where(first > off[row], codes[np.maximum(first - 1, 0)], -1) if len(first) else first
                follow = first + size
                after = np.where(follow < off[row + 1], codes[np.minimum(follow, len(codes) - 1)], -1) if len(first) else first
                beside = [pc.fill_null(distinct.take(pa.array(np.maximum(x, 0), mask=x < 0)), "") for x in (before, after)]
                places = pa.StructArray.from_arrays([pa.array(first - off[row] + 1, pa.int32()), pa.array(size, pa.int32()), named, *beside],
                                                    ["pos", "n", "phrase", "before", "after"])
                cuts = np.searchsorted(row, np.arange(len(part) + 1))
                out.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), places))
            yield pa.concat_arrays(out) if out else pa.array([], _PLACES)

    return found


def matches(texts: DataFrame, lexicon: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(key, copies, pos, n, phrase, before, after) of the lexicon's phrases in texts (key, copies, t).

    A lexicon that is proven small is looked up where the texts are, by whole arrays of words; runs of
    words are only cut out, and joined, for a larger one.
    """
    if fits(lexicon, max_bytes=max_bytes):
        table = PhraseTable([r["phrase"] for r in lexicon.select("phrase").collect()])
        found = _found(texts.sparkSession.sparkContext.broadcast(table))
        return texts.select("key", "copies", F.explode(found("t")).alias("m")).select("key", "copies", "m.*")
    sizes = sorted(r["n"] for r in lexicon.select("n").distinct().collect())  # lengths of phrases: a handful
    if not sizes:
        sizes = [2]
    words = texts.select("key", "copies", F.concat(F.array(F.lit("")), _words(F.col("t")), F.array(F.lit(""))).alias("w"))

    def runs(n: int) -> Column:
        last = F.size("w") - n  # place 1 is the first word, counted from 0
        run = lambda i: F.struct(i.alias("pos"), F.lit(n).alias("n"), F.array_join(F.slice("w", i + 1, n), " ").alias("phrase"),
                                 F.get("w", i - 1).alias("before"), F.get("w", i + n).alias("after"))
        return F.when(last >= 2, F.transform(F.sequence(F.lit(1), last - 1), run)).otherwise(F.transform(F.array().cast("array<int>"), run))

    cut = words.select("key", "copies", F.explode(F.concat(*[runs(n) for n in sizes])).alias("m")).select("key", "copies", "m.*")
    return cut.join(maybe_broadcast(lexicon.select("phrase"), max_bytes), "phrase")


def lattice_edges(found: list[dict]) -> list[dict]:
    """Matches of a text -> edges (start and n of u, m words of v, u, v) between units that may follow each other."""
    nodes: dict[int, dict[int, str]] = {}
    for f in found:
        pos, words = f["pos"], f["phrase"].split(" ")
        nodes.setdefault(pos, {})[f["n"]] = f["phrase"]
        for k, word in enumerate([f["before"], *words, f["after"]]):
            nodes.setdefault(pos - 1 + k, {})[1] = word
    return [{"start": s, "n": n, "m": m, "u": u, "v": v}
            for s in sorted(nodes) for n, u in sorted(nodes[s].items()) for m, v in sorted(nodes.get(s + n, {}).items())]


def best_path(edges: list[dict]) -> list[tuple[int, int]]:
    """(start, words) of the compounds on the best paths; edges (start, n, m, cost) in order of start."""
    score: dict[tuple[int, int], float] = {}
    back: dict[tuple[int, int], tuple[int, int]] = {}
    inner = set()
    for e in edges:
        u = e["start"], e["n"]
        v = e["start"] + e["n"], e["m"]
        inner.add(u)
        sum_ = score.get(u, 0.0) + e["cost"]
        if v not in score or (sum_, -u[1]) < (score[v], -back[v][1]):
            score[v], back[v] = sum_, u
    out = []
    for node in score.keys() - inner:
        while node is not None:
            if node[1] > 1:
                out.append(node)
            node = back.get(node)
    return sorted(out)


@F.arrow_udf(ArrayType(_EDGE))
def _edges(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32()), ("m", pa.int32()), ("u", pa.string()), ("v", pa.string())]))
    for batch in batches:
        yield pa.array([lattice_edges(found.as_py()) for found in batch], kind)  # a text at a time


@F.arrow_udf(ArrayType(_PATH))
def _paths(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32())]))
    for batch in batches:
        yield pa.array([[{"start": s, "n": n} for s, n in best_path(edges.as_py())] for edges in batch], kind)


@F.arrow_udf(StringType())
def _joined(texts: pa.Array, picks: pa.Array) -> pa.Array:
    out = []
    for text, chosen in zip(texts.to_pylist(), picks):
        units, at = [], 0
        words = text.split(" ")
        for pick in chosen.as_py() or ():
            first = pick["start"] - 1
            units += words[at:first]
            at = first + pick["n"]
            units.append("_".join(words[first:at]))
        out.append(" ".join(units + words[at:]))
    return pa.array(out, pa.string())


def _texts(docs: DataFrame, text_col: str, mode: str) -> DataFrame:
    """Each distinct text once, with its number of copies."""
    return docs.select(_normal(docs, text_col, mode).alias("t")).groupBy(F.unhex(F.sha2("t", 256)).alias("key")) \
        .agg(F.first("t").alias("t"), F.count(F.lit(1)).alias("copies"))


def _lattices(found: DataFrame) -> DataFrame:
    per_text = found.groupBy("key").agg(F.collect_list(F.struct("pos", "n", "phrase", "before", "after")).alias("f"), F.max("copies").alias("copies"))
    return per_text.select("key", "copies", F.explode(_edges("f")).alias("e")).select("key", "copies", "e.*")


def pair_counts(corpus: DataFrame, compounds: DataFrame, text_col: str = "text", mode: str = "online", max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(u, v, n): places where v follows u, for pairs with a compound or a word that some compound holds; "" at a text's ends."""
    texts = _kept(_texts(corpus, text_col, mode).where("t <> ''"), "lattice-texts")
    lexicon = phrases(compounds)
    return _pairs(texts, lexicon, _kept(matches(texts, lexicon, max_bytes), "lattice-matches"), max_bytes)


def _pairs(texts: DataFrame, lexicon: DataFrame, found: DataFrame, max_bytes: int) -> DataFrame:
    ends = F.lit("")
    words = _words(F.col("t"))
    near = texts.select("copies", F.explode(F.arrays_zip(F.concat(F.array(ends), words).alias("u"),
                                                                          F.concat(words, F.array(ends)).alias("v"))).alias("p"))
    near = near.select("copies", "p.u", "p.v")
    parts = lexicon.select(F.explode(F.split("phrase", " ")).alias("part")).distinct()
    small = fits(parts, max_bytes=max_bytes)
    # pairs of a small lexicon's words are picked before they are counted, those of a large one are joined once each
    if not small:
        near = near.groupBy("u", "v").agg(F.sum("copies").alias("copies"))
    for side in ("u", "v"):
        known = parts.select(F.col("part").alias(side), F.lit(True).alias(f"in_{side}"))
        near = near.join(F.broadcast(known) if small else known, side, "left")
    near = near.where("in_u or in_v").groupBy("u", "v").agg(F.sum("copies").alias("n"))
    joint = _lattices(found).where("n > 1 or m > 1").groupBy("u", "v").agg(F.sum("copies").alias("n"))
    return near.unionByName(joint)


def fit_lattice(corpus: DataFrame, compounds: DataFrame, text_col: str = "text", mode: str = "online", max_bytes: int = BROADCAST_BYTES) -> LatticeModel:
    """Units and pairs counted over the whole corpus."""
    texts = _kept(_texts(corpus, text_col, mode).where("t <> ''"), "lattice-texts")
    words = texts.select("copies", F.explode(_words(F.col("t"))).alias("unit")).groupBy("unit").agg(F.sum("copies").alias("n"))
    lexicon = phrases(compounds)
    found = _kept(matches(texts, lexicon, max_bytes), "lattice-matches")
    joint = found.groupBy(F.col("phrase").alias("unit")).agg(F.sum("copies").alias("n"))
    begin = texts.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n")).select(F.lit("").alias("unit"), "n")
    units = _kept(words.unionByName(joint).unionByName(begin), "lattice-units")
    total = units.where("unit <> '' and not contains(unit, ' ')").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return LatticeModel(units, _kept(_pairs(texts, lexicon, found, max_bytes), "lattice-pairs"), total)


def segment(docs: DataFrame, compounds: DataFrame, id_col: str = "id", text_col: str = "text", model: LatticeModel | None = None,
            mode: str = "online", prior: float = PRIOR, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """B6 in context: (id, text) -> (id, segmented), compounds joined by "_"; counted on docs themselves if no model is given."""
    model = model or fit_lattice(docs, compounds, text_col, mode, max_bytes)
    edges = _kept(_lattices(matches(_texts(docs, text_col, mode), phrases(compounds), max_bytes)), "lattice-edges")
    costs = edges.select("u", "v").distinct().join(model.pairs.withColumnRenamed("n", "n_uv"), ["u", "v"], "left")
    for side in ("u", "v"):
        costs = costs.join(maybe_broadcast(model.units, max_bytes).select(F.col("unit").alias(side), F.col("n").alias(f"n_{side}")), side, "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    # a unit that the corpus does not have counts as half a place
    share = F.greatest(n("n_v"), F.lit(0.5)) / max(model.total, 1)
    cost = F.log((n("n_u") + prior) / (n("n_uv") + prior * share))
    costs = _kept(costs.select("u", "v", cost.alias("cost")), "lattice-costs")
    paths = edges.join(maybe_broadcast(costs, max_bytes), ["u", "v"]).groupBy("key") \
        .agg(F.sort_array(F.collect_list(F.struct("start", "n", "m", "cost"))).alias("e")).select("key", _paths("e").alias("picks"))
    base = docs.select(id_col, _normal(docs, text_col, mode).alias("__t")).withColumn("__key", F.unhex(F.sha2("__t", 256)))
    return base.join(paths.withColumnRenamed("key", "__key"), "__key", "left").select(id_col, _joined("__t", "picks").alias("segmented"))
