"""Accent restoration in context (B25): forms of a spelling chosen by their neighbours.

A word without accents may stand for any form that the corpus has of its spelling, itself
included. A text's forms are chosen together: the chain of its words has the likelihood of its
neighbouring pairs over that of its single words,

    prod (n(a, b) + PRIOR * q(a) * q(b)) / prod q(a)

with n(a, b) the times the forms a and b stand side by side and q(a) the share of form a among the
words of its spelling; words with accents, words of spellings that have none, and the text's ends
have one form and q = 1. Viterbi's recursion finds the best chain (ties: the greater form).

Only pairs with a word to choose take part. Which words have forms, a text learns as in B25 without
context: the forms of frequent words are sent to the tasks, each other word of a text is asked for
once, by the text's hash. So pairs are counted only where a side has an accented form, and a text asks
only for the counts of pairs with a word to choose; no row of a word or pair holds its text.

Defined cases: a null or blank text becomes an empty one; words are what lies between single spaces of
the lower-cased, whitespace-collapsed text; equal texts get equal results; an empty corpus changes
nothing. Only the columns named are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.text import offline_text
from ..sizing import BROADCAST_BYTES
from .lookup import slices, words_of
from .tags import FOLD_FROM, FOLD_TO, fold, kept, looked_up, word_counts

PRIOR = 100.0
_FOLD = str.maketrans(FOLD_FROM, FOLD_TO)


@dataclass
class AccentModel:
    """``forms``: folded, forms (form, share), for spellings with an accented form. ``pairs``: fa, fb, seen (a, b, n), for pairs
    with such a word. ``counts``: word, n, of all words; without it no word counts as frequent."""

    forms: DataFrame
    pairs: DataFrame
    counts: DataFrame | None = None


def _chain_of(codes: np.ndarray, off: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of texts, one after the other, with ``end`` before and behind each text that has words, and their texts' numbers."""
    rows = np.flatnonzero(np.diff(off))
    at = off[:-1][rows]
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    return np.append(np.insert(codes, at, end), end), np.append(np.insert(row, at, rows), len(off) - 1)


def _texts(batches: Iterator[pa.RecordBatch], hot: set[str]):
    """For slices of texts: the rows, distinct words and "" behind them, which are known lines, the chain of their codes and its texts."""
    for batch in batches:
        at = 0
        for part in slices(batch.column("__t")):
            rows = batch.slice(at, len(part))
            at += len(part)
            distinct, codes, off = words_of(part)
            names = [*distinct.to_pylist(), ""]
            rare = set(rows.column("found").flatten().field("word").to_pylist())
            line = np.fromiter((w in hot or w in rare for w in names), bool, len(names))
            yield (rows, names, line, *_chain_of(codes, off, len(names) - 1))


def _known_pairs(shared):
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = {w for w, v in shared.value.items() if v is not None}
        for _, names, line, chain, _ in _texts(batches, hot):
            known = line | np.fromiter((not w.isascii() and w != w.translate(_FOLD) for w in names), bool, len(names))
            keep = known[chain[:-1]] | known[chain[1:]]
            pair, n = np.unique(chain[:-1][keep] * len(names) + chain[1:][keep], return_counts=True)
            words = pa.array(names, pa.string())
            yield pa.RecordBatch.from_arrays([words.take(pa.array(pair // len(names))), words.take(pa.array(pair % len(names))), pa.array(n)], ["a", "b", "n"])

    return pairs


def _asked_pairs(shared):
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = {w for w, v in shared.value.items() if v is not None}
        for rows, names, line, chain, row in _texts(batches, hot):
            folded = pa.array([w if w.isascii() else w.translate(_FOLD) for w in names], pa.string()).dictionary_encode()
            codes, spellings = folded.indices.to_numpy().astype(np.int64), folded.dictionary
            keep = line[chain[:-1]] | line[chain[1:]]
            a, b, size = codes[chain[:-1]][keep], codes[chain[1:]][keep], len(spellings)
            once = np.unique((row[:-1][keep] * size + a) * size + b)
            yield pa.RecordBatch.from_arrays([rows.column("__h").take(pa.array(once // size // size)), spellings.take(pa.array(once // size % size)),
                                              spellings.take(pa.array(once % size))], ["__h", "fa", "fb"])

    return pairs


def _with_lines(texts: DataFrame, table: DataFrame, counts: DataFrame | None, max_bytes: int):
    """Broadcast lines of frequent words, and the texts with the lines ``found`` for their other words."""
    hot, found = looked_up(texts, table, counts, max_bytes)
    none = F.array().cast(found.schema["found"].dataType)
    rows = texts.withColumn("__h", F.xxhash64("__t")).join(found, "__h", "left").withColumn("found", F.coalesce("found", none))
    return texts.sparkSession.sparkContext.broadcast(hot), rows


def pair_counts(corpus: DataFrame, forms: DataFrame, text_col: str = "text", max_bytes: int = BROADCAST_BYTES,
                counts: DataFrame | None = None) -> DataFrame:
    """(fa, fb, a, b, n): how often forms stand side by side, where the spelling of either has an accented form."""
    texts = corpus.select(offline_text(text_col).alias("__t"))
    shared, rows = _with_lines(texts, forms.select(F.col("folded").alias("word"), F.lit(True).alias("value")), counts, max_bytes)
    near = rows.select("__t", "found").mapInArrow(_known_pairs(shared), "a string, b string, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))
    return near.select(fold("a").alias("fa"), fold("b").alias("fb"), "a", "b", "n")


def fit_accents(corpus: DataFrame, text_col: str = "text", max_bytes: int = BROADCAST_BYTES) -> AccentModel:
    """Forms and neighbouring pairs, counted over the whole corpus."""
    counts = kept(word_counts(corpus.select(offline_text(text_col).alias("__t"))), "accent-words")
    forms = counts.groupBy(fold("word").alias("folded")).agg(F.collect_list(F.struct(F.col("word").alias("form"), "n")).alias("f"), F.sum("n").alias("all")) \
        .where(F.exists("f", lambda x: x["form"] != F.col("folded"))) \
        .select("folded", F.array_sort(F.transform("f", lambda x: F.struct(x["form"].alias("form"), (x["n"] / F.col("all")).alias("share")))).alias("forms"))
    forms = kept(forms, "accent-forms")
    pairs = pair_counts(corpus, forms, text_col, max_bytes, counts).groupBy("fa", "fb").agg(F.collect_list(F.struct("a", "b", "n")).alias("seen"))
    return AccentModel(forms, kept(pairs, "accent-pairs"), counts)


def best_chain(links: list[dict], prior: float = PRIOR) -> dict[int, str]:
    """Form chosen at each place, for the links of a text in order of their place.

    A link holds ``pos`` (of its right word), the candidates ``ca`` and ``cb`` as (form, share), and the
    counts ``seen`` of (a, b). Links that share a place follow each other in one chain.
    """
    chosen: dict[int, str] = {}
    score: dict[str, float] = {}
    back: list[tuple[int, dict[str, str]]] = []

    def settle() -> None:
        if back:
            form = max(score, key=lambda f: (score[f], f))
            for pos, before in reversed(back):
                chosen[pos] = form
                form = before[form]
            chosen[back[0][0] - 1] = form

    last = None
    for link in links:
        if last is None or link["pos"] != last + 1:
            settle()
            score, back = {c["form"]: 0.0 for c in link["ca"]}, []
        seen = {(s["a"], s["b"]): s["n"] for s in link["seen"] or ()}
        share = {c["form"]: c["share"] for c in link["ca"]}
        now, before = {}, {}
        for c in link["cb"]:
            b, q = c["form"], c["share"]
            best = max((score[a] + math.log(seen.get((a, b), 0) + prior * p * q), a) for a, p in share.items())
            now[b], before[b] = best[0] - math.log(q), best[1]
        score, last = now, link["pos"]
        back.append((last, before))
    settle()
    return chosen


def choose(text: str, forms: Callable[[str], list | None], seen: dict[tuple[str, str], list], prior: float = PRIOR) -> str:
    """The text with the best chain of forms; ``seen``: counts of (a, b) by their spellings, for pairs with a word to choose."""
    words = text.split(" ")
    options = {i: f for i, w in enumerate(words) if (f := forms(w))}
    if not options:
        return text
    chain = ["", *words, ""]
    alone = lambda w: [{"form": w, "share": 1.0}]
    links = [{"pos": i, "ca": options.get(i - 1) or alone(chain[i]), "cb": options.get(i) or alone(chain[i + 1]),
              "seen": seen.get((chain[i].translate(_FOLD), chain[i + 1].translate(_FOLD)))} for i in sorted({p for i in options for p in (i, i + 1)})]
    best = best_chain(links, prior)
    for i in options:
        words[i] = best[i]
    return " ".join(words)


def _chooser(shared, prior: float):
    @F.arrow_udf(StringType())
    def put(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        hot = shared.value
        for texts, found, seen in batches:
            out = []
            for text, lines, counts in zip(texts.to_pylist(), found, seen):  # a text at a time
                rare = {x["word"]: x["value"] for x in lines.as_py()}
                pairs = {(x["fa"], x["fb"]): x["seen"] for x in counts.as_py() or ()}
                out.append(choose(text, lambda w: rare.get(w) or hot.get(w), pairs, prior))
            yield pa.array(out, pa.string())

    return put


def restore_in_context(docs: DataFrame, id_col: str = "id", text_col: str = "text", model: AccentModel | None = None,
                       prior: float = PRIOR, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """B25 in context: (id, text) -> (id, restored); the model is counted on docs themselves if none is given."""
    model = model or fit_accents(docs, text_col, max_bytes)
    texts = docs.select(id_col, offline_text(text_col).alias("__t"))
    shared, rows = _with_lines(texts, model.forms.select(F.col("folded").alias("word"), F.col("forms").alias("value")), model.counts, max_bytes)
    rows = kept(rows, "accent-texts")
    asked = rows.select("__h", "__t", "found").mapInArrow(_asked_pairs(shared), "__h bigint, fa string, fb string")
    seen = asked.join(model.pairs, ["fa", "fb"]).groupBy("__h").agg(F.collect_set(F.struct("fa", "fb", "seen")).alias("seen"))
    return rows.join(seen, "__h", "left").select(id_col, _chooser(shared, prior)("__t", "found", "seen").alias("restored"))
