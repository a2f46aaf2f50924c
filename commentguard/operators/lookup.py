"""Words of a batch of texts looked up in lexicons, on Arrow buffers.

Texts are cut at single spaces into one Arrow array of words, which is dictionary-encoded:
lexicons see each distinct word of a slice once, and everything after that is whole-array work on
integer codes. There is no Python loop over rows or words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text worked on at once (a single longer text is worked on alone).
SLICE_BYTES = 16 << 20


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Cut an array of texts so that no slice holds more than ``limit`` bytes, or one text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at, base = 0, 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield texts.slice(at, end - at)
        at, base = end, int(ends[end - 1])


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, code of each word in order, word offsets of the texts): runs of anything but the space."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    _, off, data = texts.buffers()
    off = np.frombuffer(off, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    off = off - off[0]
    inside = np.zeros(len(buf) + 1, bool)
    inside[:-1] = buf != 0x20
    edge = np.zeros(len(buf) + 1, bool)
    edge[off] = True
    before = np.append(False, inside[:-1])
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    # words and what lies between them, as one array over the same bytes
    cuts = np.append(np.stack([starts, ends], 1).ravel(), ends[-1:] if len(ends) else 0)
    both = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(buf)))
    coded = both.take(pa.array(np.arange(0, 2 * len(starts), 2))).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.searchsorted(starts, off)


def gather(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices of the ranges [start, start + count), one after the other."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)


def join_words(pool: pa.Array, codes: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Texts of the words with these codes, by word offsets, joined by a space."""
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pool.take(pa.array(codes)))
    return pc.binary_join(lists, " ")


class Replacer:
    """Words replaced by others, as a table word -> words."""

    def __init__(self, table: dict[str, list[str]]):
        self.keys = pa.array(list(table), pa.string())
        self.values = pa.array([w for words in table.values() for w in words], pa.string())
        self.counts = np.array([len(words) for words in table.values()], np.int64)
        self.starts = np.cumsum(self.counts) - self.counts

    def find(self, distinct: pa.Array) -> np.ndarray:
        """Line of each distinct word, or -1."""
        if not len(self.keys):
            return np.full(len(distinct), -1, np.int64)
        return pc.fill_null(pc.index_in(distinct, value_set=self.keys), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def apply(self, texts: pa.Array) -> pa.Array:
        """Texts with every word that the table has (one for one) replaced."""
        distinct, codes, off = words_of(texts)
        hit = self.find(distinct)
        pool = pa.concat_arrays([distinct, self.values])
        return join_words(pool, np.where(hit >= 0, len(distinct) + self.starts[hit] if len(self.keys) else 0, np.arange(len(distinct)))[codes], off)


class Phrases:
    """Phrases of two or more words: a trie whose transitions are sorted arrays of (state, word) keys."""

    def __init__(self, phrases: list[list[str]], joiner: str = "_"):
        words = sorted({w for p in phrases for w in p})
        self.words, self.joined = pa.array(words, pa.string()), pa.array([joiner.join(p) for p in phrases], pa.string())
        number = {w: k for k, w in enumerate(words)}
        self.width = max(len(words), 1)
        moves, final = {}, {}
        for k, p in enumerate(phrases):
            state = 0
            for w in p:
                state = moves.setdefault((state, number[w]), len(moves) + 1)
            final[state] = k
        order = sorted(moves.items())
        self.keys = np.array([s * self.width + w for (s, w), _ in order], np.int64)
        self.next = np.array([t for _, t in order], np.int64)
        self.final = np.full(len(moves) + 1, -1, np.int64)
        for state, k in final.items():
            self.final[state] = k
        self.longest = max(map(len, phrases), default=0)

    def longest_matches(self, distinct: pa.Array, codes: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, words, phrase) of the matches taken greedily from the left, the longest at each start; none crosses a text's end."""
        none = np.zeros(0, np.int64)
        if not self.longest or not len(codes):
            return none, none, none
        number = pc.fill_null(pc.index_in(distinct, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)[codes]
        last = np.repeat(off[1:], np.diff(off))  # end of each word's text
        at = np.flatnonzero(number >= 0)
        state, length, phrase = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64), np.full(len(codes), -1, np.int64)
        for depth in range(self.longest):
            at = at[at + depth < last[at]]
            word = number[at + depth]
            key = state[at] * self.width + word
            k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            at_ok = (word >= 0) & (self.keys[k] == key)
            at, k = at[at_ok], k[at_ok]
            state[at] = self.next[k]
            done = self.final[state[at]]
            length[at[done >= 0]], phrase[at[done >= 0]] = depth + 1, done[done >= 0]
        found = np.flatnonzero(length)
        if not len(found):
            return none, none, none
        # those that are reached from the first by going on behind each match: pointer doubling
        jump = np.append(np.searchsorted(found, found + length[found]), len(found))
        taken = np.zeros(len(found) + 1, bool)
        taken[0] = True
        while True:
            reached = taken.copy()
            reached[jump[taken]] = True
            jump = jump[jump]
            if (reached == taken).all() and (jump == len(found)).all():
                break
            taken = reached
        found = found[taken[:-1]]
        return found, length[found], phrase[found]


class Cleaner:
    """Abbreviations expanded, full stops split off, phrases joined, stopwords dropped, in that order."""

    def __init__(self, expand: dict[str, list[str]], stop: set[str], phrases: list[list[str]]):
        split = lambda w: [w[:-1], "."] if len(w) > 1 and w[-1] == "." else [w]
        self.expand = Replacer({k: [x for w in words for x in split(w)] for k, words in expand.items()})
        self.stop = pa.array(sorted(stop), pa.string())
        self.phrases = Phrases(phrases)

    def apply(self, texts: pa.Array) -> pa.Array:
        distinct, codes, off = words_of(texts)
        n = len(distinct)
        hit = self.expand.find(distinct)
        dotted = pc.and_(pc.ends_with(distinct, "."), pc.greater(pc.binary_length(distinct), 1)).to_numpy(zero_copy_only=False) & (hit < 0)
        stems = pc.utf8_slice_codeunits(distinct.filter(pa.array(dotted)), 0, -1)
        # words that come out of each distinct word, as ranges of one list: itself, a stem and a stop, an expansion
        pool = pa.concat_arrays([distinct, stems, pa.array(["."]), self.expand.values]).dictionary_encode()
        pool, same = pool.dictionary, pool.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        k = int(dotted.sum())
        parts = np.concatenate([same[:n], np.stack([same[n:n + k], np.full(k, same[n + k])], 1).ravel(), same[n + k + 1:]])
        start, count = np.arange(n), np.ones(n, np.int64)
        start[dotted], count[dotted] = n + 2 * np.arange(k), 2
        long = hit >= 0
        if long.any():
            start[long], count[long] = n + 2 * k + self.expand.starts[hit[long]], self.expand.counts[hit[long]]
        each = count[codes]
        words = parts[gather(start[codes], each)]
        off = np.append(0, np.cumsum(each))[off]
        stop = pc.is_in(pool, value_set=self.stop).to_numpy(zero_copy_only=False) if len(self.stop) else np.zeros(len(pool), bool)
        drop = stop[words]
        first, length, phrase = self.phrases.longest_matches(pool, words, off)
        if len(first):
            inner = gather(first + 1, length - 1)
            drop[inner] = True
            stop = pc.is_in(self.phrases.joined, value_set=self.stop).to_numpy(zero_copy_only=False) if len(self.stop) else np.zeros(len(self.phrases.joined), bool)
            drop[first] = stop[phrase]
            words[first] = len(pool) + phrase
            pool = pa.concat_arrays([pool, self.phrases.joined])
        keep = np.append(0, np.cumsum(~drop))
        return join_words(pool, words[~drop], keep[off])
