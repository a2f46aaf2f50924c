"""Longest matches against every pair of places, with words that repeat in documents and items."""

import random
import time
import tracemalloc

import numpy as np
import pyarrow as pa

from commentguard.llm import decontaminate as DC
from commentguard.llm.common import ALNUM, Words


def searcher(items, window):
    words = []
    for t in items:
        words.append(Words(pa.array([t]), ALNUM).hash)
    return DC.Searcher([f"i{k}" for k in range(len(items))], words, window)


def by_hand(doc, item, window):
    """(start, length) of matches of the words that lie inside no other match with the item."""
    d, b = doc.split(), item.split()
    size = min(window, len(b))
    found = set()
    for p in range(len(d)):
        longest = 0
        for q in range(len(b)):
            n = 0
            while p + n < len(d) and q + n < len(b) and d[p + n] == b[q + n]:
                n += 1
            longest = max(longest, n)
        if size and longest >= size:
            found.add((p, longest))
    return {(p, n) for p, n in found if not any((q, m) != (p, n) and q <= p and q + m >= p + n for q, m in found)}


def test_matches_against_every_pair(monkeypatch):
    rnd = random.Random(11)
    for trial, lines in enumerate([1 << 21] * 20 + [1] * 20):
        monkeypatch.setattr(DC, "_LINES", lines)
        monkeypatch.setattr(DC, "_AUTOMATA", 3)
        letters = "abcdefgh"[:rnd.randint(1, 8)]
        items = [" ".join(rnd.choice(letters) for _ in range(rnd.randint(1, 25))) for _ in range(5)]
        docs = [" ".join(rnd.choice([*letters, "zz"]) for _ in range(rnd.randint(0, 40))) + " " + rnd.choice(["", rnd.choice(items), "q " + items[0][:19]])
                for _ in range(12)]
        n, spans, hit_items, matches = DC._judge(searcher(items, 4), pa.array(docs))
        for i, doc in enumerate(docs):
            want = {(f"i{k}", p, m) for k, item in enumerate(items) for p, m in by_hand(doc, item, 4)}
            got = [(m["item"], m["start"], m["length"]) for m in matches[i].as_py()]
            assert len(got) == len(set(got)) and set(got) == want, (trial, doc, items)
            assert hit_items[i].as_py() == sorted({x for x, _, _ in want})
            marked = {x for s in spans[i].as_py() for x in range(s["start"], s["stop"])}
            assert marked == {x for _, p, m in want for x in range(p, p + m)}


def test_one_word_thousands_of_times():
    s = searcher(["a " * 800, "prompt of ten words that every item shares here now x", "a b"], 10)
    doc = "a " * 200_000
    tracemalloc.start()
    began = time.time()
    n, spans, items, matches = DC._judge(s, pa.array([doc, "a b"]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n.to_pylist() == [200_000, 2] and items.to_pylist() == [["i0"], ["i2"]]
    assert spans[0].as_py() == [{"start": 0, "stop": 200_000}]
    found = np.array([(m["start"], m["length"]) for m in matches[0].as_py()])
    assert len(found) == 200_000 - 799 and (found[:, 1] == 800).all() and (found[:, 0] == np.arange(len(found))).all()
    assert peak < 400 << 20 and time.time() - began < 60
