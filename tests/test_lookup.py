"""Array look-ups against a word-by-word loop."""

import random

import pyarrow as pa

from commentguard.operators.lookup import Cleaner, Phrases, Replacer, slices, words_of


def by_hand(text, expand, stop, phrases):
    words = []
    for token in text.split(" "):
        for w in expand.get(token, [token] if token else []):
            words += [w[:-1], "."] if len(w) > 1 and w[-1] == "." else [w]
    out, at = [], 0
    while at < len(words):
        best = max((p for p in phrases if words[at:at + len(p)] == p), key=len, default=None)
        w = "_".join(best) if best else words[at]
        at += len(best) if best else 1
        if w not in stop:
            out.append(w)
    return " ".join(out)


def test_cleaner_equals_a_loop():
    rnd = random.Random(7)
    tokens = ["a", "b", "c", "d", "é", "e.", "é.", ".", "..", "x", "ab", "c.", "中文"]
    expand = {"x": ["a", "b."], "ab": [], "d": ["d", "c", "é."], "..": ["."]}
    phrases = [["a", "b"], ["a", "b", "c"], ["b", "c"], ["c", "c"], ["c", "c", "c"], [".", "a"], ["é", "."]]
    for stop in (set(), {"a", ".", "b_c", "é"}):
        texts = [" ".join(rnd.choice(tokens) for _ in range(rnd.randint(0, 14))) for _ in range(600)] + ["", " ", "  a  b ", "x"]
        for k in (0, len(phrases)):
            c = Cleaner(expand, stop, phrases[:k])
            want = [by_hand(t, expand, stop, phrases[:k]) for t in texts]
            assert c.apply(pa.array(texts)).to_pylist() == want
            assert c.apply(pa.array(["zz", *texts]).slice(1)).to_pylist() == want  # an array that starts inside its buffers
    assert Cleaner({}, set(), []).apply(pa.array([None, "", "b"])).to_pylist() == ["", "", "b"]


def test_matches_end_with_their_text():
    c = Cleaner({}, set(), [["a", "b"]])
    assert c.apply(pa.array(["a", "b a", "b", "a b"])).to_pylist() == ["a", "b a", "b", "a_b"]


def test_replacer_and_slices():
    r = Replacer({"cafe": ["café"], "a": ["à"]})
    texts = pa.array(["cafe a  b", "", "b", "a"])
    assert r.apply(texts).to_pylist() == ["café à b", "", "b", "à"]
    assert Replacer({}).apply(texts).to_pylist() == ["cafe a b", "", "b", "a"]
    assert [p.to_pylist() for p in slices(texts, 4)] == [["cafe a  b"], ["", "b", "a"]]
    distinct, codes, off = words_of(pa.array(["b a", "", "a"]))
    assert distinct.to_pylist() == ["b", "a"] and codes.tolist() == [0, 1, 1] and off.tolist() == [0, 2, 2, 3]


def test_long_overlapping_run():
    words = ["c"] * 1001
    c = Phrases([["c", "c"]])
    import numpy as np
    at, n, _ = c.longest_matches(pa.array(["c"]), np.zeros(len(words), np.int64), np.array([0, len(words)]))
    assert at.tolist() == list(range(0, 1000, 2)) and set(n.tolist()) == {2}
