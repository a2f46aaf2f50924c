"""Spelling variants against a comparison of all pairs of words."""

import collections
import random
import re
import zlib

from pyspark.sql import functions as F

from commentguard.llm import spelling as S

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return any(a[:k] + a[k + 1:] == b for k in range(len(a)))


def brute(docs, min_chars=6, min_count=5, dropped=True):
    n = collections.Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if dropped and h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    words = {w: k for w, k in n.items() if len(w) >= min_chars and k >= min_count}
    out = {}
    for w in words:
        others = [v for v in words if near(w, v)]
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form = best if best is not None and words[best] >= 5 * words[w] else None
        out[w] = [form, None, words[w], len(others), words[form] if form else None]
    for w in out:
        at = w
        while out[at][0]:
            at = out[at][0]
        out[w][1] = at
    return {w: tuple(v) for w, v in out.items()}


def collected(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def fixture():
    rnd = random.Random(11)
    letters = "abé"
    words = ["".join(rnd.choice(letters) for _ in range(rnd.randint(5, 7))) for _ in range(300)]
    words += ["aaaaaa", "aaaaaaa", "aaaaaaaa", "aaaaaab", "Aaaaaab", "naïveté", "naiveté", "ÀÀÀÀÀÀ", "àààààà", "×÷×÷×÷×", "é" * 6, "z" * 3000, "z" * 3001]
    docs = []
    for i in range(60):
        text = " ".join(rnd.choice(words) for _ in range(120))
        docs.append((i if i % 7 else None, text.upper() if i % 11 == 0 else text))
    docs += [(100, None), (101, ""), (102, "1234 ... \n"), (103, " ".join(["chaina"] * 700 + ["chainb"] * 130 + ["chainbc"] * 25 + ["chainbcd"] * 5))]
    docs += [(104, "z" * 3000 + " " + "z" * 3001)] * 6 + [docs[1]] * 3
    return docs


def test_variants_equal_all_pairs_over_many_parts(spark):
    docs = fixture()
    want = brute(docs)
    df = spark.createDataFrame([(*d, "w", "n", "x") for d in docs], "doc_id long, text string, word string, n string, wid string").repartition(4)
    for part_words in (7, 100_000):
        assert collected(S.variants(df, part_words=part_words)) == want
    assert want["chainbcd"][:2] == ("chainbc", "chaina") and any(v[3] > 2 for v in want.values())
    plain = S.variants(df, min_chars=4, min_count=2, dropped=False)
    assert collected(plain) == brute(docs, 4, 2, False)


def test_dropped_code_points(spark):
    docs = [(i, "Straßen Häuser fenster") for i in range(1200)]
    got = collected(S.variants(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == brute(docs) and {"straßen", "häuser", "fenster"} <= set(got)


def test_no_words(spark):
    assert S.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert S.variants(spark.createDataFrame([(1, None), (2, "short words once only")], "doc_id long, text string")).count() == 0


def test_nodes_are_equal_just_for_equal_prefixes(spark):
    words = sorted({"".join(random.Random(k).choices("ab", k=random.Random(k + 1).randint(1, 9))) for k in range(300)})
    df = spark.createDataFrame(list(enumerate(words)), "wid long, key string")
    by_node, by_prefix = {}, {}
    for r in S.trie_nodes(df, "test", part_words=11).collect():
        w = words[r["wid"]]
        assert len(r["nodes"]) == len(w) + 1 and r["heads"] == [k == 0 or w[k] != w[k - 1] for k in range(len(w))]
        for k, node in enumerate(r["nodes"]):
            assert by_node.setdefault(node, w[:k]) == w[:k] and by_prefix.setdefault(w[:k], node) == node


def test_groups_are_no_larger_than_the_alphabet(spark):
    """Words under a pair of nodes differ in one code point, so no key grows with the corpus."""
    words = [f"hotkey{a}{b}" for a in "abcdefghij" for b in "abcdefghij"]
    df = S.numbered(spark.createDataFrame([(w, 5) for w in words], "word string, n long"), "test")
    near_ = S.neighbours(df)
    assert near_.count() == 100 and {r["n_near"] for r in near_.collect()} == {18}
