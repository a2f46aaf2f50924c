"""Packing: token ids, cuts, whole coverage of every document, gapless sequences, and how few they are."""

import collections
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from commentguard.llm import catalog
from commentguard.llm import packing as K
from commentguard.llm.common import read_table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(K.tokenizer_path())


def plain(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, K.END]


def test_ids_equal_the_tokenizers(tokenizer):
    rnd = random.Random(5)
    marks = [*"ab'sé <|>\n\t\r.9!", " ", "　", "\x85", "ñ", "中", "\U0001F600", "<|endoftext|>", " word", "  ", "'ll", "=" * 50]
    texts = ["".join(rnd.choice(marks) for _ in range(rnd.randint(0, 60))) for _ in range(3000)] + ["", None, " ", "x" * 30_000]
    # every code point beside letters, digits, punctuation and spaces, so that its class shows
    texts += ["".join(f"a{c}b {c} 1{c}{c}!{c}  {c}" for c in map(chr, range(k, k + 256)) if not 0xD800 <= ord(c) <= 0xDFFF) for k in range(1, 0x30000, 256)]
    ids, off = K.encode(texts, K.tokenizer_path())
    for k, e in enumerate(tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)):
        assert [*e.ids, K.END] == ids[off[k]:off[k + 1]].tolist(), texts[k]


def test_other_tokenizer_files_go_through_the_library():
    path = K.tokenizer_path("word_bpe_49k.json")
    ids, off = K.encode(["Some words, here", None], path, 7)
    assert ids.tolist() == [*Tokenizer.from_file(path).encode("Some words, here", add_special_tokens=False).ids, 7, 7]


def check(rows, ids_of, capacity):
    """Rows (key, piece, start, length, sequence, offset, ids) cover every document and fill sequences without gaps."""
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for key, piece, start, length, seq, offset, _ in rows:
        by_doc[key].append((piece, start, length))
        by_seq[seq].append((offset, length))
    assert set(by_doc) == set(ids_of)
    for key, pieces in by_doc.items():
        n = len(ids_of[key])
        head = n - (-(-n // capacity) - 1) * capacity
        want = [(0, 0, head)] + [(k, head + (k - 1) * capacity, capacity) for k in range(1, -(-n // capacity))]
        assert sorted(pieces) == want
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_seq), -(-sum(map(len, ids_of.values())) // capacity)


def test_query_packs_every_document(spark, tokenizer):
    ids_of = {r["doc_id"]: plain(tokenizer, r["text"]) for r in read_table(spark, SF, "documents").select("doc_id", "text").collect()}
    rows = catalog.REGISTRY["op12_pack"][0](spark, SF).collect()
    for r in rows:
        ids = np.array(ids_of[r["doc_id"]][r["start"]:r["start"] + r["length"]], "<u4")
        assert zlib.crc32(ids.tobytes()) == r["ids_crc32"]
    n, least = check([(r["doc_id"], r["piece"], r["start"], r["length"], r["sequence_id"], r["offset"], None) for r in rows], ids_of, 1024)
    assert n <= least * 1.02 + 1


def test_edges_and_sequences(spark, tokenizer):
    long = " ".join(f"w{i * 7919 % 100003}" for i in range(20_000))
    texts = [None, "", " ", "same words", "same words", long, "<|endoftext|>", "x" * 50_000] + ["hot"] * 40
    docs = spark.createDataFrame([(i, t, "p", "r", "k") for i, t in enumerate(texts)], "doc_id long, text string, piece string, rank string, own0_ string")
    ids_of = {i: plain(tokenizer, t) for i, t in enumerate(texts)}
    packed = K.pack(docs.repartition(4), ["doc_id", "own0_", "piece", "rank"], capacity=64)
    assert packed.columns == ["doc_id", "own0_", "rank", "piece", "start", "length", "ids", "sequence_id", "offset"]
    rows = packed.collect()
    assert all(r["own0_"] == "k" and r["rank"] == "r" for r in rows)
    for r in rows:
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids_of[r["doc_id"]][r["start"]:r["start"] + r["length"]]
    n, least = check([(r["doc_id"], r["piece"], r["start"], r["length"], r["sequence_id"], r["offset"], None) for r in rows], ids_of, 64)
    assert n <= least + 1
    whole = K.sequences(packed).collect()
    assert sum(len(r["ids"]) for r in whole) == 4 * sum(map(len, ids_of.values()))
    assert all(len(r["ids"]) == 4 * sum(r["lengths"]) <= 4 * 64 for r in whole)
    assert K.pack(docs.where("false"), ["doc_id"]).count() == 0


def test_rows_that_repeat_an_id_are_packed_one_by_one(spark):
    docs = spark.createDataFrame([(None, "a b c")] * 5 + [(1, "a b c")] * 5, "doc_id long, text string")
    rows = K.pack(docs.repartition(3), ["doc_id"], capacity=8).collect()
    assert len(rows) == 10 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 10
    assert len({r["sequence_id"] for r in rows}) == 5  # two of four tokens each


@pytest.mark.parametrize("name", ["uniform", "short", "long", "mixed", "one", "hot"])
def test_plan_uses_every_piece_once_and_wastes_little(name):
    rng = np.random.default_rng(3)
    lengths = {"uniform": rng.integers(1, 1024, 20_000), "short": np.full(5000, 20), "long": rng.integers(513, 1025, 3000),
               "mixed": np.append(rng.integers(1, 60, 20_000), rng.integers(500, 1024, 3000)), "one": np.array([700]),
               "hot": np.append(np.full(10_000, 341), rng.integers(1, 1024, 3000))}[name]
    h = np.bincount(lengths, minlength=1025)
    used, n = np.zeros(1025, int), 0
    for pattern, repeats in K.plan(h):
        assert repeats > 0 and sum(length * times for length, times in pattern.items()) <= 1024
        n += repeats
        for length, times in pattern.items():
            used[length] += times * repeats
    assert (used == h).all()
    least = max(-(-int(lengths.sum()) // 1024), int(h[513:].sum()))
    assert n <= least * 1.012 + 1
    assert len(K.slots(K.plan(h * 1_000_000))["key"]) < 50_000


def test_fit_lowers_the_error_to_near_nothing():
    h = np.zeros(17, np.int64)
    h[[3, 5, 7, 8, 13]] = [40, 30, 20, 60, 25]
    pats = K.patterns(np.flatnonzero(h), 16)
    x = K.fit(pats, h)
    made = np.zeros(17)
    for (a, times, b, c), n in zip(pats, x):
        for length, k in ((a, times), (b, 1), (c, 1)):
            made[length] += k * n * (length > 0)
    assert (x >= 0).all() and np.abs(made - h)[1:].sum() < 0.35 * h.sum()
