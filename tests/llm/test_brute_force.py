"""Every registered training-data query against DuckDB SQL, brute force in Python or held-out figures (sf0.001)."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
import oracle_harness as H
from commentguard.llm import catalog, embedding_dedup, hmm, language, ngram_join, passages, secrets, toxicity
from commentguard.llm.common import read_table

SF = "/root/testdata/sf0.001"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in read_table(spark, SF, "documents").select("doc_id", "text").collect()}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(FOLD))


@pytest.mark.parametrize("name", [k for k, (_, sql) in catalog.REGISTRY.items() if sql])
def test_matches_sql(spark, name):
    fn, sql = catalog.REGISTRY[name]
    n, diff = H.compare(fn(spark, SF), H.duck(SF), sql)
    assert n > 0 and not diff, diff[:2]


def test_op1_targets_and_repeats(spark, texts):
    fn = catalog.REGISTRY["op1_mix_sources"][0]
    rows = fn(spark, SF).collect()
    assert rows and sorted(map(tuple, rows), key=repr) == sorted(map(tuple, fn(spark, SF).collect()), key=repr)
    by = collections.defaultdict(list)
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r["doc_id"]])) and r["taken"] <= 3 * r["size"] and r["taken"] % max(r["size"], 1) == 0
        by[r["source"]].append(r)
    sizes = {s: sum(r["size"] for r in v) for s, v in by.items()}
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(sorted(by))}
    free, target = dict(sizes), {}
    rest = sum(sizes.values())
    while True:  # water filling by hand
        level = rest / sum(weight[s] for s in free)
        full = [s for s in free if weight[s] * level > 3 * sizes[s]]
        if not full:
            break
        for s in full:
            target[s] = 3 * free.pop(s)
            rest -= target[s]
    target |= {s: weight[s] * level for s in free}
    for s, v in by.items():
        assert v[0]["source_size"] == sizes[s] and abs(v[0]["target"] - target[s]) < 1e-6 * target[s]
        assert abs(sum(r["taken"] for r in v) - target[s]) <= max(r["size"] for r in v) / 2 + 1


def test_op2_against_all_pairs(spark):
    rows = catalog.REGISTRY["op2_embedding_dedup"][0](spark, "/root/testdata/sf0.1").collect()
    e = read_table(spark, "/root/testdata/sf0.1", "embeddings").toPandas()
    x = np.stack(e["embedding"].to_numpy()).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = collections.Counter()
    for k in e["label"].unique():
        at = np.flatnonzero(e["label"] == k)
        near = x[at] @ x[at].T >= embedding_dedup.THRESHOLD
        np.fill_diagonal(near, False)
        links.update(dict(zip(e["vec_id"].to_numpy()[at].tolist(), near.sum(1).tolist())))
    found = {r["vec_id"]: r["n_links"] for r in rows}
    assert len(rows) == len(e) and all(found[k] <= links[k] for k in found)
    assert sum(found.values()) >= 0.99 * sum(links.values())


def test_op2_finds_planted_groups(spark):
    rng = np.random.default_rng(0)
    centre = rng.normal(size=(40, 32))
    data = [(k * 10 + j, (centre[k] + (0.05 * j) * rng.normal(size=32)).tolist(), int(k % 3)) for k in range(40) for j in range(10)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")).collect()
    x = np.array([d[1] for d in data])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([d[2] for d in data])
    near = (x @ x.T >= 0.93) & (label[:, None] == label[None, :])
    want = {d[0]: int(n) - 1 for d, n in zip(data, near.sum(1))}
    assert sum(want.values()) > 500
    assert sum(r["n_links"] for r in got) >= 0.99 * sum(want.values()) and all(r["n_links"] <= want[r["vec_id"]] for r in got)


def test_op2_finds_rare_pairs(spark):
    """Hardly any pair in the table, and none among the calibration classes: the recall is measured on planted neighbours."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(6000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for k in range(60):
        side = rng.normal(size=64)
        side -= side @ x[k] * x[k]
        c = 0.931 + 0.019 * k / 60
        x[3000 + k] = c * x[k] + np.sqrt(1 - c * c) * side / np.linalg.norm(side)
    df = spark.createDataFrame([(k, v.tolist(), 1) for k, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = embedding_dedup.near_duplicates(df).collect()
    assert got[0]["recall"] >= embedding_dedup.PLANTED_RECALL and got[0]["visits"] > embedding_dedup.MIN_VISITS
    linked = {r["vec_id"] for r in got if r["n_links"]}
    assert linked <= set(range(60)) | set(range(3000, 3060)) and len(linked) >= 2 * 58
    assert all(r["component_id"] == r["vec_id"] - 3000 for r in got if r["vec_id"] in linked and r["vec_id"] >= 3000)


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def test_op3_base_spans(spark, texts):
    for r in catalog.REGISTRY["op3_find_secrets"][0](spark, SF).collect():
        t = texts[r["doc_id"]]
        base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
        base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        line = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(base))
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert set(filter(None, line.split(","))) <= set(r["spans"].split(","))


def test_op3_battery_tells_random_tokens_from_words(spark, texts):
    rng = np.random.default_rng(1)
    symbols = list(secrets.ALPHABETS["base62"])
    prose = [t for t in texts.values() if len(t) > 500]
    docs = [(k, f"{prose[k % len(prose)]} Zx{''.join(rng.choice(symbols, 40))}9 " + "".join(w.capitalize() for w in words(prose[k % len(prose)])[:8])) for k in range(150)]
    got = secrets.scan(spark.createDataFrame(docs, "id long, text string"), ["id"]).collect()
    hit = sum(any(s["kind"] == 3 and s["end"] - s["start"] == 43 for s in r["secret_spans"]) for r in got)
    false = sum(s["kind"] == 3 and s["end"] - s["start"] != 43 for r in got for s in r["secret_spans"])
    assert hit >= 120 and false <= 5


def test_op4_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in read_table(spark, sf, "labels").collect()}
    rows = [r for r in catalog.REGISTRY["op4_toxicity"][0](spark, sf).collect() if r["held_out"] and r["doc_id"] in labels]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 and (r["predicted"] == 1) == (r["score"] >= 0.3) for r in rows)
    hit = sum(r["predicted"] and labels[r["doc_id"]] for r in rows)
    assert hit >= 0.6 * sum(labels[r["doc_id"]] for r in rows) and hit >= 0.8 * sum(r["predicted"] for r in rows)


def test_op7_base_and_model(spark, texts):
    tokens = {k: re.findall(r"[^\x20\x09-\x0D]+", t.translate(FOLD)) + [None] for k, t in texts.items()}
    c = collections.Counter(w for k, v in tokens.items() if zlib.crc32(str(k).encode()) % 7 != 2 for w in v)
    n, v = sum(c.values()), len(c)
    rows = catalog.REGISTRY["op7_lm_score"][0](spark, SF).collect()
    for r in rows:
        own = tokens[r["doc_id"]]
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in own)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(c[w] > 0 for w in own), n)
        assert abs(r["base_score"] - base) < 1e-9 * abs(base)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_hmm_against_plain_forward():
    rng = np.random.default_rng(2)
    model = hmm.Hmm.first(rng.dirichlet(np.ones(7)), 3, seed=1)
    size = np.array([4, 1, 9, 4])
    start = np.cumsum(size) - size
    sym = rng.integers(0, 7, size.sum())
    got = hmm.log_likelihood(model, sym, start, size)
    plain = []
    for a, n in zip(start, size):
        alpha = model.start * model.emit[:, sym[a]]
        for t in range(a + 1, a + n):
            alpha = (alpha @ model.move) * model.emit[:, sym[t]]
        plain.append(math.log10(alpha.sum()))
    assert np.allclose(got, plain)
    before = got.sum()
    for _ in range(5):  # Baum-Welch never lowers the likelihood
        s, _, m, e = hmm.expected_counts(model, sym, start, size, np.ones(4, bool))
        assert abs(e.sum() - size.sum()) < 1e-3 and abs(m.sum() - (size - 1).sum()) < 1e-3
        model = hmm.Hmm(s / s.sum(), model.carry, m / m.sum(1, keepdims=True), e / e.sum(1, keepdims=True))
        after = hmm.log_likelihood(model, sym, start, size).sum()
        assert after >= before - 1e-4
        before = after


def test_prune_table_keeps_true_pairs():
    rng = np.random.default_rng(3)
    least = ngram_join.prune_table(0.8, ngram_join.HASHES, ngram_join.STEP, ngram_join.TOLERANCE)
    agree = np.cumsum(rng.random((20_000, ngram_join.HASHES)) < 0.8, axis=1)[:, ngram_join.STEP - 1::ngram_join.STEP]
    assert (agree >= least).all(1).mean() > 0.9995
    far = np.cumsum(rng.random((2_000, ngram_join.HASHES)) < 0.3, axis=1)[:, ngram_join.STEP - 1::ngram_join.STEP]
    assert (far >= least).all(1).mean() < 0.01


def test_op8_large_bucket_in_parts(spark, monkeypatch):
    rng = np.random.default_rng(4)
    common = [f"w{i}" for i in range(120)]
    docs = []
    for k in range(60):
        own = list(common)
        for at in rng.choice(120, k % 4, replace=False):
            own[at] = f"x{k}"
        docs.append((k, " ".join(own)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    grams = {k: {tuple(t.split()[i:i + 5]) for i in range(116)} for k, t in docs}
    want = {k: sum(5 * len(g & h) >= 4 * len(g | h) for j, h in grams.items() if j != k) for k, g in grams.items()}
    one = {r["doc_id"]: r["n_links"] for r in ngram_join.jaccard_join(df).collect()}
    monkeypatch.setattr(ngram_join, "PART", 16)
    parts = {r["doc_id"]: r["n_links"] for r in ngram_join.jaccard_join(df).collect()}
    assert one == want and parts == want


def test_op9_languages(spark):
    rows = catalog.REGISTRY["op9_language_id"][0](spark, SF).collect()
    right = sum(r["lang_id"] == r["lang"] for r in rows)
    assert right >= 0.98 * len(rows)
    pages = catalog.REGISTRY["op9_language_id_pages"][0](spark, SF).collect()
    assert sum(r["lang_id"] == r["said"] for r in pages) >= 0.98 * len(pages)


def test_op9_evidence_beyond_the_text(spark):
    docs = read_table(spark, SF, "documents").select("text", F.col("lang").alias("declared"))
    model = language.fit_text_model(docs)
    lines = [("en", "the and with this " * 5)] * 30 + [("fr", "les des est une pour " * 5)] * 30
    rows = [(k, t, None, f"host-{l}") for k, (l, t) in enumerate(lines)] + [(100, "on", None, "host-fr"), (101, "on", None, "host-en"), (102, "on", "fr", None)]
    df = spark.createDataFrame(rows, "id long, text string, said string, host string")
    got = {r["id"]: r["lang_best"] for r in language.identify(df, ["id"], "text", F.col("said"), F.col("host"), model=model).collect()}
    assert got[100] == "fr" and got[101] == "en"


def test_op10_covers_exact_repeats(spark, texts):
    tokens = {k: words(t) for k, t in texts.items()}
    where = collections.defaultdict(set)
    for k, v in tokens.items():
        for i in range(len(v) - 49):
            where[tuple(v[i:i + 50])].add(k)
    missed = total = 0
    for r in catalog.REGISTRY["op10_repeated_passages"][0](spark, SF).collect():
        v = tokens[r["doc_id"]]
        exact = {p for i in range(len(v) - 49) if len(where[tuple(v[i:i + 50])]) > 1 for p in range(i, i + 50)}
        got = {p for s in r["passages"] for p in range(s["start"], s["end"])}
        missed, total = missed + len(exact - got), total + len(exact)
        for s in r["passages"]:
            assert words(texts[r["doc_id"]][s["begin"]:s["stop"]]) == v[s["start"]:s["end"]]
    assert total > 0 and missed <= 0.002 * total


def test_op10_fuzzy_passage_and_clean_text(spark):
    rng = np.random.default_rng(5)
    filler = lambda n: " ".join(f"f{x}" for x in rng.integers(0, 10**9, n))
    passage = [f"p{x}" for x in rng.integers(0, 10**9, 90)]
    changed = list(passage)
    changed[40:41] = []
    changed[65] = "other"
    docs = [(0, f"{filler(80)} {' '.join(passage)} {filler(50)}"), (1, f"{filler(30)} {' '.join(changed)} {filler(70)}"), (2, filler(200))]
    got = {r["doc_id"]: r for r in passages.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[2]["n_passages"] == 0 and got[0]["partners"] == [1] and got[1]["partners"] == [0]
    assert [(s["start"], s["end"]) for s in got[0]["passages"]] == [(80, 170)]
    assert [(s["start"], s["end"]) for s in got[1]["passages"]] == [(30, 119)]


def test_op10_repeat_behind_common_seeds(spark):
    # every seed of a passage of two texts also occurs in many others, which share too little to count
    rng = np.random.default_rng(7)
    filler = lambda n: " ".join(f"f{x}" for x in rng.integers(0, 10**9, n))
    passage = [f"p{x}" for x in rng.integers(0, 10**9, 50)]
    docs = [(k, f"{filler(40)} {' '.join(passage)} {filler(30 + k)}") for k in range(2)]
    for k, at in enumerate(rng.integers(0, 34, 400).tolist(), 2):
        docs.append((k, f"{filler(50)} {' '.join(passage[at:at + 17])} {filler(20)}"))
    got = {r["doc_id"]: r for r in passages.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for k in range(2):
        assert [(s["start"], s["end"]) for s in got[k]["passages"]] == [(40, 90)] and got[k]["partners"] == [1 - k]
    assert not any(got[k]["n_passages"] for k in range(2, 402))


def test_op10_edited_passage_behind_common_seeds(spark):
    # an edited passage of two texts: each of its seeds also occurs in many others, which share too little to count
    rng = np.random.default_rng(11)
    filler = lambda n: " ".join(f"f{x}" for x in rng.integers(0, 10**9, n))
    passage = [f"p{x}" for x in rng.integers(0, 10**9, 80)]
    changed = list(passage)
    changed[20], changed[41], changed[62] = "other", "words", "here"
    docs = [(0, f"{filler(40)} {' '.join(passage)} {filler(30)}"), (1, f"{filler(25)} {' '.join(changed)} {filler(45)}")]
    for k, at in enumerate(rng.integers(0, 64, 800).tolist(), 2):
        docs.append((k, f"{filler(50)} {' '.join((passage, changed)[k % 2][at:at + 17])} {filler(20)}"))
    got = {r["doc_id"]: r for r in passages.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for k, at in ((0, 40), (1, 25)):
        assert [(s["start"], s["end"]) for s in got[k]["passages"]] == [(at, at + 80)] and got[k]["partners"] == [1 - k]
    assert not any(got[k]["n_passages"] for k in range(2, 802))


def test_op10_links_all_texts_of_a_passage(spark):
    # an edited passage of twelve texts: each is linked with all others, not only with the ends of a seed's list
    rng = np.random.default_rng(12)
    passage = [f"p{x}" for x in rng.integers(0, 10**9, 80)]
    docs = []
    for k in range(12):
        own = list(passage)
        own[30 + k] = f"o{k}"
        docs.append((k, " ".join([*(f"f{x}" for x in rng.integers(0, 10**9, 30)), *own])))
    got = {r["doc_id"]: r for r in passages.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for k in range(12):
        assert [(s["start"], s["end"]) for s in got[k]["passages"]] == [(30, 110)]
        assert got[k]["partners"] == [x for x in range(12) if x != k]


def test_chain_against_quadratic():
    rng = np.random.default_rng(6)
    start = rng.integers(0, 400, 60)
    end, other = start + rng.integers(6, 15, 60), rng.integers(0, 400, 60)
    best = [0.0] * 60
    for i in np.argsort(start):
        gain = max([best[j] - passages.GAP_COST * (start[i] - end[j] + other[i] - other[j] - (end[j] - start[j]))
                    for j in range(60) if end[j] <= start[i] and other[j] + end[j] - start[j] <= other[i] and best[j] > 0] + [0.0])
        best[i] = end[i] - start[i] + gain
    paths = passages.chain(start, end, other)
    assert sorted(i for p in paths for i in p) == list(range(60))
    first = paths[0]
    value = sum(end[i] - start[i] for i in first) - sum(
        passages.GAP_COST * (start[b] - end[a] + other[b] - other[a] - (end[a] - start[a])) for a, b in zip(first, first[1:]))
    assert abs(value - max(best)) < 1e-6


def test_toxicity_ignores_rare_words():
    assert toxicity._own(np.array([0.0, toxicity.RARE - 1.0, toxicity.RARE])).tolist() == [0, 0, toxicity.RARE - toxicity.DISCOUNT]


def test_pipeline_decisions(spark, texts):
    out = P.run(spark, SF)
    rows = out.collect()
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "mix_shard"]
    kept = {r["doc_id"] for r in rows}
    # brute force of what may be left: no repeated gram sets, no benchmark window, no secret
    grams = {}
    for k in kept:
        w = words(texts[k])
        grams[k] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else {k}
    ids = sorted(kept)
    for i, a in enumerate(ids):
        assert not any(5 * len(grams[a] & grams[b]) >= 4 * len(grams[a] | grams[b]) for b in ids[i + 1:])
    windows = set()
    for r in read_table(spark, SF, "benchmark").collect():
        w = words(r["text"] or "")
        windows |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    for k in kept:
        w = words(texts[k])
        assert not any(tuple(w[i:i + 10]) in windows for i in range(len(w) - 9))
    for r in rows:
        assert not re.search("[0-9a-f]{16}", r["text"]) and r["n_chars"] == len(r["text"])
    clean = [k for k, t in texts.items() if len(words(t)) >= 5]
    assert len(kept) >= 0.3 * len(clean)
