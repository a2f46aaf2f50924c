"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, per operator."""

import datetime as dt
import os
import subprocess
import sys

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from commentguard.llm import decontaminate, embedding_dedup, hmm, language, mixing, ngram_join, passages, secrets, toxicity, warc
from commentguard.llm.common import crc_mod

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = " ".join(f"alpha{i} beta{i % 7} gamma{i % 3}" for i in range(60))
LONG = " ".join(f"w{i * 7919 % 100003}" for i in range(60_000))


def rows():
    texts = [PROSE, PROSE, PROSE + " omega", None, "", "   \n", "one", "öß é ñ 中文 words here", LONG, PROSE.upper(), "token = \"fc22f42429fef2ebde85e081b172bc127a2eef28\" end"]
    out = [(i, t, "en" if i % 2 else None, None if i == 3 else f"s{i % 3}", len(t) if t is not None else None) for i, t in enumerate(texts)]
    out += [out[0], (None, PROSE, "en", "s1", 5), (None, None, None, None, None)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, " ".join(PROSE.split()[5:40])), (2, "one"), (2, "one"), (3, None), (None, "words here"), (4, "")], "item_id long, text string")


CLASH = ["own0_", "node", "tkey", "hit_text", "lang_text", "lang_ll", "secret_text", "mix_size", "mix_key", "size", "label", "low", "n", "d2", "block"]


def clashing(df):
    return df.select("*", *[F.lit(c).alias(c) for c in CLASH])


@pytest.mark.parametrize("name,stage", P.STAGES)
def test_stage_edges(spark, docs, nothing, bench, tmp_path, name, stage):
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    out = stage(spark, docs, str(tmp_path))
    assert out.columns[:5] == docs.columns
    got = out.collect()
    assert len(got) <= 3 * docs.count()
    assert stage(spark, nothing, str(tmp_path)).count() == 0
    more = stage(spark, clashing(docs), str(tmp_path))
    assert more.columns[:5 + len(CLASH)] == docs.columns + CLASH
    assert more.count() == len(got)
    assert all(r["node"] == "node" for r in more.select("node").collect())


def test_mix_edges(spark, docs, nothing):
    out = mixing.draw(docs, mixing.SIZE_EXPR, ["doc_id", "text"]).collect()
    assert len(out) == docs.count()
    for r in out:
        if not (r["text"] or "").strip():
            assert r["mix_size"] == 0 and r["mix_copies"] == []
        assert len(r["mix_copies"]) <= 3
    assert mixing.draw(nothing, mixing.SIZE_EXPR, ["doc_id", "text"]).count() == 0


def test_targets_cap_and_share(spark):
    sizes = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 500), (None, 100), ("é", 0)], "source string, source_size long")
    got = {r["source"]: r for r in mixing.targets(sizes).collect()}
    assert [got[s]["weight"] for s in ("a", "b", "c", "é", None)] == [1, 2, 3, 1, 2]
    assert abs(sum(r["target"] for r in got.values()) - 1610) < 1e-6
    assert got["b"]["target"] == 30 and got["é"]["target"] == 0 and got[None]["target"] == 300
    assert abs(got["c"]["target"] / got["a"]["target"] - 3) < 1e-9


def test_jaccard_edges(spark, docs, nothing):
    got = ngram_join.jaccard_join(docs).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert {by[i][0]["class_id"] for i in (0, 1, 2, 9)} == {0}
    # five copies besides itself and the text with one word more
    assert by[0][0]["n_links"] == by[0][1]["n_links"] == 5 and len(by[0]) == 2
    for i in (3, 4, 5):
        assert by[i][0]["class_id"] == i and by[i][0]["n_links"] == 0 and by[i][0]["kept"]
    assert sorted(str(r["class_id"]) for r in by[None]) == ["0", "None"]
    assert ngram_join.jaccard_join(nothing).count() == 0
    kept = ngram_join.keep_one(docs).collect()
    assert sum(r["text"] is not None and r["text"].lower().startswith("alpha0") for r in kept) == 1
    assert sum(not (r["text"] or "").strip() for r in kept) == 4


def test_decontaminate_edges(docs, nothing, bench):
    got = {(r["doc_id"], r["text"]): r for r in decontaminate.find_benchmark(docs, bench, ["doc_id", "text"]).collect()}
    first = got[(0, PROSE)]
    assert first["hit_items"] == ["1"] and decontaminate and first["hit_spans"][0]["start"] == 5 and first["hit_spans"][0]["stop"] == 40
    assert first["hit_matches"][0]["length"] == 35
    assert got[(6, "one")]["hit_items"] == ["2"]
    odd = next(r for (i, _), r in got.items() if i == 7)
    assert odd["hit_items"] == [] and [tuple(s) for s in odd["hit_spans"]] == [(4, 6)]
    assert got[(3, None)]["hit_words"] == 0 and got[(4, "")]["hit_spans"] == []
    assert decontaminate.find_benchmark(nothing, bench, ["doc_id"]).count() == 0
    clean = decontaminate.find_benchmark(docs, bench.limit(0), ["doc_id"]).collect()
    assert all(r["hit_spans"] == [] for r in clean) and len(clean) == docs.count()


def test_decontaminate_blocks_agree(docs, bench):
    keep = ["doc_id", "n_chars", "text"]
    one = {tuple(r[c] for c in keep): r for r in decontaminate.find_benchmark(docs, bench, keep).collect()}
    many = {tuple(r[c] for c in keep): r for r in decontaminate.find_benchmark(docs, bench, keep, block_words=2).collect()}
    assert one.keys() == many.keys()
    for k, r in one.items():
        assert r["hit_items"] == many[k]["hit_items"] and r["hit_spans"] == many[k]["hit_spans"] and r["hit_words"] == many[k]["hit_words"]


def test_decontaminate_blocks_keep_rows(docs, bench):
    # equal rows, and rows that the kept columns do not tell apart, are judged one by one with any number of blocks
    seen = lambda n: sorted([(r["doc_id"], r["hit_words"], r["hit_spans"], r["hit_items"], sorted(map(str, r["hit_matches"]))) for r in
                             decontaminate.find_benchmark(docs.withColumn("doc_id", F.lit(1)), bench, ["doc_id"], block_words=n).collect()], key=repr)
    left = lambda n: sorted(map(repr, decontaminate.remove_contaminated(docs, bench, block_words=n).collect()))
    assert len(seen(2)) == len(rows()) and seen(2) == seen(2_000_000)
    assert left(2) == left(2_000_000)


def test_secret_edges(docs, nothing):
    got = {(r["doc_id"], r["text"]): r for r in secrets.scan(docs, ["doc_id", "text"], redact="[X]").collect()}
    hit = got[(10, rows()[10][1])]
    assert [tuple(s) for s in hit["secret_spans"]][:2] == [(0, 0, 49), (9, 2, 49)]
    assert hit["secret_clean"] == '[X]" end'
    assert got[(3, None)]["secret_spans"] == [] and got[(3, None)]["secret_clean"] is None
    assert secrets.scan(nothing, ["doc_id"]).count() == 0


@pytest.mark.parametrize("head", ["A", "AK", "AKI"])
def test_access_key_across_texts(head):
    # a marker across the border belongs to neither text; what follows it in the run is still found
    key = "AKIA" + "Q7" * 8
    texts = [f"ends in {head}", f"{'AKIA'[len(head):]}56789012345678901234", "AKIA12", f"XY{key}", "", f"{key}A"]
    buf, off = secrets.text_bytes(pa.array(texts))
    code = "import sys, numpy as np; from commentguard.llm import secrets; import pyarrow as pa; " \
           "buf, off = secrets.text_bytes(pa.array(eval(sys.argv[1]))); " \
           "print(secrets.find_spans(buf, off, np.zeros((len(secrets.ALPHABETS), len(secrets.LENGTHS)), int)))"
    out = subprocess.run([sys.executable, "-c", code, repr(texts)], capture_output=True, text=True, timeout=60, check=True,
                         cwd=os.path.dirname(os.path.dirname(secrets.__file__)) + "/..").stdout
    got = [[(a - z, b - z) for a, kind, b in spans if kind == 1] for spans, z in zip(eval(out), off.tolist())]
    assert got == [[], [], [], [(2, 22)], [], [(0, 21)]]


def test_language_edges(spark, docs, nothing):
    got = {r["doc_id"]: r for r in language.identify_documents(docs, ["doc_id"]).collect() if r["doc_id"] is not None}
    assert not got[3]["lang_ok"] and not got[4]["lang_ok"] and not got[5]["lang_ok"] and got[0]["lang_id"] == "en"
    assert language.identify_documents(nothing, ["doc_id"]).count() == 0
    silent = language.identify_documents(docs.withColumn("lang", F.lit(None).cast("string")), ["doc_id"]).collect()
    assert not any(r["lang_ok"] for r in silent) and len(silent) == docs.count()


def test_toxicity_edges(spark, docs, nothing):
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, None), (6, 0), (7, 0), (9, 1), (None, 1), (99, 1)], "doc_id long, toxic int")
    fitted = toxicity.fit(docs, toxicity.training_labels(labels))
    got = toxicity.score_texts(docs, ["doc_id"], fitted).collect()
    assert len(got) == docs.count() and all(0 <= r["tox_score"] <= 1 for r in got)
    none = toxicity.fit(docs, toxicity.training_labels(labels.limit(0)))
    assert {r["tox_score"] for r in toxicity.score_texts(docs, ["doc_id"], none).collect()} == {0.0}
    assert toxicity.score_texts(nothing, ["doc_id"], fitted).count() == 0


def test_lm_edges(spark, docs, nothing):
    scored, _, v = hmm.score_texts(docs, crc_mod("doc_id", 7) == 2)
    got = scored.collect()
    assert len(got) == docs.count()
    by = {r["doc_id"]: r for r in got}
    assert by[3]["n_tokens"] == by[4]["n_tokens"] == by[5]["n_tokens"] == 1 and by[3]["score"] == by[4]["score"] < 0
    assert by[8]["n_tokens"] == 60_001
    assert hmm.score_texts(nothing, F.lit(False))[0].count() == 0
    untaught = hmm.score_texts(docs, F.lit(True))[0].collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == 0 and r["score"] < 0 for r in untaught)


def test_passage_edges(docs, nothing):
    got = {}
    for r in passages.repeated_passages(docs).collect():
        got.setdefault(r["doc_id"], r)
    assert got[0]["n_passages"] == 1 and got[0]["repeated_words"] == 180 and got[0]["partners"]
    assert got[2]["n_passages"] == 1 and got[2]["repeated_words"] == 180 and got[2]["passages"][0]["stop"] == len(PROSE)
    assert all(got[i]["n_passages"] == 0 for i in (3, 4, 5, 6, 7, 8, 10))
    assert passages.repeated_passages(docs).count() == docs.count()
    assert passages.repeated_passages(nothing).count() == 0


def test_embedding_edges(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0], 1), (1, [2.0, 0.0], 1), (2, [1.0, 0.0], 2), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1),
            (7, [inf, 0.0], 1), (8, [None, 1.0], 1), (9, [], 1), (10, [1.0, 0.0, 0.0], 1), (11, [1.0, 0.0], 1), (11, [1.0, 0.0], 1), (12, [0.0, 1.0], 1)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")
    got = embedding_dedup.near_duplicates(df).collect()
    links = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got}
    assert len(got) == len(data)
    assert links[0] == links[1] == (3, 0) and links[11] == (3, 0)
    assert all(links[i] == (0, i) for i in (2, 3, 4, 5, 6, 7, 8, 9, 10, 12))
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0
    # components of any size, a very long vector, ties, and extra columns with clashing names
    far = [(0, [1e200, 1e200], 1), (1, [1e-200, 1e-200], 1), (2, [1e200, -1e200], 1), (3, [1e-310, 1.1e-310], 1),
           (4, [1.0] * 50_000, 1), (5, [1.0] * 49_999 + [1.5], 1), (6, [1e308] * 50_000, 2)]
    df = spark.createDataFrame([(*r, "x", 7, b"y") for r in far], "vec_id long, embedding array<double>, label int, node string, cell int, vec binary")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(df).collect()}
    assert got == {0: (2, 0), 1: (2, 0), 2: (0, 2), 3: (2, 0), 4: (1, 4), 5: (1, 4), 6: (0, 6)}


def test_warc_edges(spark, tmp_path):
    inner = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    body = "x" * 120
    pages = [(1, "http://a/", body), (2, "http://a/\r\nX: y", body), (3, None, None), (4, "http://b/ü", "é" * 60 + inner + "tail" * 30), (5, "u", "short"), (6, "u", "short"),
             (7, "u", inner * 3), (None, "u", body), (8, "u", "WARC/1.1\r\n" * 40), (2, "again", body)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(2)
    warc.write_archive(df, f"{tmp_path}/a")
    for size in ("128m", "97b"):  # files cut into many splits
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            got = [(r["id"], r["kind"], r["block"]) for r in warc.read_archive(spark, f"{tmp_path}/a").select(
                warc.header("WARC-Record-ID").alias("id"), warc.header("WARC-Type").alias("kind"), F.col("block").cast("string")).collect()]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert len(got) == len(pages)
        texts = {i: b for i, k, b in got if k == "response"}
        assert texts["<urn:page:4>"] == pages[3][2] and texts["<urn:page:7>"] == pages[6][2] and texts["<urn:page:8>"] == pages[8][2]
        assert texts["<urn:page:3>"] == "" and texts["<urn:page:1>"] == body and texts["<urn:page:5>"] == texts["<urn:page:6>"] == "short"
        assert sorted(i for i, k, _ in got if k == "revisit") == ["<urn:page:2>", "<urn:page:2>", "<urn:page:>"]
    empty = df.limit(0)
    warc.write_archive(empty, f"{tmp_path}/b")
    assert warc.read_archive(spark, f"{tmp_path}/b").count() == 0


def test_toxicity_curve_sees_every_fold(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"w{i % 5} word{i % 7} {'vile' if i % 3 == 0 else 'kind'} x{i}") for i in range(300)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    seen, plain = [], toxicity._fit_curve
    monkeypatch.setattr(toxicity, "_fit_curve", lambda x, y: seen.append(len(y)) or plain(x, y))
    model, _, share = toxicity.fit(docs, labels)
    assert toxicity.SAMPLE_WORDS == 4_000_000 and abs(share - 1 / 3) < 1e-9 and len(model.keys)
    # all toxic texts (the smaller class) and about as many others, not a fifth of them
    assert 150 <= seen[0] <= 250


def test_rare_languages_have_models_of_their_own(spark):
    """Eight French texts among 4,000: a share of 0.2 %, once too few for a model; and five of another language."""
    import random
    rnd = random.Random(2)
    words = {"en": "the and of that with which this from have were their would there been when".split(),
             "de": "und der die das nicht sich auch werden einer wurde über schon mehr können".split(),
             "fr": "les des une qui dans pour est plus avec être même aussi cette après où déjà".split(),
             "pl": "się nie jest przez który może także już tylko przed jego ją więc żeby być".split()}
    n = {"en": 3000, "de": 1000, "fr": 8, "pl": 5}
    data = [(lang, " ".join(rnd.choice(words[lang]) for _ in range(90))) for lang, k in n.items() for _ in range(k)]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t)) for i, (lang, t) in enumerate(data)], DOCS)
    got = language.identify_documents(docs, ["doc_id", "lang"]).collect()
    assert all(r["lang_ok"] and r["lang_id"] == r["lang"] for r in got) and len(got) == len(data)
    counted = {}
    for dense in (0, 64):
        batch = pa.RecordBatch.from_pydict({"lang": [x for x, _ in data[:2990:7] + data[-13:]], "text": [t for _, t in data[:2990:7] + data[-13:]]})
        for b in language._count(sorted(n), dense)([batch]):
            for c, k in zip(*b.to_pydict().values()):
                counted.setdefault(dense, {}).setdefault(c, 0)
                counted[dense][c] += k
    assert counted[0] == counted[64]
