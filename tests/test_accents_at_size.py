"""B25 with tables above the broadcast limit: same rows, and no row of a word or pair carries its text."""

import re

from commentguard.operators import accents as AC, tags as TG


def texts(spark):
    rows = [(i, f"la mere{i % 7} a parle{i % 11} w{i} w{i + 1} " * (1 + i % 3)) for i in range(200)]
    rows += [(1000 + i, f"mère{i % 7} parlé{i % 11} ẃ{i}") for i in range(0, 200, 2)] + [(5, None), (None, ""), (7, "  w3  mere1 "), (7, "  w3  mere1 ")]
    return spark.createDataFrame(rows, "id long, text string")


def carried(df):
    """Columns that rows keep beside what is exploded from a text."""
    return re.findall(r"Generate (?:pos)?explode\(.*?\), \[([^\]]*)\]", df._jdf.queryExecution().executedPlan().toString())


def test_restore_accents_by_join(spark):
    docs = texts(spark)
    want = sorted(TG.restore_accents(docs).collect(), key=str)
    for limit in (2_000, 0):  # with some words sent, with none
        out = TG.restore_accents(docs, max_bytes=limit)
        assert sorted(out.collect(), key=str) == want
        assert carried(out) and not any("__t" in columns for columns in carried(out))
    assert any(r["restored"].startswith("la mère1 a parlé1") for r in want if r["restored"])


def test_frequent_words_stay_within_the_limit(spark):
    counts = spark.createDataFrame([(f"w{i}", i) for i in range(1, 101)], "word string, n long")
    for most in (0, 1, 37, 69, 100, 1000):
        got = {r["n"] for r in TG.frequent(counts, most).collect()}
        assert len(got) <= most and got == set(range(min(got, default=101), 101))
    assert TG.frequent(counts, 37).count() == 37 and TG.frequent(counts, 100).count() == 100


def test_restore_in_context_asks_without_texts(spark):
    docs = texts(spark)
    want = sorted(AC.restore_in_context(docs).collect(), key=str)
    model = AC.fit_accents(docs, max_bytes=2_000)
    for known in (model, AC.AccentModel(model.forms, model.pairs)):  # frequent words known, and not
        out = AC.restore_in_context(docs, model=known, max_bytes=2_000)
        assert sorted(out.collect(), key=str) == want
        plan = out._jdf.queryExecution().executedPlan().toString()
        # before, each pair of a text met the forms by a row with the text's key, place and words
        assert not any("pos" in columns or "__key" in columns for columns in carried(out)) and "__k#" not in plan
    flat = AC.pair_counts(docs, model.forms, counts=model.counts, max_bytes=2_000).select("fa", "fb", "a", "b", "n")
    assert sorted(flat.collect()) == sorted(AC.pair_counts(docs, model.forms, max_bytes=0).select("fa", "fb", "a", "b", "n").collect())
