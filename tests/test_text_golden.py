"""Golden rows for the text operators, worked by hand (cases the tables lack)."""

import pytest
from pyspark.sql import functions as F

from commentguard.functions import text as TX
from commentguard.operators.cleaning import clean_comments
from commentguard.sources import lexicon as LX

NL = "\n"


def one(spark, expr, value):
    df = spark.createDataFrame([(value,)], "t string")
    return df.select(expr(F.col("t")).alias("o")).first()["o"]


@pytest.mark.parametrize("raw, want", [
    ("Tên" + NL + "Đồ ngu! xem https://a.b/c?d nhé @bạn a@b.com 😀 đi", "đồ ngu xem nhé đi"),
    ("no newline here", "no newline here"),
    (NL, ""),
    ("x" + NL + "a" + NL + "b", "a. b"),
    ("x" + NL + "a." + NL + "b", "a . b"),
    ("x​y ①½ 五", "x y ①½ 五"),
    ("a\rb" + NL + "c", "c"),
    ("   ", ""),
    ("", ""),
    (None, ""),
    ("x" + NL + "été", "e té"),          # decomposed accent: the mark becomes a space
    ("x" + NL + "a  b", "a b"),                # NBSP collapses like a space
])
def test_online_text(spark, raw, want):
    assert one(spark, lambda c: TX.online_text(c), raw) == want


def test_strip_author_only_first_line(spark):
    assert one(spark, TX.strip_author, "a" + NL + "b" + NL + "c") == "b" + NL + "c"
    assert one(spark, TX.strip_author, "abc") == "abc"


def test_url_normalise(spark):
    assert one(spark, TX.normalise_url, "https://m.facebook.com/x") == "https://www.facebook.com/x"
    assert one(spark, TX.normalise_url, "https://mbasic.facebook.com/x") == "https://www.facebook.com/x"


def test_truncate(spark):
    assert one(spark, lambda c: TX.truncate_tokens(c, 2), " a  b c ") == "a b"


def _clean(spark, rows, **kw):
    df = spark.createDataFrame(rows, "id long, cmt string")
    return {r["id"]: r["cmt_processed"] for r in clean_comments(df, **kw).collect()}


def test_cleaner_rules(spark):
    ab = LX.abbreviations(spark, [("ko", "khong"), ("vs", "với"), ("ko", "không")])  # later duplicate wins
    co = LX.compounds(spark, ["có thể", "không có thể", "đến_nỗi"])
    sw = LX.stopwords(spark)  # the default 74 words
    out = _clean(spark, [
        (1, "An" + NL + "tôi ko có thể đi"),       # expansion, then the longest compound wins
        (2, "An" + NL + "có thể vs bạn"),          # compound that is a stopword is dropped; vs -> với (stopword)
        (3, "An" + NL + "đến nỗi"),                # compound given with '_' in the lexicon; it is a stopword
        (4, "An" + NL + "và"),                     # only stopwords -> blank -> dropped (C1)
        (5, "An" + NL + "x" + NL + "có thể"),      # newline -> ". ", the dot is its own token; có_thể is a stopword
    ], abbreviations=ab, compounds=co, stopwords=sw)
    assert out == {1: "tôi không_có_thể đi", 2: "bạn", 5: "x ."}


def test_cleaner_keep_blank_and_duplicate_words(spark):
    sw = LX.stopwords(spark, ["a"])
    df = spark.createDataFrame([(1, "h" + NL + "b a b"), (2, None)], "id long, cmt string")
    got = {r["id"]: r["cmt_processed"] for r in clean_comments(df, stopwords=sw, drop_blank=False).collect()}
    assert got == {1: "b b", 2: ""}


def test_offline_mode_keeps_punctuation(spark):
    df = spark.createDataFrame([(1, "Hello, World.  and")], "id long, cmt string")
    ab = LX.abbreviations(spark, [("and", "as well as")])
    got = clean_comments(df, abbreviations=ab, mode="offline").first()["cmt_processed"]
    assert got == "hello, world . as well as"


def test_greedy_overlap(spark):
    co = LX.compounds(spark, ["de de"])
    got = _clean(spark, [(1, "h" + NL + "de de de")], compounds=co)
    assert got == {1: "de_de de"}


def test_missing_lexicon_is_empty(spark):
    assert LX.load_lexicon(spark, "/nonexistent/teencode.csv").count() == 0
    assert LX.load_lexicon(spark, None).count() == 0


def test_many_copies_of_one_comment(spark):
    from pyspark.sql import functions as F
    hot = spark.range(3000).select(F.lit(7).cast("long").alias("id"),
                                   F.lit("h" + NL + "Hello  the World").alias("cmt")).repartition(6)
    other = spark.createDataFrame([(8, "h" + NL + "x")], "id long, cmt string")
    sw = LX.stopwords(spark, ["the"])
    out = clean_comments(hot.unionByName(other), stopwords=sw)
    got = out.groupBy("id", "cmt_processed").count().collect()
    assert sorted((r["id"], r["cmt_processed"], r["count"]) for r in got) == [(7, "hello world", 3000), (8, "x", 1)]
