"""The cleaner keeps every row, whatever its input went through and however large its lexicons are."""

import pytest
from pyspark.sql import functions as F

from commentguard.operators.cleaning import clean_comments, prepare_lexicons
from commentguard.operators.tags import restore_accents
from commentguard.plans import fixtures as FX
from commentguard.streaming.ingest import for_scoring

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return FX.comments(spark, SF).withColumn("wide", F.concat("cmt", F.lit("!")))


@pytest.fixture(scope="module")
def expected(spark, docs):
    ab, co, sw = FX.fixture_lexicons(spark)
    return {r["id"]: r["cmt_processed"] for r in clean_comments(docs, ab, co, sw, drop_blank=False).collect()}


def inputs(spark, docs):
    events = FX.table(spark, SF, "events").select(F.col("event_id").alias("id"), "ts")
    return {
        "round robin": for_scoring(docs, 7),
        "by id": docs.repartition(5, "id"),
        "join": docs.join(events.hint("merge"), "id", "left"),
        "aggregate": docs.groupBy("id").agg(F.max("cmt").alias("cmt"), F.max("wide").alias("wide")),
        "sort": docs.orderBy("wide"),
    }


@pytest.mark.parametrize("kind", ["round robin", "by id", "join", "aggregate", "sort"])
@pytest.mark.parametrize("max_bytes", [64 << 20, 0])
def test_no_row_is_lost(spark, docs, expected, kind, max_bytes):
    ab, co, sw = FX.fixture_lexicons(spark)
    df = inputs(spark, docs)[kind]
    out = clean_comments(df, ab, co, sw, drop_blank=False, max_bytes=max_bytes)
    assert out.columns == [*df.columns, "cmt_processed"]
    got = out.select("id", "cmt_processed").collect()
    assert len(got) == len(expected) and {r[0]: r[1] for r in got} == expected


@pytest.mark.parametrize("max_bytes", [64 << 20, 0])
def test_null_and_repeated_ids(spark, max_bytes):
    ab, co, sw = FX.fixture_lexicons(spark)
    rows = [(None, "x\nand of the end."), (1, "a\nthe cat"), (1, "a\nthe cat"), (1, "b\nthe dog was"), (2, None), (3, "")]
    df = spark.createDataFrame(rows, "id long, cmt string")
    got = clean_comments(df, ab, co, sw, drop_blank=False, max_bytes=max_bytes).collect()
    assert sorted((str(r["id"]), r["cmt_processed"]) for r in got) == [
        ("1", "cat"), ("1", "cat"), ("1", "dog were"), ("2", ""), ("3", ""), ("None", "as well as end")]
    restored = restore_accents(spark.createDataFrame([(None, "cafe Café café"), (4, ""), (4, None)], "id long, text string"), max_bytes=max_bytes)
    assert sorted((str(r["id"]), r["restored"]) for r in restored.collect()) == [("4", ""), ("4", ""), ("None", "café café café")]


def test_prepared_lexicons_are_size_checked(spark):
    ab, co, sw = FX.fixture_lexicons(spark)
    assert prepare_lexicons(ab, co, sw, max_bytes=100) is None
    assert prepare_lexicons(ab, co, sw).stop >= {"the", "of_the"}
