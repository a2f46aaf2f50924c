"""Bindings of the provided test tables to the logical fixtures the operators expect.

Each function reads the parquet tables under ``sf_dir`` and derives a fixture
with Spark, so every registered query grows with its input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import vocab as V
from ..sources import lexicon as LX


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_comments(id, cmt) = documents(doc_id, text)."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("cmt"))


# Inline fixture lexicons: frequent tokens of the test corpus, so every rule fires.
FIXTURE_ABBREVIATIONS = [("and", "as well as"), ("des", "de les"), ("und", "sowie"), ("was", "were")]
FIXTURE_STOPWORDS = ["the", "to", "a", "la", "der", "is", "le", "be", "of_the"]
FIXTURE_COMPOUNDS = ["of the", "the and the", "de de"]


_LEXICONS: dict[int, tuple] = {}


def fixture_lexicons(spark: SparkSession):
    """(abbreviations, compounds, stopwords), built once per session like an application
    loads its lexicons once, so their size checks and derived lookup table are reused."""
    hit = _LEXICONS.get(id(spark))
    if hit is None or hit[0] is not spark:
        hit = (spark, LX.abbreviations(spark, FIXTURE_ABBREVIATIONS), LX.compounds(spark, FIXTURE_COMPOUNDS),
               LX.stopwords(spark, FIXTURE_STOPWORDS))
        _LEXICONS[id(spark)] = hit
    return hit[1:]


def _scaled(start: int, n: int, scale: float, shift: float = 0.0):
    arr = F.slice(F.col("embedding"), start, n)
    if shift:
        return F.transform(arr, lambda x: x.cast("double") * scale - shift)
    return F.transform(arr, lambda x: x.cast("double") * scale)


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_logits: severity heads, 19 type logits and 19 truth bits sliced from embeddings.

    Severity truth per head for single-label metrics: (label + h) % 4 for heads h = 0, 1, 2.
    """
    e = table(spark, sf_dir, "embeddings")
    truth = F.transform(F.slice(F.col("embedding"), 33, 19), lambda x: F.when(x.cast("double") > 0.1, 1).otherwise(0))
    return e.select(
        F.col("vec_id").alias("id"),
        _scaled(1, 4, 10).alias("ind"), _scaled(5, 4, 10).alias("grp"), _scaled(9, 4, 10).alias("soc"),
        _scaled(13, 19, 10, 2.5).alias("typ"),
        truth.alias("truth"),
        (F.col("label") % 4).alias("y_ind"), ((F.col("label") + 1) % 4).alias("y_grp"),
        ((F.col("label") + 2) % 4).alias("y_soc"),
    )


def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_flags(id, timestamp, is_hate): error events are the toxic ones."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("timestamp"),
                     (F.col("event_type") == "error").alias("is_hate"))


def by_document(spark: SparkSession, sf_dir: str, rows: DataFrame, table_name: str, key: str = "id") -> DataFrame:
    """One of ``rows`` for every document: that with number doc_id modulo the rows of their table (numbered from 0)."""
    n = table(spark, sf_dir, table_name).count()
    ids = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("__doc"), (F.col("doc_id") % n).alias(key))
    return ids.join(rows, key).drop(key).withColumnRenamed("__doc", key)


def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_times(id, timestamp): an event time for every document."""
    ev = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("timestamp"))
    return by_document(spark, sf_dir, ev, "events")


def document_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_doc_logits: fx_logits for every document."""
    return by_document(spark, sf_dir, logits(spark, sf_dir), "embeddings")


def monitor_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_monitor: the J2 record of every document, with its text and event time."""
    from ..functions.text import online_text
    from ..operators.scoring import cascade

    log = cascade(document_logits(spark, sf_dir), keep=["id"]).drop("targets", "type_bits")
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("cmt"), online_text("text").alias("cmt_processed"))
    return log.join(docs, "id").join(event_times(spark, sf_dir), "id").select(
        "id", "cmt", "cmt_processed", "Individual", "Group", "Societal", "type_attack", "is_hate", "timestamp")


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_tags(id, attack_type): names of set truth bits joined by ", ", plus an unknown name every 7th id."""
    from ..functions.scores import from_one_hot

    lg = logits(spark, sf_dir)
    names = from_one_hot("truth")
    names = F.when(F.col("id") % 7 == 0, F.concat(names, F.array(F.lit("Unknown Label")))).otherwise(names)
    return lg.select("id", F.array_join(names, ", ").alias("attack_type"))


def threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_threads(url, pos, cmt) from conversations."""
    c = table(spark, sf_dir, "conversations")
    return c.select(F.concat(F.lit("conv/"), F.col("conv_id").cast("string")).alias("url"),
                    F.col("turn").alias("pos"), F.col("text").alias("cmt"))


SUBWORD_TASK_BYTES = 4 << 20  # of text

# Inline 4-row tag table for the sub-word fixture (tag_idx = pos % 4).
FIXTURE_TAGS = [(0, "-"), (1, "e-é"), (2, "a-à"), (3, "ou-où")]


def subwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_subwords(id, pos, token, tag_idx): whitespace tokens of documents cut into
    3-character pieces, the first piece of each token prefixed with the word marker."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # texts are dealt by id, and cut into pieces where they are then read; so many to a task that its pieces are sorted in memory
    whole = d.repartition(-(-size // SUBWORD_TASK_BYTES) or 1, "id").groupBy("id").agg(F.collect_list("text").alias("texts"))
    cut = lambda tok, tpos: F.transform(F.regexp_extract_all(tok, F.lit("(?s).{1,3}"), F.lit(0)),
                                        lambda piece, k: F.struct(tpos.alias("tpos"), k.alias("k"), piece.alias("piece")))
    pieces = F.flatten(F.transform("texts", lambda t: F.flatten(F.transform(F.split(t, V.WHITESPACE_RUN), cut))))
    pieces = F.when(F.size("texts") == 1, pieces).otherwise(F.sort_array(pieces))  # those of one text are in order
    out = whole.select("id", F.posexplode(pieces).alias("pos", "p")).select("id", "pos",
                       F.when(F.col("p.k") == 0, F.concat(F.lit("▁"), F.col("p.piece"))).otherwise(F.col("p.piece")).alias("token"))
    return out.withColumn("tag_idx", (F.col("pos") % 4).cast("int"))


def fixture_tag_table(spark: SparkSession) -> DataFrame:
    from ..sources.lexicon import local_table, tag_table_from
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("tag_idx", T.IntegerType()), T.StructField("name", T.StringType())])
    return tag_table_from(local_table(spark, FIXTURE_TAGS, schema))
