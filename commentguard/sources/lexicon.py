"""Lexicon and vocabulary sources.

Lexicons are ordinary DataFrames. They are small by nature and are joined
with a size-checked broadcast by the operators that use them.
"""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import vocab as V

log = logging.getLogger(__name__)

ABBREV_SCHEMA = T.StructType([T.StructField("abbr", T.StringType()), T.StructField("full", T.StringType())])
WORD_SCHEMA = T.StructType([T.StructField("word", T.StringType())])
PHRASE_SCHEMA = T.StructType([T.StructField("phrase", T.StringType())])
TAG_SCHEMA = T.StructType([
    T.StructField("tag_idx", T.IntegerType()),
    T.StructField("raw", T.StringType()),
    T.StructField("accented", T.StringType()),
])


def local_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A small in-memory table as a literal JVM plan (no Python worker involved).

    Meant for lexicons and vocabularies given inline; large lexicons are read
    from files with the loaders below.
    """
    if not rows:
        return spark.createDataFrame([], schema)
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, schema.fields)])
        for r in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def abbreviations(spark: SparkSession, pairs: list[tuple[str, str]]) -> DataFrame:
    """M10 from in-memory pairs; later duplicates of a key win."""
    last = {str(a): str(b) for a, b in pairs}
    return local_table(spark, list(last.items()), ABBREV_SCHEMA)


def keep_last(df: DataFrame, key: str, order: str) -> DataFrame:
    """Keep, per key, the row with the highest order value; drop the order column."""
    best = df.groupBy(key).agg(F.max_by(F.struct(*[c for c in df.columns if c != order]), F.col(order)).alias("r"))
    return best.select("r.*")


def line_order() -> Column:
    """Place of a line among those of all files read: by path, split and, within a split (one task), line."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("line"))


def load_lexicon(spark: SparkSession, path: str | None = None, header: bool = True) -> DataFrame:
    """Abbreviation lexicon from a two-column CSV; a missing file -> empty, with a warning.

    Both columns are read as strings (the reference casts them); when a key
    repeats, the later line wins (files by path, lines by place).
    """
    if not path:
        return spark.createDataFrame([], ABBREV_SCHEMA)
    try:
        raw = spark.read.option("header", header).csv(path)
        raw = raw.select(
            raw.columns[0] if len(raw.columns) > 0 else F.lit(None),
            raw.columns[1] if len(raw.columns) > 1 else F.lit(None),
            line_order(),
        ).toDF("abbr", "full", "ord")
        raw = raw.select(
            F.coalesce(F.col("abbr"), F.lit("nan")).alias("abbr"),
            F.coalesce(F.col("full"), F.lit("nan")).alias("full"),
            "ord",
        )
        out = keep_last(raw, "abbr", "ord")
        out.schema  # force analysis so a missing path surfaces here
        return out
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no lexicon at %s: the cleaner runs without", path)
        return spark.createDataFrame([], ABBREV_SCHEMA)


def stopwords(spark: SparkSession, words: list[str] | None = None) -> DataFrame:
    """Stopword set as DataFrame(word); defaults to the built-in 74 words."""
    ws = V.DEFAULT_STOPWORDS if words is None else words
    return local_table(spark, [(w,) for w in dict.fromkeys(ws)], WORD_SCHEMA)


def compounds(spark: SparkSession, phrases: list[str]) -> DataFrame:
    """Compound lexicon as DataFrame(phrase); '_' and spaces both separate syllables."""
    return local_table(spark, [(p,) for p in dict.fromkeys(phrases)], PHRASE_SCHEMA)


def read_lines(spark: SparkSession, path: str, column: str = "word") -> DataFrame:
    """One entry per line, stripped, blanks dropped. A missing file raises."""
    df = spark.read.text(path)
    df.schema  # raises AnalysisException if the path does not exist
    line = F.regexp_replace(F.col("value"), V.EDGE_WHITESPACE, "")
    return df.select(line.alias(column)).filter(F.col(column) != "")


def compounds_from_file(spark: SparkSession, path: str) -> DataFrame:
    """M12-style line file (syllables joined by '_'), as a compound lexicon."""
    return read_lines(spark, path, "phrase").distinct()


def with_line_index(df: DataFrame, col: str = "line_idx", files: bool = False) -> DataFrame:
    """Consecutive 0-based index in read order, or with ``files`` (a file scan) by path and place in the file,
    computed without a single-task window.

    Rows of a partition, or of a split, are numbered in their task; counts of them (one row each) give their offsets.
    """
    mid = F.monotonically_increasing_id()
    df = df.select("*", (line_order() if files else F.struct(
        F.lit("").alias("file"), F.shiftright(mid, 33).alias("block"), mid.alias("line"))).alias("__at"))
    split = [F.col("__at.file").alias("__file"), F.col("__at.block").alias("__block")]
    counts = df.groupBy(*split).agg(F.count(F.lit(1)).alias("__n"), F.min("__at.line").alias("__first"))
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(
        Window.orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")  # one row per split
    df = df.join(offsets, (F.col("__at.file") == F.col("__file")) & (F.col("__at.block") == F.col("__block")))
    return df.withColumn(col, F.col("__off") + F.col("__at.line") - F.col("__first")).drop("__at", "__file", "__block", "__off", "__first")


def tag_table(spark: SparkSession, path: str) -> DataFrame:
    """M13: 'raw-accented' lines -> (tag_idx, raw, accented); tag_idx is the line number from 0."""
    df = with_line_index(spark.read.text(path), "tag_idx", files=True)
    return tag_table_from(df.select("tag_idx", F.col("value").alias("name")))


def tag_table_from(df: DataFrame) -> DataFrame:
    """(tag_idx, name) -> (tag_idx, raw, accented); names without exactly one '-' never apply."""
    parts = F.split(F.col("name"), "-")
    ok = F.size(parts) == 2
    return df.select(
        F.col("tag_idx").cast("int").alias("tag_idx"),
        F.when(ok, parts.getItem(0)).alias("raw"),
        F.when(ok, parts.getItem(1)).alias("accented"),
    )


def label_vocab(spark: SparkSession, labels: list[str] | None = None) -> DataFrame:
    """M8: ordered label vocabulary as (idx, name)."""
    names = V.TYPE_ATTACK_LABELS if labels is None else labels
    schema = T.StructType([T.StructField("idx", T.IntegerType()), T.StructField("name", T.StringType())])
    return local_table(spark, list(enumerate(names)), schema)


def write_label_vocab(spark: SparkSession, path: str, labels: list[str] | None = None) -> None:
    """Write the ordered vocabulary as JSON lines {idx, name} in one file."""
    names = V.TYPE_ATTACK_LABELS if labels is None else labels
    arr = F.array(*[F.lit(n) for n in names])
    df = spark.range(1).select(F.posexplode(arr).alias("idx", "name"))
    df.coalesce(1).write.mode("overwrite").json(path)
