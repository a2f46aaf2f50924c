"""Table scans and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_labelled(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
                  columns: list[str] | None = None) -> DataFrame:
    """A4: labelled corpus with an explicit schema (spreadsheets are converted outside Spark)."""
    reader = spark.read.schema(schema)
    df = reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)
    return df.select(*columns) if columns else df


def profile(df: DataFrame, with_types: bool = False) -> DataFrame:
    """A4: non-null count per column plus the row count, in one scan; optionally the
    Spark type of each column (taken from the schema, no data read)."""
    wide = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(F.col(c)).alias(c) for c in df.columns])
    types = dict(df.dtypes)
    fields = lambda c: [F.lit(c).alias("column_name"), F.col(c).alias("non_null"), F.col("__n").alias("n_rows")] + (
        [F.lit(types[c]).alias("dtype")] if with_types else [])
    return wide.select(F.explode(F.array(*[F.struct(*fields(c)) for c in df.columns])).alias("r")).select("r.*")


def read_urls(spark: SparkSession, path: str) -> DataFrame:
    """A5: URL list CSV with a ``url`` header."""
    return spark.read.option("header", True).csv(path).select("url")


def append_csv(df: DataFrame, path: str) -> None:
    """Append rows as CSV part files, each with a header line (UTF-8, no BOM)."""
    df.write.mode("append").option("header", True).option("encoding", "UTF-8").csv(path)
