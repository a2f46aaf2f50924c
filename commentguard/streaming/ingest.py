"""Stream sources.

Kafka is the production source; its connector jar is not bundled, so tests
drive the same plans from a file source with ``maxFilesPerTrigger``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.payload import MESSAGE_SCHEMA, parse_payload, with_event_time


def kafka_source(spark: SparkSession, servers: str, topic: str, max_offsets: int = 1000,
                 starting: str = "latest", fail_on_data_loss: bool = False) -> DataFrame:
    """A1 + I1: Kafka topic as a stream, rate-limited to ``max_offsets`` per trigger."""
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting)
            .option("failOnDataLoss", str(fail_on_data_loss).lower())
            .option("maxOffsetsPerTrigger", max_offsets)
            .load())


def file_source(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int = 1) -> DataFrame:
    """A1 + I1 stand-in: a directory of files as a stream, ``max_files_per_trigger`` per micro-batch."""
    return (spark.readStream.format(fmt).schema(schema)
            .option("maxFilesPerTrigger", max_files_per_trigger).load(path))


def messages(raw: DataFrame, schema: T.StructType = MESSAGE_SCHEMA) -> DataFrame:
    """A2 on a stream: Kafka ``value`` bytes -> (id, cmt, timestamp, event_time)."""
    return with_event_time(parse_payload(raw, schema, value_col="value"))


def event_time(df: DataFrame, col: str = "timestamp", out: str = "event_time", delay: str = "0 seconds") -> DataFrame:
    """Event time as TIMESTAMP (watermarks reject TIMESTAMP_NTZ) plus a watermark."""
    return df.withColumn(out, F.col(col).cast("timestamp")).withWatermark(out, delay)


def for_scoring(df: DataFrame, partitions: int) -> DataFrame:
    """Spread rows over ``partitions`` tasks before per-row scoring work."""
    return df.repartition(partitions)
