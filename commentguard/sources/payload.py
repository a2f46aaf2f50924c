"""Wire payloads (A2, A3): JSON messages to and from typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGE_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("cmt", T.StringType()),
    T.StructField("timestamp", T.DoubleType()),
])


def parse_payload(df: DataFrame, schema: T.StructType = MESSAGE_SCHEMA, value_col: str = "value",
                  keep: list[str] | None = None, with_corrupt: bool = False) -> DataFrame:
    """A2: bytes/string JSON -> struct -> flattened columns.

    Malformed JSON yields an all-null row (it is filtered later by C1). With
    ``with_corrupt`` the raw value of such rows is kept in ``_corrupt``.
    """
    raw = F.col(value_col).cast("string")
    parsed = F.from_json(raw, schema, {"mode": "PERMISSIVE"})
    out = df.select(*(keep or []), parsed.alias("__d"), raw.alias("__raw"))
    cols = [F.col(f"__d.{f.name}").alias(f.name) for f in schema.fields]
    if with_corrupt:
        all_null = F.lit(True)
        for f in schema.fields:
            all_null = all_null & F.col(f"__d.{f.name}").isNull()
        cols.append(F.when(F.col("__raw").isNotNull() & all_null, F.col("__raw")).alias("_corrupt"))
    return out.select(*(keep or []), *cols)


def with_event_time(df: DataFrame, epoch_col: str = "timestamp", out_col: str = "event_time") -> DataFrame:
    """Producer epoch seconds -> TIMESTAMP (the reference drops it; we keep it)."""
    return df.withColumn(out_col, F.timestamp_micros((F.col(epoch_col) * 1_000_000).cast("long")))


def to_payload(cols: list[str | Column]) -> Column:
    """A3: message struct -> JSON string (encode as UTF-8 bytes at the sink)."""
    return F.to_json(F.struct(*cols))
