"""Size-checked broadcast: broadcast a side only when its bytes are proven small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Lexicons and label vocabularies are far below this; a side above it is
# joined with a shuffle and left to AQE (skew splitting, coalescing).
BROADCAST_BYTES = 64 << 20
_ROW_OVERHEAD = 32  # of a row in a hash table, besides its values


def measured_bytes(df: DataFrame) -> int:
    """Size of df's rows: their JSON text plus an overhead each, summed map-side (no row leaves its task)."""
    text = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))).cast("long")
    return df.agg(F.coalesce(F.sum(text + _ROW_OVERHEAD), F.lit(0))).first()[0]


def fits(*sides: DataFrame | None, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the sides together are proven to be within max_bytes."""
    return sum(measured_bytes(s) for s in sides if s is not None) <= max_bytes


def maybe_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES, bound_by: list[DataFrame] | None = None) -> DataFrame:
    """Mark df for broadcast if it, or the inputs ``bound_by`` that it is derived from
    row by row, are proven to be within max_bytes."""
    return F.broadcast(df) if fits(*(bound_by or [df]), max_bytes=max_bytes) else df
