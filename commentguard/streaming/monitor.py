"""Incremental monitoring state.

State is bounded by watermarks: deduplication keeps ids only within the
watermark delay, and windowed counts are finalised and dropped once the
watermark passes the window end (append mode).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from .. import vocab as V


def dedup_ids(stream: DataFrame, id_col: str = "id", ts: str = "event_time", delay: str = "1 hour") -> DataFrame:
    """First arrival per id within the watermark delay."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([id_col])


def trend_stream(stream: DataFrame, ts: str = "event_time", flag: str = "is_hate", block: str = V.TREND_BLOCK,
                 delay: str = "0 seconds") -> DataFrame:
    """I4: tumbling toxic counts: in append mode once the watermark closes a block, in update mode live."""
    agg = stream.withWatermark(ts, delay).groupBy(F.window(ts, block).alias("w")).agg(
        F.sum(F.col(flag).cast("int")).alias("toxic_count"))
    return agg.select(F.col("w.start").alias("time_block"), "toxic_count")


def sliding_alert_stream(stream: DataFrame, ts: str = "event_time", flag: str = "is_hate",
                         window: str = "3 seconds", slide: str = "1 second", window_seconds: float = 3.0,
                         rate_unit_seconds: float = 1.0, threshold: float = V.ALERT_THRESHOLD,
                         delay: str = "0 seconds") -> DataFrame:
    """Sliding-window toxic rate, alert rows only."""
    agg = stream.withWatermark(ts, delay).groupBy(F.window(ts, window, slide).alias("w")).agg(
        F.sum(F.col(flag).cast("long")).alias("toxic"))
    rate = F.col("toxic") / F.lit(window_seconds / rate_unit_seconds)
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "toxic",
                      rate.alias("rate")).filter(F.col("rate") > threshold)


def keep_last_stream(stream: DataFrame, id_col: str = "id", ts: str = "event_time") -> DataFrame:
    """The row with the greatest time per id, for update mode and an upsert sink (state: one row per id)."""
    others = [c for c in stream.columns if c != id_col]
    last = stream.groupBy(id_col).agg(F.max_by(F.struct(*others), F.struct(ts, *[c for c in others if c != ts])).alias("__r"))
    return last.select(id_col, *[F.col(f"__r.{c}").alias(c) for c in others])


class LateRows(StreamingQueryListener):
    """Counts rows dropped as late over the whole life of the queries, however long they run."""

    def __init__(self):
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        late = sum(int(op.numRowsDroppedByWatermark) for op in event.progress.stateOperators)
        key = str(event.progress.id)
        self.dropped[key] = self.dropped.get(key, 0) + late

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def dropped_by_watermark(query) -> int:
    """Rows dropped as late, summed over the retained progress reports (the last 100 by default;
    ``LateRows`` counts all of a long stream)."""
    total = 0
    for prog in query.recentProgress or []:
        total += sum(int(op.get("numRowsDroppedByWatermark", 0)) for op in prog.get("stateOperators", []))
    return total
