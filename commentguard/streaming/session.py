"""Monitoring state that lives between micro-batches (I3, I5, E6): keep-last per id with a reset, and the live alert.

Both run on ``transformWithState`` and need the RocksDB state store, which ``rocksdb`` names while a query is started.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .. import vocab as V

SHARDS = 256
BUCKETS = 1024  # of a shard's ids
HELD_ROWS = 1 << 19  # of a shard's batch that meet the state at once
HELD_BYTES = 64 << 20
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_IDLE = "spark.sql.streaming.noDataMicroBatches.enabled"
_LONG = T.StructType([T.StructField("v", T.LongType())])


def _chunks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows in the order they come, as many at once as HELD_ROWS and HELD_BYTES allow."""
    held, rows, size = [], 0, 0
    for frame in frames:
        held.append(frame)
        rows, size = rows + len(frame), size + int(frame.memory_usage(index=False, deep=True).sum())
        if rows >= HELD_ROWS or size >= HELD_BYTES:
            yield pd.concat(held, ignore_index=True)
            held, rows, size = [], 0, 0
    if held:
        yield pd.concat(held, ignore_index=True)


@contextmanager
def rocksdb(spark: SparkSession, idle_batches: bool = True) -> Iterator[None]:
    """Queries that start meanwhile keep their state in RocksDB; the session's own choices come back afterwards.

    ``idle_batches=False`` starts them without batches that have no new rows: a query by processing time has such
    batches at every trigger and would never end under ``availableNow``.
    """
    wanted = {_STORE: _ROCKSDB} | ({} if idle_batches else {_IDLE: "false"})
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


class _KeepLast(StatefulProcessor):
    """State of a shard: the time of every id's newest row, with a time to live, and the time of the last reset.

    Ids are kept by buckets. Rows come in frames of some thousand, each with ids of most buckets, so many frames are put
    together first: a batch reads and writes a bucket once for all of its ids, not once for each frame. ``at``
    is when an id was last written: older ones are forgotten, also where others of their bucket are not.
    """

    def __init__(self, id_type: T.DataType, ttl_ms: int, columns: list[str]):
        self._ids = T.StructType([T.StructField("id", T.ArrayType(id_type)), T.StructField("us", T.ArrayType(T.LongType())),
                                  T.StructField("at", T.ArrayType(T.LongType()))])
        self._ttl, self._columns = ttl_ms, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._newest = handle.getMapState("newest", _LONG, self._ids, ttlDurationMs=self._ttl)
        self._reset = handle.getValueState("reset", _LONG)

    def _known(self, bucket: int, now: int) -> dict:
        """id -> (time of its newest row, when it was written)."""
        held = self._newest.getValue((bucket,)) if self._newest.containsKey((bucket,)) else None
        return {k: (us, at) for k, us, at in zip(*held) if at + self._ttl > now} if held else {}

    def _keep(self, bucket: int, known: dict) -> None:
        if known:
            self._newest.updateValue((bucket,), (list(known), [us for us, _ in known.values()], [at for _, at in known.values()]))
        else:
            self._newest.removeKey((bucket,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        reset, now = self._reset.get()[0] if self._reset.exists() else None, timerValues.getCurrentProcessingTimeInMs()
        for frame in _chunks(rows):
            control = frame["own_reset_"].to_numpy(bool)
            if control.any():
                at = int(frame.loc[control, "own_us_"].max())
                if reset is None or at > reset:
                    reset = at
                    self._reset.update((at,))
                    for bucket in [k[0] for k, _ in self._newest.iterator()]:
                        self._keep(bucket, {k: v for k, v in self._known(bucket, now).items() if v[0] > at})
                yield frame[control][self._columns]
            # one look-up per id, however often it comes
            frame = frame[~control].sort_values("own_us_", kind="stable").drop_duplicates("own_id_", keep="last")
            names, times, keep = frame["own_id_"].tolist(), frame["own_us_"].tolist(), np.zeros(len(frame), bool)
            for bucket, places in frame.groupby("own_bucket_", sort=False).indices.items():
                known = self._known(int(bucket), now)
                for i in places.tolist():
                    last = known.get(names[i])
                    if (reset is None or times[i] > reset) and (last is None or times[i] >= last[0]):
                        known[names[i]] = (times[i], now)
                        keep[i] = True
                if keep[places].any():
                    self._keep(int(bucket), known)
            if keep.any():
                yield frame[keep][self._columns]

    def close(self) -> None:
        pass


def keep_last_session(stream: DataFrame, id_col: str = "id", ts: str = "event_time", reset_col: str = "reset",
                      ttl: int = 24 * 3600, shards: int = SHARDS) -> DataFrame:
    """The rows that are the newest of their id when they come, since the last reset; for update mode and an upsert sink.

    A row with ``reset_col`` true is a control row: all rows up to its time are forgotten, and those that come later
    with such a time are dropped. It reaches every shard of the ids (a hash of the id) and is passed on by each.
    State is a time per id that came within ``ttl`` seconds; an id that is older starts anew.
    ``session_view`` reads the sink. Rows without an id are dropped.
    """
    control = F.coalesce(F.col(reset_col), F.lit(False))
    shard = F.when(control, F.sequence(F.lit(0), F.lit(shards - 1))).otherwise(F.array(F.pmod(F.xxhash64(id_col), F.lit(shards)).cast("int")))
    rows = stream.where(control | F.col(id_col).isNotNull()).select(
        "*", F.unix_micros(F.col(ts)).alias("own_us_"), control.alias("own_reset_"), F.col(id_col).alias("own_id_"), F.explode(shard).alias("own_shard_"))
    rows = rows.where("own_us_ is not null")
    rows = rows.withColumn("own_bucket_", F.pmod(F.hash(id_col), F.lit(BUCKETS)).cast("long"))
    # an id column without nulls keeps its type in pandas; control rows need none
    rows = rows.withColumn("own_id_", F.coalesce("own_id_", F.lit(0).cast(stream.schema[id_col].dataType)))
    processor = _KeepLast(stream.schema[id_col].dataType, ttl * 1000, stream.columns)
    return rows.groupBy("own_shard_").transformWithStateInPandas(processor, stream.schema, "update", "ProcessingTime")


def session_view(rows: DataFrame, id_col: str = "id", ts: str = "event_time", reset_col: str = "reset") -> DataFrame:
    """The session's rows from the sink of ``keep_last_session``: per id the newest since the newest reset."""
    control = F.coalesce(F.col(reset_col), F.lit(False))
    since = rows.where(control).agg(F.max(ts).alias("__since")).first()["__since"]  # one row
    own = rows.where(~control)
    if since is not None:
        own = own.where(F.col(ts) > F.lit(since))
    others = [c for c in own.columns if c not in (id_col, "batch_id")]
    order = F.struct(ts, "batch_id") if "batch_id" in own.columns else F.struct(ts, *[c for c in others if c != ts])
    last = own.groupBy(id_col).agg(F.max_by(F.struct(*others), order).alias("r"))
    return last.select(id_col, *[F.col(f"r.{c}").alias(c) for c in others]).drop(reset_col)


_RING = T.StructType([T.StructField("ends", T.ArrayType(T.LongType())), T.StructField("n", T.ArrayType(T.LongType())),
                      T.StructField("done", T.LongType()), T.StructField("on", T.BooleanType())])


class _Alert(StatefulProcessor):
    """State of a key: flagged rows by step over the trailing window (a ring), up to when it was judged, and whether the alert is on.

    A step's rows enter the window when the step ends and leave it when the window has passed. Between those moments
    nothing changes, so one timer for the next of them is enough.
    """

    def __init__(self, window_ms: int, units: float, threshold: float, clock: str):
        self._window, self._units, self._threshold, self._clock = window_ms, units, threshold, clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._ring = handle.getValueState("ring", _RING)

    def _load(self) -> tuple[dict[int, int], int, bool]:
        if not self._ring.exists():
            return {}, 0, False
        ends, n, done, on = self._ring.get()
        return dict(zip(ends, n)), done, on

    def _moments(self, ring: dict[int, int], after: int) -> list[int]:
        return sorted({m for e in ring for m in (e, e + self._window) if m > after})

    def _store(self, ring: dict[int, int], done: int, on: bool) -> None:
        self._ring.update((list(ring), list(ring.values()), done, on))
        ahead = self._moments(ring, done)
        if ahead:
            self._handle.registerTimer(ahead[0])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        ring, done, on = self._load()
        for frame in rows:
            for ends, n in frame.groupby("ends")["n"].sum().items():
                ring[int(ends)] = ring.get(int(ends), 0) + int(n)
        self._store(ring, done, on)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        ring, done, on = self._load()
        now = timerValues.getCurrentWatermarkInMs() if self._clock == "event" else timerValues.getCurrentProcessingTimeInMs()
        moments = [m for m in self._moments(ring, done) if m <= now]
        if not moments:
            return
        ends = np.array(sorted(ring))
        before = np.append(0, np.cumsum([ring[int(e)] for e in ends]))
        changes = []
        for m in moments:
            total = int(before[np.searchsorted(ends, m, "right")] - before[np.searchsorted(ends, m - self._window, "right")])
            if (total / self._units > self._threshold) != on:
                on = not on
                changes.append((key[0], pd.Timestamp(m, unit="ms"), on, total, total / self._units))
        done = moments[-1]
        self._store({e: n for e, n in ring.items() if e > done - self._window}, done, on)
        if changes:
            yield pd.DataFrame(changes, columns=["key", "at", "alert", "toxic", "rate"])

    def close(self) -> None:
        pass


def live_alert(stream: DataFrame, ts: str = "event_time", flag: str = "is_hate", key: str | None = None, step: float = 1.0,
               window_seconds: float = V.ALERT_WINDOW_SECONDS, rate_unit_seconds: float = 1.0, threshold: float = V.ALERT_THRESHOLD,
               delay: float = 0.0, clock: str = "event") -> DataFrame:
    """The changes of the alert as they happen: (key, at, alert, toxic, rate), for append mode.

    Every ``step`` seconds the alert is on if the flagged rows of the last ``window_seconds`` (whole steps) come
    faster than ``threshold`` per unit. A timer switches it off when rows stop coming: with ``clock="event"`` as soon as
    the watermark (newest row less ``delay`` and a step) is past, whatever moves it; with ``clock="processing"`` by the
    wall clock, in a stream without any rows as well. Micro-batches count per task and step before the shuffle, so
    a key's task gets some rows per step, not the stream. Rows without a time are dropped.
    """
    step_ms, window_ms = int(round(step * 1000)), int(round(window_seconds * 1000))
    if window_ms % step_ms:
        raise ValueError("the window must be a whole number of steps")
    named = F.col(key).cast("string") if key else F.lit("all")
    ends = (F.floor(F.unix_millis(F.col(ts)) / step_ms) + 1) * step_ms
    rows = stream.where(F.col(ts).isNotNull()).select(F.coalesce(named, F.lit("")).alias("key"), ends.cast("long").alias("ends"),
                                                      F.coalesce(F.col(flag), F.lit(False)).cast("long").alias("n"))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.groupby(["key", "ends"], as_index=False)["n"].sum()

    counts = rows.mapInPandas(count, rows.schema).withColumn("ends_at", F.timestamp_millis("ends"))
    mode = {"event": "EventTime", "processing": "ProcessingTime"}[clock]
    if clock == "event":
        counts = counts.withWatermark("ends_at", f"{int(round(delay * 1000)) + step_ms} milliseconds")
    processor = _Alert(window_ms, window_seconds / rate_unit_seconds, threshold, clock)
    return counts.groupBy("key").transformWithStateInPandas(
        processor, "key string, at timestamp, alert boolean, toxic long, rate double", "append", mode)
