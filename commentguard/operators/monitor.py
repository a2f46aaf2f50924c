"""Monitoring aggregates over the scored log.

Every aggregate is one scan with partial (map-side) aggregation. Time-window
work never funnels through a single partition: the trailing-window alert
pre-aggregates per timestamp and partitions the window by time bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab as V


def _micros(c: str | Column) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp") if isinstance(c, str) else c.cast("timestamp"))


def kpis(log: DataFrame, flag: str = "is_hate") -> DataFrame:
    """Total, toxic, clean, toxic ratio in percent (0 when empty) in one pass."""
    total = F.count(F.lit(1))
    toxic = F.count_if(F.col(flag))
    return log.agg(total.alias("total"), toxic.alias("toxic")).select(
        "total", "toxic", (F.col("total") - F.col("toxic")).alias("clean"),
        F.when(F.col("total") > 0, F.col("toxic") * 100.0 / F.col("total")).otherwise(F.lit(0.0)).alias("toxic_ratio"),
    )


def type_counts(log: DataFrame, types: str = "type_attack") -> DataFrame:
    """Attack-type frequency (type_attack, n), most frequent first, ties by name."""
    return _type_counts(log, types).orderBy(F.desc("n"), "type_attack")


def _type_counts(log: DataFrame, types: str) -> DataFrame:
    return log.select(F.explode(types).alias("type_attack")).groupBy("type_attack").agg(F.count(F.lit(1)).alias("n"))


def top_type(log: DataFrame, types: str = "type_attack") -> DataFrame:
    """Most frequent type (higher count, then name ascending), 'N/A' when none."""
    counts = _type_counts(log, types)
    best = counts.agg(F.min_by(F.col("type_attack"), F.struct(-F.col("n"), F.col("type_attack"))).alias("t"),
                      F.max("n").alias("n"))
    return best.select(F.coalesce("t", F.lit("N/A")).alias("top_type"), F.coalesce("n", F.lit(0)).alias("n"))


def target_counts(log: DataFrame, levels: tuple[str, ...] = ("Offensive", "Hate")) -> DataFrame:
    """Toxic rows per target; a missing target column counts 0."""
    aggs = []
    for t in V.TARGETS:
        c = F.count_if(F.col(t).isin(*levels)) if t in log.columns else F.lit(0).cast("long")
        aggs.append(c.alias(t))
    wide = log.agg(*aggs)
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(t).alias("target"), F.col(t).alias("n")) for t in V.TARGETS])).alias("r")).select("r.*")


def trend(log: DataFrame, ts: str = "timestamp", flag: str = "is_hate", block: str = V.TREND_BLOCK) -> DataFrame:
    """E5: toxic count per tumbling block; only blocks that have rows (zero sums kept)."""
    return log.groupBy(F.window(F.col(ts), block).start.alias("time_block")).agg(
        F.sum(F.col(flag).cast("int")).alias("toxic_count"))


def current_alert(log: DataFrame, ts: str = "timestamp", flag: str = "is_hate", now: str | None = None, window_seconds: float = 3.0,
                  rate_unit_seconds: float = 1.0, threshold: float = V.ALERT_THRESHOLD) -> DataFrame:
    """The alert state now (default: the newest row's time): one row (now, toxic, rate, alert), no alert in a quiet period."""
    newest = log.agg(F.max(ts).alias("now")) if now is None else log.sparkSession.range(1).select(F.lit(now).cast("timestamp").alias("now"))
    at = newest.first()["now"]
    here = F.col(ts).between(F.lit(at) - F.expr(f"make_dt_interval(0, 0, 0, {window_seconds})"), F.lit(at))
    toxic = log.where(here).agg(F.count_if(F.col(flag)).alias("toxic"))  # the range reaches the scan as a filter
    rate = F.col("toxic") / F.lit(window_seconds / rate_unit_seconds)
    return toxic.select(F.lit(at).alias("now"), "toxic", rate.alias("rate"), (rate > threshold).alias("alert"))


def burst_alert(log: DataFrame, ts: str = "timestamp", flag: str = "is_hate",
                window_seconds: float = V.ALERT_WINDOW_SECONDS, rate_unit_seconds: float = 1.0,
                baseline: float = V.ALERT_BASELINE, threshold: float = V.ALERT_THRESHOLD) -> DataFrame:
    """E6 at every distinct timestamp: toxic rows in [t - window, t], rate per unit, alert.

    rate = toxic / (window / unit); alert when rate > threshold, with
    velocity = rate and growth = (rate - baseline) / baseline * 100, else
    0 / 0. Per-timestamp pre-aggregation absorbs bursts (hot instants) before
    any shuffle; sums run per time bucket of width ``window``, with the previous
    bucket's rows copied in as context, so no partition ever holds more than two
    buckets. A context row is taken off again once the window has left it: the
    running sum takes each row once, where a sliding frame sums all its rows anew.
    """
    w_us = int(round(window_seconds * 1_000_000))
    per_ts = log.groupBy(F.col(ts).cast("timestamp").alias("ts")).agg(
        F.sum(F.col(flag).cast("long")).alias("toxic_at"))
    per_ts = per_ts.withColumn("us", F.unix_micros("ts")).withColumn("bucket", F.floor(F.col("us") / w_us))
    per_ts = per_ts.withColumn("known", F.col("toxic_at").isNotNull().cast("int"))  # a window without a known flag has no sum
    own = per_ts.withColumn("context", F.lit(False))
    ctx = per_ts.withColumn("bucket", F.col("bucket") + 1).withColumn("context", F.lit(True))
    gone = ctx.where("us is not null").withColumn("us", F.col("us") + w_us + 1).withColumn("toxic_at", -F.col("toxic_at")) \
        .withColumn("known", -F.col("known"))
    frame = Window.partitionBy("bucket").orderBy("us").rangeBetween(Window.unboundedPreceding, 0)
    counted = own.unionByName(ctx).unionByName(gone) \
        .withColumn("toxic_in_window", F.when(F.sum("known").over(frame) > 0, F.sum("toxic_at").over(frame))) \
        .filter(~F.col("context"))
    rate = F.col("toxic_in_window") / F.lit(window_seconds / rate_unit_seconds)
    alert = rate > F.lit(threshold)
    return counted.select(
        "ts", "toxic_in_window",
        rate.alias("rate"),
        alert.alias("is_alert"),
        F.when(alert, rate).otherwise(F.lit(0.0)).alias("velocity"),
        F.when(alert, (rate - baseline) / F.lit(baseline) * 100.0).otherwise(F.lit(0.0)).alias("increase_pct"),
    )


def sliding_alert(log: DataFrame, ts: str = "timestamp", flag: str = "is_hate",
                  window: str = "3 seconds", slide: str = "1 second", window_seconds: float = 3.0,
                  rate_unit_seconds: float = 1.0, threshold: float = V.ALERT_THRESHOLD) -> DataFrame:
    """I5 (batch form): sliding windows whose toxic rate exceeds the threshold."""
    agg = log.groupBy(F.window(F.col(ts).cast("timestamp"), window, slide).alias("w")).agg(
        F.sum(F.col(flag).cast("long")).alias("toxic"))
    rate = F.col("toxic") / F.lit(window_seconds / rate_unit_seconds)
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "toxic", rate.alias("rate")).filter(F.col("rate") > threshold)


def select_existing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Project the listed columns that exist, in the given order."""
    return df.select(*[c for c in columns if c in df.columns])


def recent(log: DataFrame, n: int = V.RECENT_ROWS, ts: str = "timestamp", id_col: str = "id",
           columns: list[str] | None = None) -> DataFrame:
    """F1 + C6: the n most recent rows (ties by id), only the columns that exist."""
    cols = columns or ["timestamp", "cmt", "cmt_processed", "type_attack", "Individual", "Group", "Societal"]
    extra = [id_col] if id_col not in cols else []
    return select_existing(log.orderBy(F.col(ts).desc(), F.col(id_col)).limit(n), extra + cols)


def keep_last(df: DataFrame, key: str = "id", order: list[str] | None = None) -> DataFrame:
    """one row per key, the last by ``order`` (default: timestamp).

    Computed as an aggregate (``keep_last_agg``), not a window: a key holding a
    large share of the rows is reduced map-side instead of sorted in one task.
    """
    return keep_last_agg(df, key, order or ["timestamp"])


def keep_last_agg(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """F2 as an aggregate: ``max_by`` over the order struct, with map-side combine.

    Preferred at scale when a key can be hot: partial aggregation reduces each
    key to one row per task before the shuffle, where a window would sort all
    of a hot key's rows in one task.
    """
    others = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("__r"))
    return best.select(key, *[F.col(f"__r.{c}").alias(c) for c in others])


def incremental_read(log: DataFrame, after_ts: str, after_id=None, ts: str = "timestamp",
                     id_col: str = "id", strict_ts_only: bool = False) -> DataFrame:
    """A9 + F10: rows past a high-water mark, ascending.

    Default mark is the pair (ts, id), so rows sharing the mark's timestamp are
    not lost; ``strict_ts_only`` gives the plain ``ts > mark`` rule.
    """
    mark = F.lit(after_ts).cast("timestamp")
    t = F.col(ts).cast("timestamp")
    cond = t > mark
    if not strict_ts_only and after_id is not None:
        cond = cond | ((t == mark) & (F.col(id_col) > F.lit(after_id)))
    return log.filter(cond).orderBy(t, F.col(id_col))


def high_water_mark(rows: DataFrame, ts: str = "timestamp", id_col: str = "id") -> DataFrame:
    """The new mark = max (ts, id) of what was read."""
    return rows.agg(F.max(F.struct(F.col(ts).cast("timestamp").alias("ts"), F.col(id_col).alias("id"))).alias("m")) \
        .select("m.ts", "m.id")


def union_increment(accumulated: DataFrame, increment: DataFrame) -> DataFrame:
    """G1: append an increment, columns aligned by name, missing ones null."""
    return accumulated.unionByName(increment, allowMissingColumns=True)


def display_time(c: str | Column, hours: int = V.DISPLAY_SHIFT_HOURS) -> Column:
    """Fixed display shift."""
    col = F.col(c) if isinstance(c, str) else c
    return col + F.make_interval(hours=F.lit(hours))
