"""Session state and the live alert: across micro-batches, restarts, resets, expiry and quiet periods."""

import time
import uuid

from pyspark.sql import functions as F

from commentguard.session import scratch_path
from commentguard.streaming import session as SS
from commentguard.streaming import sinks as SK

SCHEMA = "id string, event_time timestamp, v int, reset boolean"


def add(spark, base, rows):
    df = spark.createDataFrame(rows, SCHEMA.replace("timestamp", "string")).withColumn("event_time", F.col("event_time").cast("timestamp"))
    df.coalesce(1).write.mode("append").parquet(f"{base}/src")


def run(spark, base, ttl):
    stream = spark.readStream.schema(SCHEMA).parquet(f"{base}/src")
    with SS.rocksdb(spark, idle_batches=False):
        SK.start_upsert_sink(SS.keep_last_session(stream, ttl=ttl, shards=3), f"{base}/out", f"{base}/ckpt", {"availableNow": True}).awaitTermination()
    return {(r["id"], r["v"]) for r in SS.session_view(spark.read.parquet(f"{base}/out")).collect()}


def test_keep_last_reset_and_restart(spark):
    base = scratch_path(spark, f"tests/session-{uuid.uuid4().hex[:8]}")
    at = "2024-01-01 10:00:0"
    add(spark, base, [("a", at + "1", 1, None), ("b", at + "2", 2, False), ("a", at + "3", 3, None), (None, at + "3", 0, None), ("x", None, 9, None)])
    assert run(spark, base, 3600) == {("a", 3), ("b", 2)}
    add(spark, base, [("a", at + "2", 4, None), ("b", at + "4", 5, None)])  # older than what is there, newer
    assert run(spark, base, 3600) == {("a", 3), ("b", 5)}
    add(spark, base, [("c", at + "5", 6, None), (None, at + "4", None, True), ("b", at + "4", 7, None), ("c", at + "4", 8, None)])
    assert run(spark, base, 3600) == {("c", 6)}
    add(spark, base, [("a", at + "3", 9, None), ("b", at + "6", 10, None)])  # before the reset, after it
    assert run(spark, base, 3600) == {("c", 6), ("b", 10)}
    emitted = spark.read.parquet(f"{base}/out").where("not coalesce(reset, false)")
    assert emitted.where("v in (4, 9)").count() == 0  # known to be old from the state


def test_state_is_bounded_by_its_time_to_live(spark):
    base = scratch_path(spark, f"tests/ttl-{uuid.uuid4().hex[:8]}")
    add(spark, base, [("a", "2024-01-01 10:00:05", 1, None)])
    run(spark, base, 1)
    time.sleep(1.5)
    add(spark, base, [("a", "2024-01-01 10:00:03", 2, None), ("b", "2024-01-01 10:00:04", 3, None)])
    run(spark, base, 1)
    emitted = {r["v"] for r in spark.read.parquet(f"{base}/out").collect()}
    assert emitted == {1, 2, 3}  # the older row of "a" starts anew: its time was forgotten


def alert(spark, base, **kw):
    stream = spark.readStream.schema("event_time timestamp, is_hate boolean, target string").option("maxFilesPerTrigger", 1).parquet(f"{base}/src")
    with SS.rocksdb(spark):
        return SS.live_alert(stream, threshold=2.0, window_seconds=3, **kw).writeStream.format("parquet").outputMode("append") \
            .option("checkpointLocation", f"{base}/ckpt").trigger(**({"availableNow": True} if kw.get("clock") != "processing" else
                                                                    {"processingTime": "1 second"})).start(f"{base}/out")


def events(spark, base, rows):
    df = spark.createDataFrame(rows, "event_time string, is_hate boolean, target string").withColumn("event_time", F.col("event_time").cast("timestamp"))
    df.coalesce(1).write.mode("append").parquet(f"{base}/src")


def test_alert_goes_off_in_a_quiet_period_per_key(spark):
    base = scratch_path(spark, f"tests/alert-{uuid.uuid4().hex[:8]}")
    at = "2024-01-01 10:00:"
    # seven toxic rows of "a" in second 1 (7/3 > 2), then nothing of "a"; "b" is slow; one row moves the clock
    events(spark, base, [(at + "01.2", True, "a")] * 4 + [(at + "01.9", False, "a"), (at + "01.3", True, "b"), (None, True, "a")])
    events(spark, base, [(at + "01.5", True, "a")] * 3 + [(at + "02.0", True, "b")])
    events(spark, base, [(at + "30", False, None)])
    alert(spark, base, key="target").awaitTermination()
    got = [(r["key"], str(r["at"])[11:19], r["alert"], r["toxic"]) for r in spark.read.parquet(f"{base}/out").orderBy("at").collect()]
    assert got == [("a", "10:00:02", True, 7), ("a", "10:00:05", False, 0)]


def test_alert_by_the_wall_clock_goes_off_without_any_row(spark):
    base = scratch_path(spark, f"tests/clock-{uuid.uuid4().hex[:8]}")
    now = spark.sql("select current_timestamp() + interval 3 seconds as t").first()["t"]
    spark.createDataFrame([(now, True, "a")] * 8, "event_time timestamp, is_hate boolean, target string").coalesce(1).write.parquet(f"{base}/src")
    q = alert(spark, base, clock="processing")
    try:
        until, got = time.time() + 60, []
        while time.time() < until and len(got) < 2:
            time.sleep(1)
            try:
                got = [r["alert"] for r in spark.read.parquet(f"{base}/out").orderBy("at").collect()]
            except Exception:
                got = []
    finally:
        q.stop()
    assert got == [True, False]
