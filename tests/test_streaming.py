"""Streaming: idempotent append under replay, stream = batch for dedup."""

import uuid

from pyspark.sql import functions as F

from commentguard.session import scratch_path
from commentguard.streaming import sinks as SK


def test_idempotent_append_replay(spark):
    path = scratch_path(spark, f"tests/log-{uuid.uuid4().hex[:8]}")
    b0 = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "id string, v int")
    assert SK.idempotent_append(b0, 0, path, order_col="v") == 2
    assert SK.idempotent_append(b0, 0, path, order_col="v") == 0      # replayed batch id: no-op
    b1 = spark.createDataFrame([("b", 9), ("c", 4)], "id string, v int")
    assert SK.idempotent_append(b1, 1, path, order_col="v") == 1      # b already stored: first write wins
    rows = {r["id"]: r["v"] for r in SK.read_log(spark, path).collect()}
    assert rows == {"a": 1, "b": 2, "c": 4}


def test_parse_payload_malformed(spark):
    from commentguard.sources.payload import parse_payload
    df = spark.createDataFrame([('{"id": "x", "cmt": "hi", "timestamp": 1.5}',), ("not json",), (None,)], "value string")
    rows = parse_payload(df, with_corrupt=True).collect()
    assert rows[0]["id"] == "x" and rows[0]["_corrupt"] is None
    assert rows[1]["id"] is None and rows[1]["_corrupt"] == "not json"
    assert rows[2]["id"] is None


def test_stream_dedup_equals_batch(spark):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    got = E.queries()["q_stream_dedup"](spark, sf)
    from commentguard.plans import fixtures as FX
    want = FX.flags(spark, sf)
    assert got.count() == want.count() == got.select("id").distinct().count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_late_rows_are_dropped_and_counted(spark):
    from commentguard.streaming import monitor as SM
    base = scratch_path(spark, f"tests/late-{uuid.uuid4().hex[:8]}")
    src = f"{base}/src"
    mk = lambda rows: spark.createDataFrame(rows, "id long, ts string, is_hate boolean") \
        .selectExpr("id", "cast(ts as timestamp) as timestamp", "is_hate")
    mk([(1, "2024-01-01 10:00:00", True), (2, "2024-01-01 10:30:00", True)]).coalesce(1).write.parquet(src)
    mk([(3, "2024-01-01 08:00:00", True), (4, "2024-01-01 12:10:00", False)]).coalesce(1) \
        .write.mode("append").parquet(src)
    mk([(5, "2024-01-01 07:00:00", True), (6, "2024-01-01 12:20:00", False)]).coalesce(1) \
        .write.mode("append").parquet(src)
    stream = spark.readStream.schema(mk([]).schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (SM.trend_stream(stream, ts="timestamp", block="1 hour", delay="1 hour").writeStream
         .format("memory").queryName("late_trend").outputMode("append")
         .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {str(r["time_block"])[11:16]: r["toxic_count"] for r in spark.table("late_trend").collect()}
    # Late input is filtered against the previous batch's watermark: the 08:00 row
    # (batch 1, previous watermark = none) is still counted, the 07:00 row (batch 2,
    # previous watermark 09:30) is dropped and reported.
    assert got.get("08:00") == 1
    assert "07:00" not in got
    assert got.get("10:00") == 2
    assert SM.dropped_by_watermark(q) == 1


def test_late_duplicates_are_recognised_however_far_apart(spark):
    path = scratch_path(spark, f"tests/plog-{uuid.uuid4().hex[:8]}")
    mk = lambda rows: spark.createDataFrame(rows, "id string, v int, d string").withColumn("d", F.to_date("d"))
    assert SK.idempotent_append(mk([("a", 1, "2024-01-01"), ("b", 2, "2024-01-10")]), 0, path, order_col="v", partition_col="d") == 2
    assert SK.idempotent_append(mk([("a", 3, "2024-01-03")]), 1, path, order_col="v", partition_col="d") == 0
    # "b" again in a later batch and far away in time
    assert SK.idempotent_append(mk([("b", 4, "2031-01-15"), ("c", 5, "2031-01-15")]), 2, path, order_col="v", partition_col="d") == 1
    assert {(r["id"], r["v"]) for r in SK.read_log(spark, path).collect()} == {("a", 1), ("b", 2), ("c", 5)}


def test_crash_between_write_and_marker_restarts_from_the_checkpoint(spark, monkeypatch):
    base = scratch_path(spark, f"tests/crash-{uuid.uuid4().hex[:8]}")
    schema = "id long, v int"
    for rows in ([(1, 1), (2, 2)], [(2, 9), (3, 3)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/src")
    start = lambda: SK.start_log_sink(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/src"),
                                      f"{base}/log", f"{base}/ckpt", trigger={"availableNow": True})
    real = SK._commit

    def crash(commits, state, content):
        if content.get("batch") == 1:
            raise RuntimeError("lost before the marker")
        return real(commits, state, content)

    monkeypatch.setattr(SK, "_commit", crash)
    try:
        start().awaitTermination()
        raise AssertionError("the second batch should have failed")
    except Exception as e:
        assert "lost before the marker" in str(e)
    assert SK.read_log(spark, f"{base}/log").count() == 2  # what the lost batch left is not part of the log
    monkeypatch.setattr(SK, "_commit", real)
    start().awaitTermination()
    assert {(r["id"], r["v"]) for r in SK.read_log(spark, f"{base}/log").collect()} == {(1, 1), (2, 2), (3, 3)}


def test_file_source_rate_limit_and_messages(spark):
    from pyspark.sql import types as T
    from commentguard.streaming import ingest
    base = scratch_path(spark, f"tests/rate-{uuid.uuid4().hex[:8]}")
    schema = T.StructType([T.StructField("value", T.StringType())])
    for i in range(3):
        spark.createDataFrame([(f'{{"id": "m{i}", "cmt": "c{i}", "timestamp": {1700000000 + i}.5}}',)], schema) \
            .coalesce(1).write.mode("append").parquet(f"{base}/src")
    stream = ingest.messages(ingest.file_source(spark, f"{base}/src", schema, max_files_per_trigger=1))
    q = (stream.writeStream.format("memory").queryName("rate_msgs").option("checkpointLocation", f"{base}/ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(batches) == 3                       # one file per micro-batch
    rows = {r["id"]: r for r in spark.table("rate_msgs").collect()}
    assert set(rows) == {"m0", "m1", "m2"}
    assert str(rows["m1"]["event_time"]).startswith("2023-11-14 22:13:21.5")
