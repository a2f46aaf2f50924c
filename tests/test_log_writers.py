"""One log, several writers: nothing lost, nothing twice, an index that stays small."""

import glob
import uuid

from commentguard.session import scratch_path
from commentguard.streaming import sinks as SK


def fresh(spark, name):
    return scratch_path(spark, f"tests/{name}-{uuid.uuid4().hex[:8]}")


def rows(spark, ids, v=0):
    return spark.createDataFrame([(i, v) for i in ids], "id long, v int").coalesce(1)


def stored(spark, path):
    return sorted(((r["id"], r["v"]) for r in SK.read_log(spark, path).collect()), key=repr)


def test_second_stream_and_lost_checkpoint_store_their_batches(spark):
    base = fresh(spark, "two")
    for name, ids in (("a", [1, 2]), ("b", [2, 3])):
        rows(spark, ids).write.parquet(f"{base}/{name}")
    for src, ckpt in (("a", "c1"), ("b", "c2"), ("b", "c3"), ("a", "c1")):
        SK.start_log_sink(spark.readStream.schema("id long, v int").parquet(f"{base}/{src}"), f"{base}/log", f"{base}/{ckpt}",
                          trigger={"availableNow": True}).awaitTermination()
    assert stored(spark, f"{base}/log") == [(1, 0), (2, 0), (3, 0)]


def test_null_ids_are_stored_once(spark):
    path = fresh(spark, "null")
    assert SK.idempotent_append(rows(spark, [None, 1, None]), 0, path) == 2
    assert SK.idempotent_append(rows(spark, [None, 2]), 1, path) == 1
    assert stored(spark, path) == [(1, 0), (2, 0), (None, 0)]


def test_writers_that_meet(spark, monkeypatch):
    """Another writer commits between a batch's look at the index and its commit: the ids that both have are stored once."""
    path, real, other = fresh(spark, "meet"), SK._commit, []

    def meet(commits, state, content):
        if content.get("writer") == "late" and not other:
            other.append(1)
            assert SK.idempotent_append(rows(spark, [1, 2], 7), 0, path, writer="early") == 2
        return real(commits, state, content)

    monkeypatch.setattr(SK, "_commit", meet)
    assert SK.idempotent_append(rows(spark, [2, 3], 8), 0, path, writer="late") == 1
    assert stored(spark, path) == [(1, 7), (2, 7), (3, 8)]


def test_index_is_merged_and_stays_small(spark, monkeypatch):
    monkeypatch.setattr(SK, "TIER", 3)
    path = fresh(spark, "merge")
    for k in range(14):
        assert SK.idempotent_append(rows(spark, [k, k + 1, 1000 + k]), k, path) == (3 if k == 0 else 2)
    assert len(stored(spark, path)) == 15 + 14
    state = SK._commits(spark, path).state()
    assert state.writers == {"default": 13} and sum(n for _, n in state.runs.values()) == 29
    assert sorted(level for level, _ in state.runs.values()) == [0, 0, 1, 2]  # 14 = 9 + 3 + 2
    files = glob.glob(f"{path}_ids/*/*.parquet")
    assert len(files) <= 3 * 3 + 3 and len(glob.glob(f"{path}_log/*")) < 20
    # at TIER = 16 a thousand batches leave 3 runs of level 2, 14 of level 1 and 8 of level 0, one file each
    assert SK.idempotent_append(rows(spark, [5, 1005, 77]), 14, path) == 1


def test_crash_in_a_merge_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(SK, "TIER", 2)
    path, real = fresh(spark, "mergecrash"), SK._commit

    def crash(commits, state, content):
        if "drops" in content:
            raise RuntimeError("lost in a merge")
        return real(commits, state, content)

    SK.idempotent_append(rows(spark, [1]), 0, path)
    monkeypatch.setattr(SK, "_commit", crash)
    try:
        SK.idempotent_append(rows(spark, [2]), 1, path)
        raise AssertionError("the merge should have failed")
    except RuntimeError:
        pass
    monkeypatch.setattr(SK, "_commit", real)
    assert SK.idempotent_append(rows(spark, [2]), 1, path) == 0  # the batch itself was committed
    assert SK.idempotent_append(rows(spark, [1, 2, 3]), 2, path) == 1
    assert stored(spark, path) == [(1, 0), (2, 0), (3, 0)]


def test_few_ids_open_no_file_without_them(spark):
    """The scan of an index run for hashes that it does not hold returns no rows: its Bloom filter drops the row group."""
    path = fresh(spark, "bloom")
    ids = spark.range(0, 20_000, 2).selectExpr("xxhash64(id) AS h", "id")
    SK._write_run(ids, path, 10_000)
    absent = [r["h"] for r in spark.range(1, 41, 2).selectExpr("xxhash64(id) AS h").collect()]

    def scanned(values):
        with SK._pushing(spark, SK.PROBE):
            df = spark.read.parquet(path).where(SK.F.col("h").isin(values))
            df.collect()
        plan = df._jdf.queryExecution().executedPlan()
        return plan.collectLeaves().head().metrics().apply("numOutputRows").value()

    present = [r["h"] for r in spark.range(0, 4, 2).selectExpr("xxhash64(id) AS h").collect()]
    assert scanned(absent) == 0 < scanned(present)


def test_rows_of_a_batch_stay_where_they_are(spark, monkeypatch):
    """What a batch adds is found by ids alone: no exchange in the plan of its rows; the same rows if ids are too many to send."""
    from pyspark.sql import functions as F

    batch = spark.createDataFrame([(k, f"text {k}") for k in [*range(40), None]], "id long, cmt string").repartition(3)
    same = batch.union(spark.createDataFrame([(3, "a text"), (30, "z"), (None, "a")], "id long, cmt string"))
    for rows_, want in ((batch, [(k, f"text {k}") for k in range(20, 40)]),
                        (same, [(k, f"text {k}") for k in range(20, 40)])):
        rows_ = rows_.persist()
        marks = rows_.groupBy("id").agg((F.count(F.lit(1)) > 1).alias("again")).withColumn("old", F.expr("id is null or id < 20")).persist()
        for sent in (SK.SENT, 0):
            monkeypatch.setattr(SK, "SENT", sent)
            out = SK._unstored(rows_, "id", F.struct("cmt"), marks)
            assert sorted(tuple(r) for r in out.collect()) == want
        monkeypatch.undo()
    plan = SK._unstored(batch, "id", F.struct("cmt"), batch.select("id", F.lit(False).alias("again"), F.expr("coalesce(id < 30, true)").alias("old")))
    assert "hashpartitioning" not in plan._jdf.queryExecution().optimizedPlan().toString()
    joined = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in joined and "SortMergeJoin" not in joined


def test_batch_shuffles_no_texts(spark, monkeypatch):
    """Appending wide rows of distinct ids groups their ids only, and the first of several rows of an id is kept as before."""
    grouped = []
    real = SK._unstored
    monkeypatch.setattr(SK, "_unstored", lambda rows_, id_col, key, marks: grouped.append(marks.columns) or real(rows_, id_col, key, marks))
    path = fresh(spark, "wide")
    assert SK.idempotent_append(spark.createDataFrame([(1, 5), (1, 4), (2, 1), (2, 3), (3, 0)], "id long, v int"), 0, path) == 3
    assert SK.idempotent_append(spark.createDataFrame([(1, 0), (4, 9), (4, 8), (5, 1)], "id long, v int"), 1, path) == 2
    assert stored(spark, path) == [(1, 4), (2, 1), (3, 0), (4, 8), (5, 1)]
    assert [sorted(c) for c in grouped] == [["again", "id", "old"]] * 2
