"""Idempotent log sink (A8, A10, I7) and an upsert sink for live aggregates.

The log keeps each id once, however late or far apart its copies arrive and whichever stream
brings them. A stream is a *writer*, named by the query id in its checkpoint, so a second stream,
or one whose checkpoint was lost, never takes another's batches for its own. Every micro-batch owns
one folder of the table (``log_writer=W/batch_id=N``), written with overwrite and visible to
``read_log`` once the batch is in the commit list (``commits``); a batch that failed half-way is
replayed from the checkpoint and replaces what it left, a committed one is a no-op. When two writers
meet, the later one sees at its commit that the list has moved on, reads the ids that were added
and writes its batch again without them.

Ids are indexed in runs: Parquet files of (hash, id) sorted by the hash, with a Bloom filter and
page index on it. A batch of few ids (``PROBE``) pushes their hashes into the scan, so a file that
cannot hold any of them is dropped by its filter; a larger batch is joined to the runs. Only ids are
joined: those that are stored, or those that are not if they are fewer, are then sent to the batch's
rows, which stay where they are unless both are many (``SENT``). ``TIER`` runs
of a level are merged into one of the next, so n batches leave about TIER * log(n) / log(TIER) runs.
Runs that a merge replaced are deleted at the merge after it; a reader slower than that fails and is
replayed.

A null id is an id like any other: its first row is stored.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .commits import CommitList, State

BATCH = "batch_id"
WRITER = "log_writer"
OWN = (WRITER, BATCH)  # columns of the stored table beside the log's
TIER = 16
PROBE = 1000  # a batch of at most so many ids looks them up by their hashes
SENT = 200_000  # ids that may be sent to the rows of a batch
FILE_IDS = 1_000_000  # ids of an index file
_IN_FILTER = "spark.sql.parquet.pushdown.inFilterThreshold"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


@contextmanager
def _pushing(spark: SparkSession, n: int) -> Iterator[None]:
    """Lists of up to n values are pushed to the scan (by default ten), while it runs."""
    before = spark.conf.get(_IN_FILTER)
    spark.conf.set(_IN_FILTER, str(max(n, int(before))))
    try:
        yield
    finally:
        spark.conf.set(_IN_FILTER, before)


def _commits(spark: SparkSession, root: str) -> CommitList:
    return CommitList(spark, f"{root}_log")


def _commit(commits: CommitList, state: State, content: dict) -> bool:
    return commits.commit(state, content)


def _write_run(ids: DataFrame, path: str, rows: int) -> None:
    """An index run: files of about FILE_IDS ids, by ranges of the hash."""
    files = max(1, -(-rows // FILE_IDS))
    ids = ids.coalesce(1) if files == 1 else ids.repartitionByRange(files, "h")
    ids.sortWithinPartitions("h").write.mode("overwrite").option("parquet.bloom.filter.enabled#h", "true") \
        .option("parquet.bloom.filter.expected.ndv#h", str(min(max(rows, 1), 2 * FILE_IDS))).parquet(path)


def _run_path(root: str, name: str) -> str:
    return f"{root}_ids/{name}"


def _read_runs(spark: SparkSession, root: str, names: list[str], schema) -> DataFrame:
    return spark.read.schema(schema).parquet(*[_run_path(root, n) for n in names])


def _by_ids(rows: DataFrame, id_col: str, ids: DataFrame, n: int, how: str) -> DataFrame:
    """Rows whose id is (left_semi) or is not (left_anti) one of n ids."""
    ids = ids.select(F.col("id").alias("__id"))
    return rows.join(F.broadcast(ids) if n <= SENT else ids, rows[id_col].eqNullSafe(F.col("__id")), how)


def _unstored(rows: DataFrame, id_col: str, key: Column, marks: DataFrame) -> DataFrame:
    """Of the batch's rows, one (that with the least key) of every id not marked as stored; marks: id, again, old."""
    is_new, is_again = ~F.col("old"), F.col("again") & ~F.col("old")
    n_old, n_new, n_again = marks.agg(*[F.count_if(c) for c in (F.col("old"), is_new, is_again)]).first()
    out = rows
    if n_old:
        out = _by_ids(rows, id_col, marks.where(is_new), n_new, "left_semi") if n_new < n_old else \
            _by_ids(rows, id_col, marks.where("old"), n_old, "left_anti")
    if not n_again:
        return out
    others = [c for c in rows.columns if c != id_col]
    repeated = out if n_again > SENT else _by_ids(out, id_col, marks.where(is_again), n_again, "left_semi")
    firsts = repeated.groupBy(id_col).agg(F.min_by(F.struct(*others), key).alias("__r")) \
        .select(id_col, *[F.col(f"__r.{c}").alias(c) for c in others]).select(*rows.columns)
    return firsts if n_again > SENT else _by_ids(out, id_col, marks.where(is_again), n_again, "left_anti").unionByName(firsts)


def idempotent_append(batch: DataFrame, batch_id: int, table_path: str, id_col: str = "id",
                      order_col: str | None = None, count_rows: bool = True,
                      partition_col: str | None = None, writer: str = "default") -> int:
    """A8 + D6: append rows whose id is not yet stored; returns rows written (-1 with ``count_rows=False``).

    Batch ids of a writer grow. Within a batch, one row per id is kept (the smallest ``order_col``, else
    the smallest row by value, so the choice is deterministic on replay). With ``partition_col``
    a batch's folder is partitioned by it. The stored table has the extra columns ``OWN``;
    ``read_log`` leaves them out.
    """
    spark, root, batch_id = batch.sparkSession, table_path.rstrip("/"), int(batch_id)
    commits = _commits(spark, root)
    state = commits.state()
    if batch_id <= state.writers.get(writer, -1):
        return 0  # replay of a committed batch
    others = [c for c in batch.columns if c != id_col]
    key = F.struct(F.col(order_col)) if order_col else F.struct(*others)
    held = batch.storageLevel.useMemory or batch.storageLevel.useDisk  # by the caller, who will let it go
    rows = batch if held else batch.persist()  # read for its ids and by the write, again if another writer was first
    ids = rows.groupBy(F.col(id_col).alias("id")).agg((F.count(F.lit(1)) > 1).alias("again")) \
        .select(F.xxhash64("id").alias("h"), "id", "again").persist()
    schema = ids.select("h", "id").schema
    folder, run = f"{root}/{WRITER}={writer}/{BATCH}={batch_id}", f"0-{writer}-{batch_id}"
    try:
        while True:
            marks = ids.select("id", "again", F.lit(False).alias("old"))
            with _pushing(spark, PROBE):
                if state.runs:
                    stored = _read_runs(spark, root, list(state.runs), schema)
                    few = [r["h"] for r in ids.select("h").limit(PROBE + 1).collect()]
                    if len(few) <= PROBE:
                        stored = stored.where(F.col("h").isin(few))
                    stored = stored.select(F.col("id").alias("__id"), F.lit(True).alias("__old"))
                    marks = ids.join(stored, ids["id"].eqNullSafe(F.col("__id")), "left") \
                        .select("id", "again", F.coalesce("__old", F.lit(False)).alias("old"))
                marks = marks.persist()
                try:
                    out = _unstored(rows, id_col, key, marks).write.mode("overwrite")
                    (out.partitionBy(partition_col) if partition_col else out).parquet(folder)
                finally:
                    marks.unpersist()
            kept = spark.read.schema(batch.select(id_col).schema).parquet(folder)
            n = kept.count()
            _write_run(kept.select(F.xxhash64(id_col).alias("h"), F.col(id_col).alias("id")), _run_path(root, run), n)
            if _commit(commits, state, {"writer": writer, "batch": batch_id, "adds": {run: [0, n]}}):
                break
            state = commits.state()  # another writer committed: its ids count, too
            if batch_id <= state.writers.get(writer, -1):
                return 0
    finally:
        ids.unpersist()
        if not held:
            rows.unpersist()
    _compact(spark, root, commits, schema)
    return n if count_rows else -1


def _compact(spark: SparkSession, root: str, commits: CommitList, schema) -> None:
    """Merge the runs of a level once there are ``TIER``; merges of several writers give way to each other."""
    state = commits.state()
    by_level: dict[int, list[str]] = {}
    for name, (level, _) in state.runs.items():
        by_level.setdefault(level, []).append(name)
    for level, names in sorted(by_level.items()):
        if len(names) < TIER:
            continue
        rows = sum(state.runs[n][1] for n in names)
        merged = f"{level + 1}-{uuid.uuid4().hex}"
        _write_run(_read_runs(spark, root, names, schema), _run_path(root, merged), rows)
        content = {"adds": {merged: [level + 1, rows]}, "drops": names}
        retired = state.retired
        while not _commit(commits, state, content):
            state = commits.state()
            if not set(names) <= set(state.runs):  # merged by another writer
                _delete(spark, _run_path(root, merged))
                return
        for name in retired:
            _delete(spark, _run_path(root, name))
        state = commits.state()
        commits.snapshot(state)
        return _compact(spark, root, commits, schema)


def read_log(spark: SparkSession, table_path: str) -> DataFrame:
    """The committed rows, without the writer and batch they came in (both are folders, so others are not read)."""
    root = table_path.rstrip("/")
    last = _commits(spark, root).state().writers
    committed = F.lit(False)
    for writer, batch_id in last.items():
        committed = committed | ((F.col(WRITER) == writer) & (F.col(BATCH) <= batch_id))
    return spark.read.option("basePath", root).parquet(root).where(committed).drop(*OWN)


def writer_of(spark: SparkSession, checkpoint: str) -> str:
    """The query id that Spark keeps in a started stream's checkpoint."""
    fs, p = _fs(spark, f"{checkpoint.rstrip('/')}/metadata")
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()


def start_log_sink(stream: DataFrame, table_path: str, checkpoint: str,
                   transform: Callable[[DataFrame], DataFrame] | None = None,
                   trigger: dict | None = None, id_col: str = "id", query_name: str | None = None,
                   partition_col: str | None = None):
    """A10: micro-batch driver: per batch ``transform`` (clean -> score -> assemble) then A8.

    ``trigger`` defaults to processingTime 1 second; tests pass {"availableNow": True}.
    A checkpoint location is mandatory; any number of streams may write to one table.
    """
    def per_batch(df: DataFrame, batch_id: int) -> None:
        out = transform(df) if transform else df
        idempotent_append(out, batch_id, table_path, id_col, count_rows=False, partition_col=partition_col,
                          writer=writer_of(df.sparkSession, checkpoint))

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    return w.trigger(**(trigger or {"processingTime": "1 second"})).start()


def start_upsert_sink(stream: DataFrame, table_path: str, checkpoint: str, trigger: dict | None = None):
    """Rows that an update-mode query changed, one folder per micro-batch (replays overwrite their own)."""
    def per_batch(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{table_path.rstrip('/')}/{BATCH}={int(batch_id)}")

    return (stream.writeStream.outputMode("update").foreachBatch(per_batch).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 second"})).start())


def latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The latest row of every key of an upsert sink's table."""
    others = [c for c in rows.columns if c not in (*keys, BATCH)]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), BATCH).alias("r"))
    return last.select(*keys, *[F.col(f"r.{c}").alias(c) for c in others])
