"""WARC archives: written as text rows, read back by boundary-chain verification.

Writing: one record per page. Of pages with equal payloads of at least ``MIN_PAYLOAD`` bytes the
one with the least id is a response, the others are revisits without a block that refer to it.
Only digests of payloads that repeat are grouped; payloads are not shuffled.

Reading: an archive is cut at every occurrence of the version line, inside payloads too, by
Spark's text reader (so files are split over tasks on any file system). The pieces tile a file,
so sums of their lengths give every piece's offset. Each piece whose head parses is a candidate
record with a successor offset (its header plus Content-Length). Inside a split, tasks shorten
chains to the first offset beyond the split; over splits, reachability from the file's start is
found by pointer jumping (jumps double each round). Candidates that are not reachable lie in
payloads and are rejected. Records that span pieces are put together from theirs.

Defined cases: a null html is an empty payload; a null url leaves the header out, control
characters in a url are percent-encoded; pages that repeat an id are all written; pages
with a null id and a known payload are revisits, otherwise responses; an empty table gives an
empty archive and result; other columns are not archived. A chain that breaks (a cut file) ends there.
"""

from __future__ import annotations

import math
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from commentguard.llm.common import materialise, read_table, small
from commentguard.session import scratch_path

MIN_PAYLOAD = 100
_MAGIC = "WARC/1.1\r\n"
_END = "\r\n\r\n"
_SMALL_ROWS = 100_000


def record_types(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """pages with warc_payload, warc_digest, warc_bytes and warc_refers (the response's id for revisits)."""
    payload = F.coalesce(F.col(html), F.lit(""))
    own = pages.withColumns({"warc_payload": payload, "warc_digest": F.sha2(payload, 256), "warc_bytes": F.octet_length(payload).cast("long")})
    seen = own.where(F.col("warc_bytes") >= MIN_PAYLOAD).groupBy("warc_digest") \
        .agg(F.min(page_id).alias("warc_first"), F.count(F.lit(1)).alias("warc_n")).where("warc_n > 1").drop("warc_n")
    out = own.join(small(materialise(seen, "warc-repeats"), _SMALL_ROWS), "warc_digest", "left")
    again = F.col("warc_first").isNotNull() & ~F.col(page_id).eqNullSafe(F.col("warc_first")) & (F.col("warc_bytes") >= MIN_PAYLOAD)
    return out.withColumn("warc_refers", F.when(again, F.col("warc_first"))).drop("warc_first")


def write_archive(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                  date: str = "1970-01-01T00:00:00Z") -> None:
    """Write pages as WARC files under path."""
    rows = record_types(pages, page_id, html)
    revisit = F.col("warc_refers").isNotNull()
    name = lambda c: F.concat(F.lit("<urn:page:"), F.col(c).cast("string"), F.lit(">"))
    uri = F.regexp_replace(F.col(url), r"[\x00-\x20\x7F]", "%20")
    line = lambda key, value: F.coalesce(F.concat(F.lit(f"{key}: "), value, F.lit("\r\n")), F.lit(""))
    record = F.concat(
        F.lit(_MAGIC), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.coalesce(name(page_id), F.lit("<urn:page:>"))), line("WARC-Date", F.lit(date)), line("WARC-Target-URI", uri),
        line("WARC-Refers-To", F.when(revisit, name("warc_refers"))),
        line("WARC-Profile", F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "warc_digest")), line("X-Payload-Length", F.col("warc_bytes").cast("string")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        F.lit("Content-Length: "), F.when(revisit, "0").otherwise(F.col("warc_bytes").cast("string")), F.lit(_END),
        F.when(revisit, "").otherwise(F.col("warc_payload")))
    rows.select(record.alias("value")).write.option("lineSep", _END).text(path)


def _pieces(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """All pieces between version lines. raw: file, n (order in the file's split), raw bytes, sizes of piece and header, Content-Length.
    placed: the same without bytes, with the offset of the version line before (at) and of the next record (succ)."""
    text = spark.read.option("lineSep", _MAGIC).text(path)
    head = F.when(F.instr("value", _END) > 0, F.substring_index("value", _END, 1))
    length = F.regexp_extract(F.concat(F.lit("\r\n"), head), r"(?i)\r\nContent-Length:[ \t]*([0-9]{1,18})(?:\r\n|$)", 1)
    raw = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("n"), F.col("value").cast("binary").alias("raw"),
                      F.octet_length("value").cast("long").alias("size"), F.octet_length(head).alias("head"),
                      F.when(length != "", length).cast("long").alias("length"))
    raw = materialise(raw, "warc-pieces", "zstd")
    slim = raw.drop("raw")
    tile = F.col("size") + len(_MAGIC)
    blocks = slim.groupBy("file", "block").agg(F.sum(tile).alias("tiles"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.coalesce(F.sum("tiles").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    placed = slim.withColumn("in_block", F.coalesce(F.sum(tile).over(inside), F.lit(0))).join(blocks, ["file", "block"])
    at = F.col("base") + F.col("in_block") - len(_MAGIC)
    succ = at + len(_MAGIC) + F.col("head") + len(_END) + F.col("length") + len(_END)
    return raw.drop("block"), materialise(placed.select("file", "block", "n", at.alias("at"), "size", "head", "length", succ.alias("succ")), "warc-candidates")


def _shorten(group: pa.Table) -> pa.Table:
    """Candidates of one split: the first offset on their chain that is no candidate of the split."""
    at, succ = group.column("at").to_pylist(), group.column("succ").to_pylist()
    leave: dict[int, int] = {}
    for a, s in sorted(zip(at, succ), reverse=True):  # successors lie behind
        leave[a] = leave.get(s, s)
    return pa.table({"file": group.column("file"), "at": group.column("at"), "leave": pa.array([leave[a] for a in at], pa.int64())})


def _walk(group: pa.Table) -> pa.Table:
    """Reachable candidates of one split, from those that the chain enters it by."""
    at, succ, entry = (group.column(c).to_pylist() for c in ("at", "succ", "entry"))
    follow, real = dict(zip(at, succ)), set()
    for a in (a for a, e in zip(at, entry) if e):
        while a in follow and a not in real:
            real.add(a)
            a = follow[a]
    return group.select(["file", "n", "at", "size", "head", "length", "succ"]).filter(pa.array([a in real for a in at], pa.bool_()))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives under path: file, head (all headers), block (bytes)."""
    raw, placed = _pieces(spark, path)
    cands = placed.where(F.col("succ").isNotNull() & (F.col("at") >= 0))
    jumps = materialise(cands.select("file", "block", "at", "succ").groupBy("file", "block")
                        .applyInArrow(_shorten, "file string, at bigint, leave bigint"), "warc-jumps")
    splits = placed.groupBy("file").agg(F.count_distinct("block").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    reach = cands.where("at = 0").select("file", "at")
    for _ in range(math.ceil(math.log2(splits)) if splits > 1 else 0):
        ahead = reach.join(jumps, ["file", "at"]).select("file", F.col("leave").alias("at"))
        reach = materialise(reach.unionByName(ahead).distinct(), "warc-reach")
        then = jumps.select("file", F.col("at").alias("leave"), F.col("leave").alias("further"))
        jumps = materialise(jumps.join(then, ["file", "leave"], "left")
                            .select("file", "at", F.coalesce("further", "leave").alias("leave")), "warc-jumps")
    marked = cands.join(reach.withColumn("entry", F.lit(True)), ["file", "at"], "left")
    schema = "file string, n bigint, at bigint, size bigint, head int, length bigint, succ bigint"
    real = materialise(marked.select("file", "block", "n", "at", "size", "head", "length", "succ", F.coalesce("entry", F.lit(False)).alias("entry"))
                       .groupBy("file", "block").applyInArrow(_walk, schema), "warc-records")
    # records of one piece: all that parse as such but the rejected, whose list is short; payloads stay where they are
    whole = F.col("size") == F.col("head") + len(_END) + F.col("length") + len(_END)
    rejected = small(materialise(cands.select("file", "n").join(real, ["file", "n"], "left_anti"), "warc-rejected"), _SMALL_ROWS)
    alone = raw.where(whole).join(rejected, ["file", "n"], "left_anti").select("file", "raw", "head", "length")
    spans = small(materialise(real.where(~whole), "warc-spans"), _SMALL_ROWS).select(
        F.col("file").alias("f"), F.col("at").alias("a"), F.col("head").alias("h"), F.col("length").alias("l"), F.col("succ").alias("s"))
    inner = placed.select("file", "n", "at").join(spans, (F.col("file") == F.col("f")) & (F.col("at") >= F.col("a")) & (F.col("at") < F.col("s")))
    inner = small(materialise(inner.drop("f", "s"), "warc-inner"), _SMALL_ROWS)
    parts = raw.select("file", "n", "raw").join(inner, ["file", "n"]).groupBy("file", "a", "h", "l") \
        .agg(F.array_sort(F.collect_list(F.struct("at", "raw"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(None).cast("binary"),
                         lambda acc, p: F.when(acc.isNull(), p["raw"]).otherwise(F.concat(acc, F.lit(_MAGIC.encode()), p["raw"])))
    pieced = parts.select("file", joined.alias("raw"), F.col("h").alias("head"), F.col("l").alias("length"))
    return alone.unionByName(pieced).select(
        "file", F.substring("raw", F.lit(1), F.col("head")).cast("string").alias("head"),
        F.substring("raw", F.col("head") + len(_END) + 1, F.col("length").cast("int")).alias("block"))


def header(name: str) -> F.Column:
    """A header's value; null if it is not there."""
    value = F.regexp_extract(F.concat(F.lit("\r\n"), "head"), rf"(?i)\r\n{name}:[ \t]*([^\r\n]*)", 1)
    return F.when(value != "", F.trim(value))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: all pages archived and read back."""
    path = scratch_path(spark, f"llm/warc-{uuid.uuid4().hex}")
    write_archive(read_table(spark, sf_dir, "pages"), path)
    rows = read_archive(spark, path)
    page = lambda c: F.regexp_extract(header(c), r"<urn:page:(-?\d+)>", 1)
    number = lambda c: F.when(page(c) != "", page(c)).cast("long")
    revisit = header("WARC-Type") == "revisit"
    return rows.select(
        number("WARC-Record-ID").alias("page_id"),
        F.when(revisit, header("X-Payload-Length").cast("long")).otherwise(F.octet_length("block").cast("long")).alias("payload_bytes"),
        F.when(revisit, F.substring_index(header("WARC-Payload-Digest"), ":", -1)).otherwise(F.sha2("block", 256)).alias("payload_digest"),
        header("WARC-Type").alias("record_type"), number("WARC-Refers-To").alias("refers_to"))


SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, octet_length(encode(h)) AS n, sha256(h) AS digest, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= {MIN_PAYLOAD} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {MIN_PAYLOAD} AND page_id <> first THEN first END AS refers_to
FROM q
"""

QUERIES = {"op5_warc": (op5_warc, SQL)}
