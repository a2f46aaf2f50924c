"""N-gram Jaccard self-join of texts with Bayesian candidate pruning.

Texts are sets of word 5-grams (words: runs of letters, digits and non-ASCII characters,
A-Z lower-cased; a text of one to four words is one gram). Equal sets form one class, and
only classes are compared. A class has ``HASHES`` MinHash values of a byte each; bands of
``ROWS`` of them make bucket keys (a pair of similarity 0.8 shares no band with probability
below 1e-6). Buckets with the same members are worked on once.

Inside a bucket, pairs are compared incrementally, ``STEP`` values at a time: with a uniform
prior the posterior probability of reaching the threshold, given the matches so far, is
looked up, and pairs for which it falls below ``TOLERANCE`` are dropped. The others are
verified exactly on their gram sets, by integer arithmetic. A pair that shares several
buckets is worked on in that of its first common band only.

Large buckets are cut into parts of about ``PART`` classes; each pair of parts is a group of
its own, so no group grows with the bucket. Tasks return link counts and a spanning forest of
the links they found, never the pairs. Gram sets are only built for classes in buckets.

Defined cases: null and empty texts (no words) link with nothing and are classes of their own;
repeated rows, equal texts and texts with equal gram sets are linked; a null id is never a
class id unless all ids of the class are null; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commentguard.llm.common import ALNUM, PART_BYTES, Words, materialise, mix64, own_columns, read_table, row_slices, shown, small, windows
from commentguard.llm.components import components

GRAM = 5
THRESHOLD = (4, 5)  # 0.8 as a fraction
ROWS, BANDS = 5, 36
HASHES = ROWS * BANDS
STEP = 20
TOLERANCE = 1e-7
PART = 768
_SMALL_ROWS = 200_000

_seed = mix64(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))
_XOR = (_seed[:HASHES] >> np.uint64(32)).astype(np.uint32)
_MUL = (_seed[HASHES:] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def gram_sets(w: Words, n: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Distinct gram hashes (48 bits) of each row, row by row in order, and row offsets into them."""
    rows = len(w.off) - 1
    count = w.counts()
    win = windows(w.hash, n)
    at = np.arange(len(win))
    row = np.searchsorted(w.row, at, "right") - 1
    inside = at + n <= w.row[row + 1]
    parts, owner = [win[inside]], [row[inside]]
    with np.errstate(over="ignore"):
        for k in range(1, n):  # texts shorter than a gram
            short = np.flatnonzero(count == k)
            if len(short):
                h = np.full(len(short), k, np.uint64)
                for j in range(k):
                    h = h * np.uint64(0x9DDFEA08EB382D69) + w.hash[w.row[short] + j]
                parts.append(mix64(h))
                owner.append(short)
    key = np.concatenate(owner).astype(np.uint64) << np.uint64(48) | np.concatenate(parts) >> np.uint64(16)
    key.sort()
    if len(key):
        key = key[np.append(True, key[1:] != key[:-1])]
    return key & np.uint64((1 << 48) - 1), np.searchsorted(key >> np.uint64(48), np.arange(rows + 1).astype(np.uint64))


def _slices(batches, column: str):
    for batch in batches:
        for at in range(0, batch.num_rows, 1 << 15):
            yield from row_slices(batch.slice(at, 1 << 15), column, PART_BYTES)


def _set_keys(grams: np.ndarray, off: np.ndarray) -> np.ndarray:
    """128-bit key of each non-empty set, as rows of two uint64."""
    full = np.flatnonzero(np.diff(off))
    out = np.zeros((len(off) - 1, 2), np.uint64)
    if len(full):
        n = np.diff(off)[full].astype(np.uint64)
        for k, salt in enumerate((0x51ED270B, 0xB492B66F)):
            out[full, k] = mix64(np.add.reduceat(mix64(grams ^ np.uint64(salt << 16)), off[full]) + n)
    return out


def _sketch(batches):
    for part in _slices(batches, "text"):
        grams, off = gram_sets(Words(part.column("text"), ALNUM))
        keys = _set_keys(grams, off)
        n = np.diff(off)
        full = np.flatnonzero(n)
        code = np.zeros((len(n), HASHES), np.uint8)
        if len(full):
            x = (mix64(grams) >> np.uint64(32)).astype(np.uint32)
            for k in range(HASHES):
                low = np.minimum.reduceat((x ^ _XOR[k]) * _MUL[k], off[full])
                code[full, k] = (low * np.uint32(0x9E3779B1)) >> np.uint32(24)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("tkey"), pa.array([k.tobytes() if m else None for k, m in zip(keys, n)], pa.binary()),
             pa.array(n.astype(np.int32)), pa.array([c.tobytes() if m else None for c, m in zip(code, n)], pa.binary())],
            ["doc_id", "tkey", "node", "n", "code"])


def _gram_blobs(batches):
    for part in _slices(batches, "text"):
        grams, off = gram_sets(Words(part.column("text"), ALNUM))
        keys = _set_keys(grams, off)
        yield pa.RecordBatch.from_arrays([pa.array([k.tobytes() for k in keys], pa.binary()),
                                          pa.array([grams[a:b].tobytes() for a, b in zip(off[:-1], off[1:])], pa.binary())], ["node", "grams"])


def prune_table(threshold: float, hashes: int, step: int, tolerance: float) -> np.ndarray:
    """Fewest matches after step, 2*step, ... values for which the posterior of reaching the threshold is at least the tolerance."""
    j = (np.arange(20_000) + 0.5) / 20_000
    p = j + (1 - j) / 256  # a byte also agrees by chance
    log_p, log_q = np.log(p), np.log1p(-p)
    least = []
    for n in range(step, hashes + 1, step):
        for m in range(n + 1):  # one row after another: every worker that loads this module makes the table
            like = m * log_p + (n - m) * log_q
            like = np.exp(like - like.max())
            if like[j >= threshold].sum() / like.sum() >= tolerance:
                break
        else:
            m = 0
        least.append(m)
    return np.array(least)


_LEAST = prune_table(THRESHOLD[0] / THRESHOLD[1], HASHES, STEP, TOLERANCE)


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of incidence blocks."""
    n = len(sets)
    of = np.repeat(np.arange(n), [len(s) for s in sets])
    values, col, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = count > 1
    place = np.cumsum(often) - 1
    keep = often[col]
    col, of = place[col[keep]], of[keep]
    order = np.argsort(col, kind="stable")
    col, of = col[order], of[order]
    out = np.zeros((n, n), np.float32)
    width = 4096
    cuts = np.searchsorted(col, np.arange(0, int(often.sum()) + width, width))
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        if b > a:
            block = np.zeros((n, width), np.float32)
            block[of[a:b], col[a:b] - k * width] = 1
            out += block @ block.T
    return out.astype(np.int64)


def _compare(group: pa.Table) -> pa.Table:
    """Pairs of one group (a bucket, or two parts of one): links per class and a spanning forest."""
    own, i, j = group.column("bands")[0].as_py(), group.column("i")[0].as_py(), group.column("j")[0].as_py()
    node = group.column("node").to_pylist()
    part = group.column("part").to_numpy()
    weight = group.column("weight").to_numpy()
    codes = group.column("code").combine_chunks()
    code = np.frombuffer(b"".join(codes.to_pylist()), np.uint8).reshape(len(node), HASHES)
    a, b = np.triu_indices(len(node), 1)
    if i != j:
        cross = part[a] != part[b]
        a, b = a[cross], b[cross]
    match = np.zeros(len(a), np.int32)
    first = np.full(len(a), BANDS, np.int32)
    for k in range(HASHES // STEP):
        at = slice(k * STEP, (k + 1) * STEP)
        same = np.zeros((len(a), STEP), bool)
        for s in range(0, len(a), 1 << 16):
            same[s:s + (1 << 16)] = code[a[s:s + (1 << 16)], at] == code[b[s:s + (1 << 16)], at]
        match += same.sum(1, dtype=np.int32)
        band = same.reshape(len(a), STEP // ROWS, ROWS).all(2)
        hit = band.any(1) & (first == BANDS)
        first[hit] = k * (STEP // ROWS) + band[hit].argmax(1)
        # a common band elsewhere than here: another bucket's pair
        keep = (match >= _LEAST[k]) & ((first == BANDS) | np.isin(first, own))
        a, b, match, first = a[keep], b[keep], match[keep], first[keep]
    links, roots = np.zeros(len(node), np.int64), list(range(len(node)))
    if len(a):
        used = np.unique(np.concatenate([a, b]))
        place = np.zeros(len(node), np.int64)
        place[used] = np.arange(len(used))
        blobs = group.column("grams").combine_chunks().take(pa.array(used)).to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in blobs]
        size = np.array([len(s) for s in sets])
        both = _shared(sets)[place[a], place[b]]
        ok = both * THRESHOLD[1] >= (size[place[a]] + size[place[b]] - both) * THRESHOLD[0]
        a, b = a[ok], b[ok]
        np.add.at(links, a, weight[b])
        np.add.at(links, b, weight[a])

        def find(x: int) -> int:
            while roots[x] != x:
                roots[x] = roots[roots[x]]
                x = roots[x]
            return x

        for x, y in zip(a.tolist(), b.tolist()):
            x, y = find(x), find(y)
            if x != y:
                roots[max(x, y)] = min(x, y)
    hit = np.flatnonzero(links)
    return pa.table({"node": pa.array([node[x] for x in hit], pa.binary()),
                     "root": pa.array([node[find(x)] for x in hit] if len(hit) else [], pa.binary()),
                     "links": pa.array(links[hit])})


def similar_classes(docs: DataFrame, id_col: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): rows (doc_id, tkey, node, n) of all documents, node null without words;
    classes (node, root, weight, links) with root the component."""
    tkey = F.xxhash64(F.col(text), F.lit(1))
    rows = materialise(docs.select(F.col(id_col).alias("doc_id"), tkey.alias("tkey"), F.col(text).alias("text"))
                       .mapInArrow(_sketch, f"doc_id {docs.schema[id_col].dataType.simpleString()}, tkey bigint, node binary, n int, code binary"),
                       "ngram-rows")
    some = rows.where("n > 0")
    classes = materialise(some.groupBy("node").agg(
        F.count(F.lit(1)).alias("weight"), F.first("code").alias("code"),
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "tkey")).alias("rep")), "ngram-classes")
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.struct(
        b.alias("band"), F.xxhash64(b, F.expr("node").isNull(), F.substr("code", b * ROWS + 1, F.lit(ROWS))).alias("bucket")))
    keys = classes.select("node", F.explode(bands).alias("k")).select("node", "k.band", "k.bucket")
    buckets = (keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("band").alias("band"),
                                          F.bit_xor(F.xxhash64("node")).alias("x"), F.sum(F.xxhash64(F.lit(3), "node") % (1 << 40)).alias("y"))
               .where("size > 1"))
    buckets = materialise(buckets.groupBy("x", "y", "size").agg(F.min("bucket").alias("bucket"), F.sort_array(F.collect_set("band")).alias("bands"))
                          .select("bucket", "size", "bands"), "ngram-buckets")
    members = materialise(keys.select("node", "bucket").join(small(buckets, _SMALL_ROWS), "bucket"), "ngram-members")
    needed = members.select("node").distinct().join(classes, "node").select("rep.doc_id", "rep.tkey")
    needed = small(materialise(needed, "ngram-needed"), _SMALL_ROWS).select(F.col("doc_id").alias("d2"), F.col("tkey").alias("t2"))
    texts = docs.select(F.col(id_col).alias("doc_id"), tkey.alias("tkey"), F.col(text).alias("text"))
    texts = texts.join(needed, texts["doc_id"].eqNullSafe(needed["d2"]) & (texts["tkey"] == needed["t2"]), "left_semi")
    grams = texts.select("text").mapInArrow(_gram_blobs, "node binary, grams binary").groupBy("node").agg(F.first("grams").alias("grams"))
    parts = F.ceil(F.col("size") / PART).cast("int")
    dealt = (members.withColumn("part", F.pmod(F.xxhash64(F.lit(5), "node"), parts).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
             .withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other")}))
    full = dealt.join(classes.select("node", "weight", "code"), "node").join(grams, "node")
    found = materialise(full.select("bucket", "i", "j", "bands", "part", "node", "weight", "code", "grams")
                        .groupBy("bucket", "i", "j").applyInArrow(_compare, "node binary, root binary, links bigint"), "ngram-links")
    roots = components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")), "ngram-components")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    out = classes.select("node", "weight").join(links, "node", "left").join(roots, "node", "left")
    return rows.select("doc_id", "tkey", "node", "n"), materialise(out.select(
        "node", F.coalesce("root", "node").alias("root"), "weight", F.coalesce("links", F.lit(0)).alias("links")), "ngram-result")


def _with_class(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows with root, n_links and the component's least (unnamed, doc_id, tkey)."""
    named = rows.where("n > 0").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "tkey")).alias("low"))
    lows = classes.join(named, "node").groupBy("root").agg(F.min("low").alias("low"))
    known = classes.join(lows, "root").select("node", "low", (F.col("weight") - 1 + F.col("links")).alias("n_links"))
    return rows.join(known, "node", "left")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id (least id of those reachable by links), n_links (documents linked
    directly, copies included), n_grams, kept (it names its class)."""
    rows, classes = similar_classes(docs, id_col, text)
    class_id = F.when(F.col("n") > 0, F.col("low.doc_id")).otherwise(F.col("doc_id"))
    return _with_class(rows, classes).select(
        "doc_id", class_id.alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.col("n").cast("long").alias("n_grams"), F.col("doc_id").eqNullSafe(class_id).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs with one row of each class: that with the least id (nulls last), then text hash.

    Texts are not shuffled while the rows to drop are few enough to broadcast.
    """
    rows, classes = similar_classes(docs, id_col, text)
    marked = _with_class(rows, classes).withColumn("mine", F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "tkey"))
    keys = marked.where("n > 0").groupBy("doc_id", "tkey").agg(F.max(F.col("mine") == F.col("low")).alias("stays"), F.count(F.lit(1)).alias("copies"))
    keys = small(materialise(keys.where("not stays or copies > 1"), "ngram-dropped"), _SMALL_ROWS)
    own = docs.select(*own_columns(docs.columns), F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text), F.lit(1)).alias("tkey"))
    keys = keys.select(F.col("doc_id").alias("d2"), F.col("tkey").alias("t2"), "stays")
    on = own["doc_id"].eqNullSafe(keys["d2"]) & (own["tkey"] == keys["t2"])
    alone = shown(own.join(keys, on, "left_anti"), docs.columns, [])
    # rows that repeat id and text: one of them stays
    twins = keys.where("stays")
    if not twins.take(1):
        return alone
    twins = own.join(twins, own["doc_id"].eqNullSafe(twins["d2"]) & (own["tkey"] == twins["t2"]), "left_semi")
    return alone.unionByName(shown(twins.dropDuplicates(["doc_id", "tkey"]), docs.columns, []))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: near-duplicate classes of all documents."""
    return jaccard_join(read_table(spark, sf_dir, "documents"))


_TEXT_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
               r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_TEXT_WORDS} AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + {GRAM - 1}], ' ') AS gram FROM
      (SELECT doc_id, ws, unnest(range(1, greatest(1, len(ws) - {GRAM - 1}) + 1)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
s AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM g x JOIN g y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM s JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE common * {THRESHOLD[1]} >= (p.n + q.n - common) * {THRESHOLD[0]}),
r AS (SELECT doc_id AS node, doc_id AS seen FROM d UNION SELECT e.b, r.seen FROM r JOIN e ON e.a = r.node),
c AS (SELECT node, min(seen) AS class_id FROM r GROUP BY node),
l AS (SELECT a, count(*) AS n_links FROM e GROUP BY a)
SELECT d.doc_id, class_id, coalesce(n_links, 0) AS n_links, coalesce(n.n, 0) AS n_grams, d.doc_id = class_id AS kept
FROM d JOIN c ON c.node = d.doc_id LEFT JOIN l ON l.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

QUERIES = {"op8_ngram_join": (op8_ngram_join, SQL)}
