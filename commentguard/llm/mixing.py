"""Mixing sources to target weights: a multivariate-hypergeometric splitting tree.

Every source gets a target number of words (weights 1, 2, 3, repeating over the sources in
code-point order; together 100 % of all words; at most 3 times the source, the excess shared
out again by weight). A source's documents are hashed into blocks of about ``block_words``
words. A target of r times its source is drawn as floor(r) passes over all blocks plus a
prefix of the blocks in permuted order, the last one cut at the document nearest to the
target. The exact block quotas of all sources are then split recursively among the output
shards: each tree node hands its left child a multivariate-hypergeometric draw of its
quotas, which yields per shard and source an exact count. A shard's blocks are consecutive
positions of the source's permuted block sequence, so shards draw disjoint blocks, and rows
are shuffled locally inside the shard by a seeded hash.

Work per row is native and local; only block totals (one row per ``block_words`` words) and
source totals are regrouped. A hot source just has more blocks.

Defined cases: a null or empty text has size 0 and is never drawn; a null source is a source
of its own, last in order; repeated rows are rows of their own and are drawn alike; an empty
table gives an empty mix; extra columns pass through untouched.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from commentguard.llm.common import materialise, own_columns, own_names, read_table, shown, small

BLOCK_WORDS = 50_000
SHARD_WORDS = 4_000_000
MAX_REPEAT = 3
WEIGHTS = (1, 2, 3)
_PRIME = 2_147_483_629  # larger than any number of blocks, so coprime to all of them
_PERM_ROWS = 1024
_SMALL_ROWS = 100_000


def word_count(text: str) -> F.Column:
    """Number of runs of anything but ASCII white space; null counts as 0."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size) -> with weight and target.

    Capped sources get cap * size, the others lam * weight. Going through the sources by
    cap * size / weight, the level that shares the rest among the later ones rises as long as
    a source must be capped and falls afterwards, so lam is its maximum.
    One row per source goes through one task.
    """
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    s = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                (F.row_number().over(everything) - 1) % len(weights) + 1))
    by_ratio = Window.orderBy(F.col("source_size") * cap / F.col("weight"), F.col("source").asc_nulls_last())
    below = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    above = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    rest = F.sum("source_size").over(whole) - cap * F.coalesce(F.sum("source_size").over(below), F.lit(0))
    s = s.withColumn("level", rest / F.sum("weight").over(above))
    s = s.withColumn("lam", F.max("level").over(whole))
    return s.select("source", "source_size", "weight",
                    F.least(F.col("source_size") * float(cap), F.col("lam") * F.col("weight")).alias("target"))


def _source_table(slim: DataFrame, block_words: int) -> DataFrame:
    """Per source: size, target, number of blocks, whole passes and the words of the partial pass."""
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    t = targets(sizes)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return t.select("source", "source_size", "target",
                    F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("long").alias("n_blocks"),
                    F.floor(ratio).cast("long").alias("passes"),
                    (F.col("target") - F.floor(ratio) * F.col("source_size")).alias("rest"))


def _position(seed: int, epoch: F.Column) -> F.Column:
    """Permuted position of a block in a pass: an affine bijection of 0 .. n_blocks-1."""
    shift = F.pmod(F.xxhash64(F.lit(seed), epoch, F.col("source")), F.col("n_blocks"))
    return F.pmod(F.col("block") * F.lit(_PRIME) + shift, F.col("n_blocks"))


def _with_block(rows: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """Rows joined to their source's line, with block number; ``sources`` is written and small-checked."""
    src = small(sources, _SMALL_ROWS).withColumnRenamed("source", "mix_source")
    return (rows.join(src, rows["source"].eqNullSafe(src["mix_source"]), "inner").drop("mix_source")
            .withColumn("block", F.pmod(F.xxhash64(F.lit(seed), F.col("mix_key")), F.col("n_blocks"))))


def _order(seed: int) -> F.Column:
    return F.xxhash64(F.lit(seed + 1), F.col("mix_key"))


def _split(shards: int, seed: int):
    """One tree node: hand the left half of its shards a multivariate-hypergeometric draw of its quotas."""

    def go(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi = int(pdf["lo"].iloc[0]), int(pdf["hi"].iloc[0])
        if hi - lo == 1:
            return pdf
        pdf = pdf.sort_values("source", na_position="last", kind="stable")
        quota = pdf["quota"].to_numpy(np.int64)
        mid = (lo + hi) // 2
        take = int(round(quota.sum() * (mid - lo) / (hi - lo)))
        rng = np.random.default_rng([seed, lo, hi])
        left = rng.multivariate_hypergeometric(quota, take, method="marginals") if take else np.zeros_like(quota)
        return pd.concat([pdf.assign(hi=mid, quota=left), pdf.assign(lo=mid, quota=quota - left)])

    return go


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(source, quota) -> (source, shard, quota): the splitting tree, one level per regrouping of a tiny table."""
    rows = quotas.select("source", F.lit(0).cast("long").alias("lo"), F.lit(shards).cast("long").alias("hi"),
                         F.col("quota").cast("long").alias("quota"))
    for _ in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        rows = rows.groupBy("lo", "hi").applyInPandas(_split(shards, seed), rows.schema)
    return rows.select("source", F.col("lo").cast("int").alias("shard"), "quota").where("quota > 0")


def _plan(slim: DataFrame, block_words: int, shard_words: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """From (source, size, mix_key) rows: the source table and, per drawn block, its copies.

    copies: array of (shard, pass, cutoff); with a cutoff only documents whose order hash is
    at most that are drawn.
    """
    sources = materialise(_source_table(slim, block_words), "mix-sources")
    blocked = _with_block(slim, sources, seed).where("size > 0")
    sums = (blocked.groupBy("source", "block")
            .agg(F.sum("size").alias("words"), F.first("n_blocks").alias("n_blocks"),
                 F.first("passes").alias("passes"), F.first("rest").alias("rest")))
    sums = materialise(sums.withColumn("pos", _position(seed, F.col("passes"))), "mix-blocks")
    # Words before a block in the order of the partial pass, over groups of positions first.
    group = F.floor(F.col("pos") / _PERM_ROWS)
    supers = sums.groupBy("source", group.alias("grp")).agg(F.sum("words").alias("grp_words"))
    before = Window.partitionBy("source").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    supers = supers.select(F.col("source").alias("s2"), F.col("grp").alias("g2"),
                           F.coalesce(F.sum("grp_words").over(before), F.lit(0)).alias("grp_before"))
    inside = Window.partitionBy("source", "grp").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    placed = (sums.withColumn("grp", group)
              .withColumn("in_before", F.coalesce(F.sum("words").over(inside), F.lit(0))))
    placed = (placed.join(supers, placed["source"].eqNullSafe(supers["s2"]) & (placed["grp"] == supers["g2"]))
              .withColumn("words_before", F.col("grp_before") + F.col("in_before"))
              .select("source", "block", "words", "n_blocks", "passes", "rest", "pos", "words_before"))
    drawn = placed.where(F.col("words_before") < F.col("rest"))
    partial = materialise(drawn, "mix-partial")
    # The block in which the target falls is cut at the document nearest to it (one block per source).
    edge = (partial.where(F.col("words_before") + F.col("words") > F.col("rest"))
            .select(F.col("source").alias("s3"), F.col("block").alias("b3"),
                    (F.col("rest") - F.col("words_before")).alias("room")))
    edge = small(edge, _SMALL_ROWS)
    order = Window.partitionBy("source", "block").orderBy("mix_order")
    cut = (blocked.withColumn("mix_order", _order(seed))
           .join(edge, blocked["source"].eqNullSafe(edge["s3"]) & (blocked["block"] == edge["b3"]))
           .withColumn("upto", F.sum("size").over(order)))  # equal hashes stand or fall together
    cut = (cut.where(F.col("upto") - F.col("size") / 2 <= F.col("room"))
           .groupBy("source", "block").agg(F.max("mix_order").alias("cutoff")))
    # Block instances: pass number and position; the quota of a source counts them.
    src_quota = sources.withColumnRenamed("source", "s4")
    tops = partial.groupBy("source").agg((F.max("pos") + 1).alias("tail"))
    quotas = (src_quota.join(tops, src_quota["s4"].eqNullSafe(tops["source"]), "left")
              .select(F.col("s4").alias("source"),
                      (F.col("passes") * F.col("n_blocks") + F.coalesce("tail", F.lit(0))).alias("quota")))
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    shards = max(1, math.ceil(total / shard_words))
    split = split_quotas(quotas, shards, seed)
    upto = Window.partitionBy("source").orderBy("shard")
    ranges = split.withColumn("stop", F.sum("quota").over(upto))
    slots = ranges.select(F.col("source").alias("s5"), "shard",
                          F.explode(F.sequence(F.col("stop") - F.col("quota"), F.col("stop") - 1)).alias("slot"))
    epochs = F.when(F.col("passes") > 0, F.sequence(F.lit(0).cast("long"), F.col("passes") - 1)) \
        .otherwise(F.array().cast("array<long>"))
    whole = (sums.select("source", "block", "n_blocks", F.explode(epochs).alias("epoch"))
             .withColumn("slot", F.col("epoch") * F.col("n_blocks") + _position(seed, F.col("epoch")))
             .select("source", "block", "epoch", "slot", F.lit(False).alias("edge")))
    tail = partial.select("source", "block", F.col("passes").alias("epoch"),
                          (F.col("passes") * F.col("n_blocks") + F.col("pos")).alias("slot"),
                          (F.col("words_before") + F.col("words") > F.col("rest")).alias("edge"))
    inst = whole.unionByName(tail)
    inst = inst.join(slots, inst["source"].eqNullSafe(slots["s5"]) & (inst["slot"] == slots["slot"])) \
        .select(inst["source"], "block", "epoch", "shard", "edge")
    cut = cut.select(F.col("source").alias("s6"), F.col("block").alias("b6"), "cutoff")
    inst = (inst.join(cut, inst["source"].eqNullSafe(cut["s6"]) & (inst["block"] == cut["b6"]), "left")
            .where(~F.col("edge") | F.col("cutoff").isNotNull())
            .withColumn("cutoff", F.when(F.col("edge"), F.col("cutoff"))))
    copies = inst.groupBy(F.col("source").alias("mix_source"), F.col("block").alias("mix_block")) \
        .agg(F.sort_array(F.collect_list(F.struct("shard", "epoch", "cutoff"))).alias("block_copies"))
    return sources, materialise(copies, "mix-copies")


def draw(rows: DataFrame, size: str, key: list[str], source: str = "source", block_words: int = BLOCK_WORDS,
         shard_words: int = SHARD_WORDS, seed: int = 17) -> DataFrame:
    """Add to each row mix_size, mix_source_size, mix_target and mix_copies, an array of (shard, epoch).

    ``size`` names an expression for a row's number of words, ``key`` the columns that tell
    rows apart (rows equal in them are drawn alike). No row is copied yet.
    """
    return shown(_draw(rows, size, key, source, block_words, shard_words, seed), rows.columns,
                 ["mix_size", "mix_source_size", "mix_target", "mix_copies"])


def _draw(rows: DataFrame, size: str, key: list[str], source: str, block_words: int, shard_words: int, seed: int) -> DataFrame:
    own = own_names(rows.columns)
    keyed = rows.select(*own_columns(rows.columns), F.expr(size).alias("mix_size"), F.xxhash64(*key).alias("mix_key"),
                        F.col(source).alias("mix_src"))
    slim = materialise(keyed.select(F.col("mix_src").alias("source"), F.col("mix_size").alias("size"), "mix_key"),
                       "mix-slim")
    sources, copies = _plan(slim, block_words, shard_words, seed)
    src = small(sources, _SMALL_ROWS).select(F.col("source").alias("mix_s1"), F.col("source_size").alias("mix_source_size"),
                                             F.col("target").alias("mix_target"), F.col("n_blocks").alias("mix_n"))
    out = keyed.join(src, keyed["mix_src"].eqNullSafe(src["mix_s1"]))
    out = out.withColumns({"mix_b": F.pmod(F.xxhash64(F.lit(seed), F.col("mix_key")), F.col("mix_n")),
                           "mix_order": _order(seed)})
    cop = small(copies, _SMALL_ROWS)
    out = out.join(cop, out["mix_src"].eqNullSafe(cop["mix_source"]) & (out["mix_b"] == cop["mix_block"]), "left")
    mine = F.filter(F.coalesce("block_copies", F.array().cast(copies.schema["block_copies"].dataType)),
                    lambda c: c["cutoff"].isNull() | (F.col("mix_order") <= c["cutoff"]))
    taken = F.when(F.col("mix_size") > 0, F.transform(mine, lambda c: F.struct(c["shard"], c["epoch"]))) \
        .otherwise(F.array().cast("array<struct<shard:int,epoch:bigint>>"))
    return out.select(*own, "mix_size", "mix_source_size", "mix_target", taken.alias("mix_copies"), "mix_order")


def mix(rows: DataFrame, size: str, key: list[str], source: str = "source", block_words: int = BLOCK_WORDS,
        shard_words: int = SHARD_WORDS, seed: int = 17) -> DataFrame:
    """The mixed rows: every drawn copy with its mix_shard, dealt to shards and shuffled inside each."""
    drawn = _draw(rows, size, key, source, block_words, shard_words, seed)
    each = drawn.withColumn("mix_copy", F.explode("mix_copies"))
    out = each.select(*own_names(rows.columns), F.col("mix_copy.shard").alias("mix_shard"),
                      F.xxhash64(F.lit(seed + 2), F.col("mix_order"), F.col("mix_copy.epoch")).alias("mix_rank"))
    out = out.repartition("mix_shard").sortWithinPartitions("mix_shard", "mix_rank")
    return shown(out, rows.columns, ["mix_shard"])


SIZE_EXPR = r"cast(coalesce(regexp_count(text, '[^\\x20\\x09-\\x0D]+'), 0) as bigint)"


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: all documents drawn to their sources' targets; taken counts repeats."""
    docs = read_table(spark, sf_dir, "documents")
    slim = materialise(docs.select("doc_id", "source", F.expr(SIZE_EXPR).alias("size"),
                                   F.xxhash64("doc_id", "text").alias("key")), "mix-documents")
    out = draw(slim, "size", ["key"])
    return out.select("doc_id", "source", "size", F.col("mix_source_size").alias("source_size"),
                      F.col("mix_target").alias("target"),
                      (F.col("size") * F.size("mix_copies")).cast("long").alias("taken"),
                      F.transform("mix_copies", lambda c: c["shard"]).alias("shards"))


QUERIES = {"op1_mix_sources": (op1_mix_sources, None)}
