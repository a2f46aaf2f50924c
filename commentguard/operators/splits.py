"""Shuffles, samples and splits (F6-F9), all keyed on a hash of the row id.

Hash-based assignment is independent of partitioning and of task retries,
unlike ``randomSplit`` / ``rand``, so a split is stable under repartition and
executor loss.
"""

from __future__ import annotations

import uuid
from itertools import combinations
from math import floor

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab as V
from ..session import scratch_path
from ..sizing import BROADCAST_BYTES, fits


def id_hash(id_col: str, seed: int = V.SPLIT_SEED) -> Column:
    """sha-256 hex of "id|seed"."""
    return F.sha2(F.concat_ws("|", F.col(id_col).cast("string"), F.lit(str(seed))), 256)


def shuffle_rows(df: DataFrame, id_col: str = "id", seed: int = V.SPLIT_SEED) -> DataFrame:
    """deterministic full shuffle (order by a seeded 64-bit hash, ties by id)."""
    return df.orderBy(F.xxhash64(F.col(id_col), F.lit(seed)), F.col(id_col))


def sample_n(df: DataFrame, n: int, id_col: str = "id", seed: int = V.SPLIT_SEED) -> DataFrame:
    """n rows without replacement (all rows when n >= count), by seeded hash order."""
    return df.orderBy(id_hash(id_col, seed), F.col(id_col)).limit(n)


def cut_hex(share: float) -> str:
    """4-hex-digit cut: hash prefixes below it make up ``share`` of the space."""
    return format(int(round(share * 65536)), "04x") if share < 1 else "g"


def split_flag(id_col: str = "id", train_share: float = 0.8, seed: int = V.SPLIT_SEED) -> Column:
    """F8: True for the training side; compares the hash's first 4 hex digits to a cut."""
    return F.substring(id_hash(id_col, seed), 1, 4) < F.lit(cut_hex(train_share))


def split(df: DataFrame, id_col: str = "id", train_share: float = 0.8, seed: int = V.SPLIT_SEED) -> DataFrame:
    """F8: adds ``split`` = 'train' | 'test'."""
    return df.withColumn("split", F.when(split_flag(id_col, train_share, seed), "train").otherwise("test"))


def stratified_split(df: DataFrame, label_bits: str = "truth", id_col: str = "id",
                     shares: tuple[float, float] = (0.8, 0.1), seed: int = V.SPLIT_SEED,
                     label_freq: DataFrame | None = None) -> DataFrame:
    """multi-label stratified train/dev/test split.

    Stratum of a row = its rarest positive label (global label frequency,
    ties by lower index; -1 for rows without labels). Inside a stratum rows
    are ranked by seeded hash; rank share < 0.8 -> train, < 0.9 -> dev, else
    test. The per-stratum rank is a window partitioned by stratum; strata are
    label indices (<= 20), so a hot stratum is split by hash range first:
    rows are ranked inside (stratum, hash prefix) sub-partitions and the
    counts of earlier sub-partitions are added back.
    """
    if label_freq is None:
        long = df.select(F.posexplode(F.col(label_bits)).alias("idx", "y")).filter(F.col("y") == 1)
        label_freq = long.groupBy("idx").agg(F.count(F.lit(1)).alias("freq"))
    # one row per label position, as many as a row's array is long
    ranks = {r["idx"]: k for k, r in enumerate(label_freq.orderBy("freq", "idx").select("idx").collect())}
    by_rarity = F.array(*[F.lit(i) for i in ranks]).cast("array<int>")
    mine = F.filter(by_rarity, lambda i: F.get(F.col(label_bits), i) == 1)
    rows = df.withColumn("stratum", F.coalesce(F.get(mine, F.lit(0)), F.lit(-1)))
    ranked = _ranked(rows, "stratum", id_col, seed)
    pos = (F.col("__off") + F.col("__r") - 1) / F.col("__n")
    a, b = round(shares[0], 12), round(shares[0] + shares[1], 12)
    return ranked.withColumn("split", F.when(pos < a, "train").when(pos < b, "dev").otherwise("test")) \
        .drop("__h", "__sub", "__r", "__off", "__n")


def _ranked(rows: DataFrame, stratum: str, id_col: str, seed: int) -> DataFrame:
    """Rows with ``__off`` + ``__r`` - 1, their rank by seeded hash inside the stratum, and ``__n``, its rows.

    A hot stratum is ranked inside 4,096 hash ranges; the counts of its earlier ranges are added.
    """
    h = id_hash(id_col, seed)
    rows = rows.withColumn("__h", h).withColumn("__sub", F.substring(h, 1, 3))
    sub_counts = rows.groupBy(stratum, "__sub").agg(F.count(F.lit(1)).alias("__c"))
    w_off = Window.partitionBy(stratum).orderBy("__sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sub_counts.select(stratum, "__sub",
                                F.coalesce(F.sum("__c").over(w_off), F.lit(0)).alias("__off"),
                                F.sum("__c").over(Window.partitionBy(stratum)).alias("__n"))
    ranked = rows.withColumn("__r", F.row_number().over(Window.partitionBy(stratum, "__sub").orderBy("__h", id_col)))
    return ranked.join(offsets, [stratum, "__sub"])


def plan_splits(sets: dict[tuple[int, ...], int], shares: tuple[float, ...]) -> dict[tuple[int, ...], list[int]]:
    """Rows of each label set that go to each split, by iterative stratification of second order.

    The rarest label or pair of labels among the sets not yet dealt is taken first (ties: the single
    label, then the lower labels). Each of its sets, the largest first, gives every split the whole
    rows of its share; the few rows left over go one by one to the split that lacks most, summed over
    the set's labels, its pairs and all rows (ties: the first split). What a split lacks is its share of
    the rows dealt with so far less the rows it got: counted against all rows, rare pairs would each
    round to the largest split, and their labels with them. Sets without labels come last.
    """
    items = sorted({i for s in sets for i in [(x,) for x in s] + list(combinations(s, 2))}, key=lambda i: (len(i), i))
    number = {item: k for k, item in enumerate(items)}
    own = {s: np.array([number[i] for i in [(x,) for x in s] + list(combinations(s, 2))], int) for s in sets}
    holders: list[list[tuple[int, ...]]] = [[] for _ in items]
    left = np.zeros(len(items), np.int64)
    for s, n in sorted(sets.items(), key=lambda kv: (-kv[1], kv[0])):
        left[own[s]] += n
        for k in own[s]:
            holders[k].append(s)
    part = np.array(shares)
    lacking, total = np.zeros((len(part), len(items))), np.zeros(len(part))
    plan: dict[tuple[int, ...], list[int]] = {}

    def deal(s: tuple[int, ...]) -> None:
        n, mine = sets[s], own[s]
        given = np.array([floor(round(n * x, 9)) for x in shares])
        lacking[:, mine] += (part * n - given)[:, None]
        np.add(total, part * n - given, out=total)
        for _ in range(n - int(given.sum())):
            k = int(np.argmax(np.round(lacking[:, mine].sum(1) + total, 6)))
            given[k] += 1
            lacking[k, mine] -= 1
            total[k] -= 1
        left[mine] -= n
        plan[s] = given.tolist()

    while (left > 0).any():
        item = int(np.where(left > 0, left, np.iinfo(np.int64).max).argmin())
        for s in holders[item]:
            if s not in plan:
                deal(s)
    for s in sorted(set(sets) - set(plan)):
        deal(s)
    return plan


def iterative_split(df: DataFrame, label_bits: str = "truth", id_col: str = "id",
                    shares: tuple[float, float] = (0.8, 0.1), seed: int = V.SPLIT_SEED, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """train/dev/test split by iterative stratification; adds ``label_set`` and ``split``.

    Rows are counted by label set (sorted label positions, joined by commas; a null array or element
    carries no label), the counts are dealt by ``plan_splits``, and only then do the rows take part:
    the rank by seeded hash inside the set decides. Where the sets themselves are not proven to be
    within ``max_bytes``, a row's set is its two rarest labels, of which there are few. Repeated
    ids are rows each; an empty table stays empty.
    """
    spark = df.sparkSession
    carried = F.filter(F.transform(F.col(label_bits), lambda y, i: F.when(y == 1, i)), lambda i: i.isNotNull())
    labels = F.coalesce(carried, F.array().cast("array<int>"))

    def counted(key: Column) -> DataFrame:
        path = scratch_path(spark, f"label-sets-{uuid.uuid4().hex}")
        df.select(key.alias("label_set")).groupBy("label_set").agg(F.count(F.lit(1)).alias("n")).write.parquet(path)
        return spark.read.parquet(path)

    key = F.array_join(labels, ",")
    sets = counted(key)
    if not fits(sets, max_bytes=max_bytes):
        freq = df.select(F.explode(labels).alias("i")).groupBy("i").agg(F.count(F.lit(1)).alias("f")).orderBy("f", "i").collect()  # a row per label
        rarest = F.array_intersect(F.array(*[F.lit(r["i"]) for r in freq]), labels)
        key = F.array_join(F.array_sort(F.slice(rarest, 1, 2)), ",")
        sets = counted(key)
    found = {tuple(map(int, filter(None, r["label_set"].split(",")))): r["n"] for r in sets.collect()}
    plan = plan_splits(found, (*shares, max(0.0, 1 - sum(shares))))
    cuts = spark.createDataFrame([(",".join(map(str, s)), given[0], given[0] + given[1]) for s, given in plan.items()],
                                 "label_set string, __train bigint, __dev bigint")
    ranked = _ranked(df.withColumn("label_set", key), "label_set", id_col, seed).join(F.broadcast(cuts), "label_set")
    rank = F.col("__off") + F.col("__r") - 1
    split_of = F.when(rank < F.col("__train"), "train").when(rank < F.col("__dev"), "dev").otherwise("test")
    return ranked.select(*[F.col(f"`{c}`") for c in df.columns], "label_set", split_of.alias("split"))


def split_drift(split_df: DataFrame, label_bits: str = "truth") -> DataFrame:
    """F9 report: per split and label, the share of rows carrying the label."""
    z = F.posexplode(F.col(label_bits))
    long = split_df.select("split", z.alias("idx", "y"))
    return long.groupBy("split", "idx").agg(F.avg(F.col("y").cast("double")).alias("share"))
