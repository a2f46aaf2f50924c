"""Spelling variant grouping by a trie-node pair dictionary.

Every prefix of a word is a node of the trie of all words, every suffix one of the trie of the
reversed words. Nodes are numbered, so that a word with position k left out is the pair of whole
numbers (node of what comes before, node of what comes after), however long the word is:

    skip k:  (prefix up to k, suffix after k)      a word without its k-th code point
    gap k:   (prefix up to k, suffix from k on)    a word as it is, cut before its k-th code point

Two words share a skip pair just if they differ by a replacement there; one's skip pair is the
other's gap pair just if it has one code point more there. No string is compared and nothing has
to be verified. Where a code point repeats in a run, leaving out any of the run gives the same
word; only the first one is joined with gaps, so every pair of near words meets under exactly one
key and neighbours are counted by plain sums. The words under a key differ in one code point only,
so a key has at most as many words as the alphabet has letters, and one gap: no key can grow with
the corpus, and no pairs are written, only each word's number of neighbours there and the most
frequent one.

Numbering is by sorted parts of the vocabulary: words are range-partitioned, and a part walks its
sorted words, a word sharing the nodes of its common prefix with the one before. Prefixes that
go on over the border of two parts are numbered first, from the parts' first and last words.

Words are counted natively with map-side aggregation, so a word that makes up a third of all rows
is one row per task before the shuffle. Roots are found by pointer doubling: a word's form occurs
at least ``ratio`` times as often, so chains are short and have no cycles.

Defined cases: null and empty texts have no words; a null id is the empty string in the rule that
drops code points (it is a test of the contract, ``dropped`` can be turned off); repeated rows
count one by one; ties between near words equally frequent go to the smaller in code-point order;
very long words take one row per position; an empty table gives an empty result; extra columns are
not read.
"""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commentguard.llm.common import materialise, read_table

MIN_CHARS = 6
MIN_COUNT = 5
RATIO = 5
DROP_EVERY = 199
RUN = r"[A-Za-zÀ-ÿ]+"
PART_WORDS = 100_000  # words of a sorted part, all in one task's memory
_PART_BITS = 40


def _dropped(run: Column, id_col: Column) -> Column:
    """The run without the code point at crc % length, where the crc32 of '<id>:<run>' is a multiple of DROP_EVERY."""
    crc = F.crc32(F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (crc % F.char_length(run)).cast("int")
    rest = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(crc % DROP_EVERY == 0, rest).otherwise(run)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
               dropped: bool = True) -> DataFrame:
    """(word, n): words of the whole texts, lower-cased in A-Z only, that are long and frequent enough."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    runs = docs.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(F.col(text_col), F.lit(RUN), 0)).alias("run")) \
        .where(F.char_length("run") >= min_chars).select("id", F.translate("run", upper, upper.lower()).alias("run"))
    word = _dropped(F.col("run"), F.col("id")) if dropped else F.col("run")
    return runs.select(word.alias("word")).where(F.char_length("word") >= min_chars) \
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _common(a: str, b: str) -> int:
    return len(os.path.commonprefix([a, b]))


def _walk(words: list[str], known: list[tuple[str, list[int]]], base: int) -> list[np.ndarray]:
    """Node numbers of all prefixes (the empty one is 0) of sorted words; ``known`` prefixes have their numbers already."""
    out, before, nodes, nxt = [], "", [0], base
    for w in words:
        same = _common(before, w)
        nodes = nodes[:same + 1]
        for prefix, numbers in known:
            c = _common(prefix, w)
            if c >= len(nodes):
                nodes = numbers[:c + 1]
        new = len(w) + 1 - len(nodes)
        nodes = nodes + list(range(nxt, nxt + new))
        nxt += new
        before = w
        out.append(np.array(nodes, np.int64))
    return out


def trie_nodes(words: DataFrame, name: str, part_words: int = PART_WORDS) -> DataFrame:
    """(wid, nodes, heads) of (wid, key): numbers of the trie nodes of every prefix of the keys, shortest first (equal
    prefixes have equal numbers), and which code points are the first of a run of equal ones."""
    parts = max(1, -(-words.count() // part_words))
    sorted_ = words.repartitionByRange(parts, "key").select("wid", "key", F.spark_partition_id().alias("part"))
    sorted_ = materialise(sorted_, f"{name}-sorted")
    ends = sorted_.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last")).orderBy("part").collect()  # one row per part
    shared = {r["part"]: [] for r in ends}
    before, numbers, nxt = "", [0], 1
    for a, b in zip(ends, ends[1:]):
        prefix = b["first"][:_common(a["last"], b["first"])]
        numbers = numbers[:_common(before, prefix) + 1]
        fresh = len(prefix) + 1 - len(numbers)
        numbers, nxt, before = numbers + list(range(nxt, nxt + fresh)), nxt + fresh, prefix
        shared[a["part"]].append((prefix, numbers))
        shared[b["part"]].append((prefix, numbers))
    borders = words.sparkSession.sparkContext.broadcast(shared)

    def number(rows: pd.DataFrame) -> pd.DataFrame:
        # Python's order of strings is by code point, as is Spark's of their UTF-8
        rows = rows.sort_values("key")
        keys = rows["key"].tolist()
        nodes = _walk(keys, borders.value[int(rows["part"].iloc[0])], (int(rows["part"].iloc[0]) + 1) << _PART_BITS)
        heads = [[k == 0 or w[k] != w[k - 1] for k in range(len(w))] for w in keys]
        return pd.DataFrame({"wid": rows["wid"].to_numpy(), "nodes": nodes, "heads": heads})

    return sorted_.groupBy("part").applyInPandas(number, "wid long, nodes array<long>, heads array<boolean>")


def numbered(words: DataFrame, name: str, part_words: int = PART_WORDS) -> DataFrame:
    """(word, n, wid): wid grows with the word in code-point order."""
    parts = max(1, -(-words.count() // part_words))
    return materialise(words.repartitionByRange(parts, "word").sortWithinPartitions("word")
                       .select("word", "n", F.monotonically_increasing_id().alias("wid")), name)


def neighbours(words: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """(wid, n_near, near_n, near_wid) of (word, n, wid): how many words are one insertion, deletion or replacement
    away, and the most frequent of them (the smaller wid on ties). Words without a neighbour have no row."""
    fore = trie_nodes(words.select("wid", F.col("word").alias("key")), "op13-fore", part_words)
    back = trie_nodes(words.select("wid", F.reverse("word").alias("key")), "op13-back", part_words).select("wid", F.col("nodes").alias("tails"))
    both = words.join(fore, "wid").join(back, "wid")
    size = F.size("nodes") - 1
    spot = F.posexplode(F.transform("nodes", lambda p, k: F.struct(
        p.alias("p"), F.get("tails", size - k).alias("gap"), F.get("tails", size - k - 1).alias("skip"), F.get("heads", k).alias("head"))))
    spots = both.select("wid", "n", size.alias("size"), spot.alias("k", "s")).select("wid", "n", "size", "k", "s.*")
    kinds = F.array(F.struct(F.lit(False).alias("skipped"), F.col("gap").alias("s"), F.lit(False).alias("head")),
                    F.struct((F.col("k") < F.col("size")).alias("skipped"), F.col("skip").alias("s"), F.col("head")))
    pairs = spots.select("wid", "n", "p", "k", "size", F.posexplode(kinds).alias("kind", "x")).where("kind = 0 or k < size") \
        .select("p", F.col("x.s").alias("s"), F.struct(F.col("x.skipped").alias("skipped"), F.col("x.head").alias("head"),
                                                       F.col("n").alias("n"), F.col("wid").alias("wid")).alias("m"))
    groups = pairs.groupBy("p", "s").agg(F.collect_list("m").alias("m")).where(F.size("m") > 1)
    # of a word left out somewhere: the others left out there, and the whole word if it is the first of its run; of the
    # whole word: those that are left out at the first of a run
    near = groups.select(F.col("m"), F.explode("m").alias("own"))
    near = near.select("own", F.filter("m", lambda o: (o["wid"] != F.col("own.wid")) & F.when(
        F.col("own.skipped"), o["skipped"] | F.col("own.head")).otherwise(o["head"])).alias("others")).where(F.size("others") > 0)
    best = F.array_max(F.transform("others", lambda o: F.struct(o["n"].alias("n"), (-o["wid"]).alias("minus"))))
    per = near.select(F.col("own.wid").alias("wid"), F.size("others").cast("long").alias("n_near"), best.alias("best"))
    return per.groupBy("wid").agg(F.sum("n_near").alias("n_near"), F.max("best").alias("best")) \
        .select("wid", "n_near", F.col("best.n").alias("near_n"), (-F.col("best.minus")).alias("near_wid"))


def roots(links: DataFrame, name: str = "roots") -> DataFrame:
    """(wid, root) of (wid, form), form null at the end of a chain: pointers doubled until none moves."""
    now = materialise(links.select("wid", F.coalesce("form", "wid").alias("root")), name)
    while True:
        up = now.select(F.col("wid").alias("root"), F.col("root").alias("next"))
        now = materialise(now.join(up, "root").select("wid", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), name)
        if not now.where("moved").take(1):
            return now.select("wid", "root")
        now = now.select("wid", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
             ratio: int = RATIO, dropped: bool = True, part_words: int = PART_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary."""
    words = materialise(vocabulary(docs, id_col, text_col, min_chars, min_count, dropped), "op13-words")
    words = numbered(words, "op13-numbered", part_words)
    near = neighbours(words, part_words)
    known = materialise(words.join(near, "wid", "left").select(
        "word", "n", "wid", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("near_n") >= ratio * F.col("n"), F.struct("near_wid", "near_n")).alias("f")), "op13-near")
    links = known.select("wid", F.col("f.near_wid").alias("form"))
    names = words.select(F.col("wid").alias("named"), F.col("word").alias("name"))
    out = known.join(roots(links, "op13-roots"), "wid")
    out = out.join(names.select(F.col("named").alias("root"), F.col("name").alias("root_word")), "root")
    out = out.join(names.select(F.col("named").alias("near_wid"), F.col("name").alias("form")), F.col("f.near_wid") == F.col("near_wid"), "left")
    return out.select("word", "form", F.col("root_word").alias("root"), "n", "n_near", F.col("f.near_n").alias("form_n"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(read_table(spark, sf_dir, "documents"))


_SQL = r"""
WITH RECURSIVE
-- crc32: the 256 remainders by rule, then byte by byte; a letter from U+00C0 on is two bytes in UTF-8
bits AS (SELECT i, i AS c, 0 AS k FROM range(256) AS t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
tbl AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
runs AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' AS head, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS r FROM documents)),
long AS (SELECT head, run, count(*) AS m FROM runs WHERE length(run) >= 6 GROUP BY ALL),
bytes AS (SELECT head, run, m, flatten(list_transform(string_split(head || run, ''), lambda c:
  CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)]::BIGINT[] END)) AS b FROM long),
crc AS (SELECT run, m, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS h FROM bytes, tbl),
words AS (SELECT word, sum(m)::BIGINT AS n FROM (SELECT m, CASE WHEN h % 199 = 0
    THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM crc)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(m) >= 5),
cut AS (SELECT word, n, k, left(word, k::INT - 1) AS a, substr(word, k::INT + 1) AS z FROM words, range(1, length(word) + 1) AS r(k)),
pairs AS (SELECT x.word AS u, y.word AS v, y.n AS m FROM cut x JOIN cut y ON x.a = y.a AND x.z = y.z AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM cut x JOIN words y ON x.a || x.z = y.word
  UNION SELECT y.word, x.word, x.n FROM cut x JOIN words y ON x.a || x.z = y.word),
near AS (SELECT u, count(*) AS n_near, max(m) AS best FROM pairs GROUP BY u),
top AS (SELECT p.u, min(p.v) AS form, any_value(n.best) AS form_n FROM pairs p JOIN near n ON p.u = n.u AND p.m = n.best GROUP BY p.u),
known AS (SELECT w.word, w.n, coalesce(n.n_near, 0)::BIGINT AS n_near, CASE WHEN t.form_n >= 5 * w.n THEN t.form END AS form,
  CASE WHEN t.form_n >= 5 * w.n THEN t.form_n END AS form_n FROM words w LEFT JOIN near n ON w.word = n.u LEFT JOIN top t ON w.word = t.u),
walk AS (SELECT word, word AS at, form AS nxt FROM known
  UNION ALL SELECT w.word, k.word, k.form FROM walk w JOIN known k ON w.nxt = k.word)
SELECT k.word, k.form, w.at AS root, k.n, k.n_near, k.form_n FROM known k JOIN walk w ON k.word = w.word AND w.nxt IS NULL
"""

QUERIES = {"op13_spelling": (op13_spelling, _SQL)}
