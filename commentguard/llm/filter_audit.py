"""Filter interaction audit: Hart-Mas-Colell potentials of the removal game.

A game per part of the corpus: a coalition of filters is worth the documents that at least one of
them removes. Its potential is defined from smaller coalitions,

    P(S) = (worth(S) + sum of P(S without i) over i in S) / |S|,   P(nothing) = 0,

worked out over all coalitions by size. A filter's Shapley value is the potential of all filters
minus that of all but this one; what it removes at a step, after the filters before it, is a
difference of two coalitions' worths. Everything is kept in whole numbers: potentials are scaled
by the number of orders.

Documents are read once. A filter that judges a text alone is a condition on it; which filters a
document fails is one small bit mask, so that documents collapse, before they are shuffled, into
counts by (text key, part, labels). Copies of a text are found from those counts: rows are
grouped by the SHA-256 of the text, never by the text, and combined map-side, so copies that make
up a third of all rows collapse in their own tasks. Labels are joined by id; rows without an id
are dealt over all tasks. What is left per part is one row of at most 2^filters counts, from
which all coalitions, potentials and steps are worked out as array expressions.

Defined cases: a null or empty text is the empty text (and equal to other empty ones); a null
source is the part ''; a row with a null id is never a later copy, makes none, and has no labels;
rows that repeat an id count one by one and are not copies of each other; a document counts as
good or toxic if one of its label rows says so, a null label says nothing; very long texts are
judged whole; an empty table has no parts; columns that are not asked for are not read, whatever
their names.
"""

from __future__ import annotations

import itertools
import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commentguard.llm.common import read_table

MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_CAPITAL_PERCENT = 5
_SPACES = r"[\x20\x09-\x0D]+"
_DEALT = 4096  # rows without an id are spread over so many join keys


def text_conditions() -> dict[str, Column]:
    """Filters A to D on the column ``text`` (never null): true where a text fails."""
    t = F.col("text")
    words = F.array_remove(F.split(t, _SPACES), "")
    capitals = F.octet_length(t) - F.octet_length(F.regexp_replace(t, "[A-Z]+", ""))
    return {
        "A": F.size(words) < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * F.size(words),
        "C": 100 * capitals > MAX_CAPITAL_PERCENT * F.length(t),
        "D": t.rlike("[#$%&*|]"),
    }


def fail_counts(docs: DataFrame, labels: DataFrame, conditions: dict[str, Column], copies: str | None,
                id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, mask, good, toxic, n): documents by the filters they fail, bit k being the k-th condition.

    ``copies`` names one more filter, the last bit: the text is identical to that of a smaller id.
    """
    bits = sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(conditions.values())), F.lit(0))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text")) \
        .select("id", "part", bits.alias("mask"), F.unhex(F.sha2("text", 256)).alias("key"))
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("label_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic")).withColumn("label_dealt", F.lit(0).cast("long"))
    dealt = F.when(F.col("id").isNull(), 1 + F.pmod(F.xxhash64("key", "part"), F.lit(_DEALT))).otherwise(F.lit(0)).cast("long")
    rows = rows.withColumn("dealt", dealt)
    rows = rows.join(known, (F.col("id") == F.col("label_id")) & (F.col("dealt") == F.col("label_dealt")), "left")
    of = ["part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")]
    if copies is None:
        return rows.groupBy(*of).agg(F.count(F.lit(1)).alias("n"))
    # rows of a text by part and labels, with the least id and how many rows have it; then the least id of the text
    per = rows.groupBy("key", "id", "dealt", *of).agg(F.count(F.lit(1)).alias("n"))
    per = per.groupBy("key", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("id").alias("low"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
        F.min_by(F.when(F.col("id").isNotNull(), F.col("n")), "id").alias("n_low"))
    member = F.struct("part", "mask", "good", "toxic", "n", "low", "unnamed", "n_low")
    per = per.groupBy("key").agg(F.min("low").alias("first"), F.collect_list(member).alias("members")) \
        .select("first", F.inline("members"))
    own = F.when(F.col("low") == F.col("first"), F.col("n_low")).otherwise(0) + F.col("unnamed")  # rows that are not later copies
    bit = 1 << len(conditions)
    split = F.array(F.struct(F.col("mask"), own.alias("n")), F.struct((F.col("mask") + bit).alias("mask"), (F.col("n") - own).alias("n")))
    return per.select("part", "good", "toxic", F.explode(split).alias("s")) \
        .groupBy("part", F.col("s.mask").alias("mask"), "good", "toxic").agg(F.sum("s.n").alias("n"))


def coalitions(counts: DataFrame, filters: str) -> DataFrame:
    """Per part: worth, good and toxic (arrays over the coalitions, by their bits), docs, and potential.

    ``potential`` is scaled by the number of orders of the filters, which makes it whole.
    """
    size, orders = 1 << len(filters), math.factorial(len(filters))

    def hit(count: Column) -> list[Column]:
        return [F.sum(F.when(F.col("mask").bitwiseAND(F.lit(s)) != 0, count).otherwise(0)) for s in range(size)]

    out = counts.groupBy("part").agg(
        F.sum("n").alias("docs"), F.array(*hit(F.col("n"))).alias("worth"),
        F.array(*hit(F.col("n") * F.col("good"))).alias("good"), F.array(*hit(F.col("n") * F.col("toxic"))).alias("toxic"))
    # bits grow with every filter added, so a coalition's subsets come before it and are ready when it is reached
    members = [[k for k in range(len(filters)) if s >> k & 1] for s in range(size)]
    step = F.from_json(F.lit(json.dumps([{"s": s, "size": len(m), "without": [s ^ (1 << k) for k in m]} for s, m in enumerate(members) if m])),
                       "array<struct<s:int,size:int,without:array<int>>>")
    potential = F.aggregate(step, F.array(F.lit(0).cast("long")), lambda done, x: F.concat(done, F.array(
        (F.aggregate(x["without"], orders * F.get("worth", x["s"]), lambda total, t: total + F.get(done, t)) / x["size"]).cast("long"))))
    return out.withColumn("potential", potential)


def steps(games: DataFrame, filters: str) -> DataFrame:
    """Every step of every order of the filters, per part: what is removed there, and the filter's Shapley value (scaled)."""
    grand = (1 << len(filters)) - 1
    plan = []
    for order in itertools.permutations(range(len(filters))):
        before = 0
        for k, f in enumerate(order):
            plan.append({"o": "".join(filters[i] for i in order), "k": k + 1, "b": before, "f": 1 << f})
            before |= 1 << f
    plan = F.from_json(F.lit(json.dumps(plan)), "array<struct<o:string,k:int,b:int,f:int>>")
    at = lambda name, s: F.get(name, s)
    each = games.select("*", F.explode(plan).alias("x"))
    b, f = F.col("x.b"), F.col("x.f")
    after, rest = b.bitwiseOR(f), F.lit(grand).bitwiseXOR(f)
    removed = at("worth", after) - at("worth", b)
    return each.select(
        "part", F.col("x.o").alias("filter_order"), F.col("x.k").alias("step"),
        (F.col("docs") - at("worth", after)).alias("kept"), removed.alias("removed"), (at("worth", f) - removed).alias("redundant"),
        (at("worth", F.lit(grand)) - at("worth", rest)).alias("unique_fails"),
        (at("good", after) - at("good", b)).alias("good_lost"), (at("toxic", after) - at("toxic", b)).alias("toxic_lost"),
        (at("potential", F.lit(grand)) - at("potential", rest)).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, conditions: dict[str, Column] | None = None, copies: str | None = "E") -> DataFrame:
    """The audit of the filters (by default the five of this module) in every order, per source."""
    conditions = text_conditions() if conditions is None else conditions
    filters = "".join(conditions) + (copies or "")
    return steps(coalitions(fail_counts(docs, labels, conditions, copies), filters), filters)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM d),
l AS (SELECT doc_id, max((coalesce(quality, 0) = 1)::INT) AS good, max((coalesce(toxic, 0) = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT w.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
  {'A': len(words) < 50, 'B': 100 * len(list_distinct(words)) < 65 * len(words),
   'C': 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t), 'D': regexp_matches(t, '[#$%&*|]'),
   'E': coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false)} AS s
  FROM w LEFT JOIN l USING (doc_id)),
m AS (SELECT part, good, toxic, (CASE WHEN s.A THEN 'A' ELSE '' END) || (CASE WHEN s.B THEN 'B' ELSE '' END) || (CASE WHEN s.C THEN 'C' ELSE '' END)
  || (CASE WHEN s.D THEN 'D' ELSE '' END) || (CASE WHEN s.E THEN 'E' ELSE '' END) AS fails, count(*) AS n FROM f GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
steps AS (SELECT filter_order, step::INT AS step, filter_order[step] AS f, filter_order[1:step - 1] AS earlier
  FROM orders, range(1, 6) AS r(step)),
-- documents that fail a filter of the order up to a step, or before it
r AS (SELECT part, filter_order, step, f, n, good, toxic, contains(fails, f) AS mine, fails = f AS only_mine,
  translate(fails, earlier, '') <> fails AS gone FROM m, steps),
a AS (SELECT part, filter_order, step, f, sum(CASE WHEN NOT gone AND NOT mine THEN n ELSE 0 END)::BIGINT AS kept,
  sum(CASE WHEN mine AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed, sum(CASE WHEN mine AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
  sum(CASE WHEN only_mine THEN n ELSE 0 END)::BIGINT AS unique_fails,
  sum(CASE WHEN mine AND NOT gone THEN n * good ELSE 0 END)::BIGINT AS good_lost,
  sum(CASE WHEN mine AND NOT gone THEN n * toxic ELSE 0 END)::BIGINT AS toxic_lost FROM r GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM a
"""

QUERIES = {"op11_filter_audit": (op11_filter_audit, _SQL)}
