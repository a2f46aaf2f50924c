"""Filter interaction audit against a document-by-document simulation of every order."""

import collections
import itertools
import re

from pyspark.sql import functions as F

from commentguard.llm import filter_audit as A

DOCS = "doc_id long, text string, source string, mask string, part string, key string, good string, n string"
LONG = " ".join(f"w{i * 7919 % 100003}" for i in range(60_000))
PROSE = " ".join(f"alpha{i}" for i in range(60))


def fails(docs):
    lows = {}
    for i, t, _ in docs:
        if i is not None:
            lows[t or ""] = min(lows.get(t or "", i), i)
    for i, t, s in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = [len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
             bool(re.search(r"[#$%&*|]", t)), i is not None and i > lows[t]]
        yield i, s or "", {c for c, x in zip("ABCDE", f) if x}


def simulate(docs, good, toxic):
    rows = list(fails(docs))
    out = {}
    total = collections.Counter()
    for part in {s for _, s, _ in rows}:
        for order in itertools.permutations("ABCDE"):
            left = [(i, f) for i, s, f in rows if s == part]
            for k, c in enumerate(order, 1):
                gone = [i for i, f in left if c in f]
                left = [(i, f) for i, f in left if c not in f]
                failing = sum(c in f for _, s, f in rows if s == part)
                out[part, "".join(order), k] = (len(left), len(gone), failing - len(gone), sum(f == {c} for _, s, f in rows if s == part),
                                                sum(i in good for i in gone), sum(i in toxic for i in gone))
                total[part, c] += len(gone)
    return {(p, o, k): (*v, total[p, o[k - 1]]) for (p, o, k), v in out.items()}


def collected(df):
    return {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"], r["toxic_lost"],
                                                        r["shapley"]) for r in df.collect()}


def test_audit_equals_simulation_with_nulls_copies_and_clashing_columns(spark):
    docs = [(1, PROSE, "a"), (2, PROSE, "b"), (2, PROSE, "b"), (1, PROSE, "b"), (3, None, "a"), (4, "", None), (5, "", ""), (None, PROSE, "a"),
            (None, None, None), (6, LONG, "a"), (7, LONG.upper(), "a"), (8, "x " * 80, "b"), (9, "A# " * 3, None), (10, "ÉÉ   é", "b"),
            (11, "   \n", "a"), (12, " " + PROSE + "\t", "a"), (13, PROSE + " $", "b"), (-4, "A# " * 3, "a")]
    labels = [(1, 1, 0), (1, 0, 1), (2, None, 1), (5, 1, None), (None, 1, 1), (9, 1, 1), (99, 1, 1), (8, 0, 0), (-4, 1, 1)]
    df = spark.createDataFrame([(*d, "m", "p", "k", "g", "n") for d in docs], DOCS).repartition(5)
    got = A.audit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert got.count() == 600 * 3
    assert collected(got) == simulate(docs, good={1, 5, 9, -4}, toxic={1, 2, 9, -4})


def test_audit_of_empty_tables_and_own_filters(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert A.audit(none, labels).count() == 0
    docs = spark.createDataFrame([(1, "ab", "s"), (2, "b", "s"), (3, "a", "s")], none.schema)
    got = collected(A.audit(docs, labels, {"x": F.col("text").contains("a"), "y": F.col("text").contains("b")}, copies=None))
    assert len(got) == 4
    assert got["s", "xy", 1] == (1, 2, 0, 1, 0, 0, 3) and got["s", "xy", 2] == (0, 1, 1, 1, 0, 0, 3)


def test_copies_of_one_text_collapse_before_the_shuffle(spark):
    """A third of all rows share a text: after the label join they are combined map-side on the text's key."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string"))
                                    .alias("text"), F.lit("s").alias("source"))
    got = collected(A.audit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")))
    assert got["s", "EABCD", 1][:2] == (2001, 999)
