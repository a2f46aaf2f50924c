"""Iterative stratification: the plan on label sets against a plain version, drift against the rarest-label rule, edge cases."""

import collections
import itertools
import math
import random

from commentguard.operators import splits as SP
from commentguard.plans import fixtures as FX

SHARES = (0.8, 0.1, 0.1)


def plain(sets, shares):
    """Rows dealt one by one, everything counted anew from the rows dealt so far."""
    items = lambda s: [(x,) for x in s] + list(itertools.combinations(s, 2))
    dealt = {}

    def lacks(k, mine):
        return round(sum(shares[k] * sets[s] - g[k] for s, g in dealt.items() for i in items(mine) + [None] if i is None or i in items(s)), 6)

    while len(dealt) < len(sets):
        left = collections.Counter()
        for s in set(sets) - set(dealt):
            for i in items(s):
                left[i] += sets[s]
        item = min(left, key=lambda i: (left[i], len(i), i)) if left else None
        todo = [s for s in sets if s not in dealt and (item is None or item in items(s))]
        for s in sorted(todo, key=lambda s: (-sets[s], s)):
            dealt[s] = [math.floor(round(sets[s] * x, 9)) for x in shares]
            for _ in range(sets[s] - sum(dealt[s])):
                k = max(range(len(shares)), key=lambda k: (lacks(k, s), -k))
                dealt[s][k] += 1
    return dealt


def test_plan_against_plain_version():
    rng = random.Random(5)
    for trial in range(40):
        sets = {tuple(sorted(rng.sample(range(6), rng.randint(0, 4)))): rng.choice([1, 1, 2, 3, 7, 10, 40]) for _ in range(rng.randint(1, 14))}
        plan = SP.plan_splits(sets, SHARES)
        assert plan == plain(sets, SHARES), trial
        assert all(sum(plan[s]) == n for s, n in sets.items())
    assert SP.plan_splits({}, SHARES) == {}


def _drift(rows, pick):
    """Greatest and summed distance of a split's rows of a label (or pair) from its share of them."""
    total, by = collections.Counter(), collections.Counter()
    for bits, split in rows:
        for i in pick([k for k, b in enumerate(bits) if b == 1]):
            total[i] += 1
            by[i, split] += 1
    off = [abs(by[i, s] - x * n) for i, n in total.items() for s, x in zip(("train", "dev", "test"), SHARES)]
    return max(off), sum(off)


def test_drift_below_the_rarest_label_rule(spark):
    lg = FX.logits(spark, "/root/testdata/sf0.01").select("id", "truth").cache()
    new = [(r["truth"], r["split"]) for r in SP.iterative_split(lg).collect()]
    old = [(r["truth"], r["split"]) for r in SP.stratified_split(lg).collect()]
    assert len(new) == len(old) == lg.count()
    for pick in (lambda x: x, lambda x: itertools.combinations(x, 2)):
        a, b = _drift(new, pick), _drift(old, pick)
        print("iterative", a, "rarest label", b)
        assert a[0] <= b[0] and a[1] < b[1]
    lg.unpersist()


def test_stable_and_within_the_bytes(spark):
    lg = FX.logits(spark, "/root/testdata/sf0.001").select("id", "truth")
    a = {r["id"]: r["split"] for r in SP.iterative_split(lg).collect()}
    assert a == {r["id"]: r["split"] for r in SP.iterative_split(lg.repartition(5)).collect()}
    few = SP.iterative_split(lg, max_bytes=0).collect()  # sets too many to plan: two rarest labels
    assert len(few) == len(a) and max(len(r["label_set"].split(",")) for r in few) <= 2


def test_edges(spark):
    rows = [(1, None), (1, None), (2, []), (3, [None, 1]), (4, [0, 1]), (5, [1]), (None, [0, 1, 0, 0]), (6, [2, 0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "id long, truth array<int>, n string, f int")
    got = SP.iterative_split(df)
    assert got.columns == ["id", "truth", "n", "f", "label_set", "split"]
    sets = collections.Counter(r["label_set"] for r in got.collect())
    assert sets == {"": 4, "1": 3, "0": 1}
    assert SP.iterative_split(df.limit(0)).count() == 0
