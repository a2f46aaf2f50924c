"""Running sums against every window summed anew, and no frame that slides."""

import random

from commentguard.operators import monitor as MO


def test_burst_alert_windows(spark):
    rnd = random.Random(5)
    rows = [(rnd.randrange(0, 40_000_000), rnd.choice([True, False, None])) for _ in range(600)]
    rows += [(k * 3_000_000 + d, True) for k in range(1, 12) for d in (-1, 0, 1)] + [(90_000_000, None), (95_000_000, True), (98_000_000, None), (98_000_001, None)]
    log = spark.createDataFrame(rows, "us long, is_hate boolean").selectExpr("timestamp_micros(us) AS timestamp", "is_hate")
    out = MO.burst_alert(log, window_seconds=3)
    got = {r["us"]: r["toxic_in_window"] for r in out.selectExpr("unix_micros(ts) AS us", "toxic_in_window").collect()}
    assert set(got) == {us for us, _ in rows}
    for t in got:
        here = [int(f) for us, f in rows if t - 3_000_000 <= us <= t and f is not None]
        assert got[t] == (sum(here) if here else None), t
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "unboundedpreceding" in plan and "RangeFrame, -3000000" not in plan
