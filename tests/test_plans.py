"""Physical-plan checks: broadcast lexicons, bounded exchanges, no Python in native operators."""

from commentguard.operators import monitor as MO
from commentguard.plans import fixtures as FX
from commentguard.operators.cleaning import clean_comments

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cleaner_plan(spark):
    ab, co, sw = FX.fixture_lexicons(spark)
    p = plan(clean_comments(FX.comments(spark, SF), ab, co, sw))
    assert "Exchange" not in p and "Join" not in p and p.count("FileScan") == 1
    # once, blank filter and all: the texts are normalised and handed to Python a single time
    assert p.count("ArrowEvalPython") == 1 and "BatchEvalPython" not in p


def test_restore_accents_plan(spark):
    from commentguard.operators.tags import restore_accents
    p = plan(restore_accents(FX.comments(spark, SF), text_col="cmt"))
    assert "Exchange" not in p and "Join" not in p and p.count("FileScan") == 1


def test_recent_is_take_ordered(spark):
    p = plan(MO.recent(FX.monitor_log(spark, SF)))
    assert "TakeOrderedAndProject" in p


def test_monitor_aggregates_are_native(spark):
    for df in (MO.kpis(FX.monitor_log(spark, SF)), MO.trend(FX.flags(spark, SF)),
               MO.burst_alert(FX.flags(spark, SF), window_seconds=3600)):
        p = plan(df)
        assert "Python" not in p


def test_scan_prunes_columns(spark):
    import re
    p = plan(MO.kpis(FX.monitor_log(spark, SF)))
    read = {name for schema in re.findall(r"ReadSchema: struct<([^\n]*)>", p) for name in re.findall(r"(\w+):", schema)}
    assert {"doc_id", "embedding"} <= read
    assert not read & {"text", "lang", "source", "n_chars", "label", "value", "user_id"}
