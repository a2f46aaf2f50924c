"""B6 in context: a small lexicon is looked up where the texts are, and only its pairs are counted."""

from pyspark.sql import functions as F

from commentguard.operators import lattice as LT
from commentguard.sources import lexicon as LX

TEXTS = [(b"1", 2, "a b c d"), (b"2", 1, "b c"), (b"3", 1, "é b é b"), (b"4", 1, "a"), (b"5", 1, "q a b"), (b"6", 3, "c d c d"), (b"7", 1, "e e e"), (b"8", 1, "a c")]


def test_small_lexicon(spark):
    texts = spark.createDataFrame(TEXTS, "key binary, copies int, t string")
    lexicon = LT.phrases(LX.compounds(spark, ["a b", "b c", "b c d", "c d", "é b", "e e", "a b x", "single"]))
    one, cut = LT.matches(texts, lexicon), LT.matches(texts, lexicon, max_bytes=0)
    assert one.dtypes == [(c, dict(cut.dtypes)[c]) for c in one.columns]
    assert one.exceptAll(cut.select(*one.columns)).isEmpty() and cut.select(*one.columns).exceptAll(one).isEmpty()
    assert one.where("key = X'31'").count() == 4 and one.where("phrase = 'e e'").count() == 2
    assert "Join" not in one._jdf.queryExecution().executedPlan().toString()
    rows = LT.pair_counts(texts, LX.compounds(spark, ["a b"]), "t", "offline")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("Join") < plan.index("Generate")  # counted after, not before
    both = [{(r["u"], r["v"]): r["n"] for r in LT.pair_counts(texts, LX.compounds(spark, ["a b"]), "t", "offline", n).collect()} for n in (LT.BROADCAST_BYTES, 0)]
    assert both[0] == both[1] and both[0]["", "a b"] == 1 and both[0]["a", "b"] == 2 and ("c", "d") not in both[0]
    assert LT.matches(texts.where(F.lit(False)), lexicon).count() == 0
