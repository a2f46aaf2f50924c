"""The pieces of an id are dealt once, by id, and a small tag table moves no word."""

from commentguard.operators import tags as TG


def test_one_exchange(spark):
    rows = [(i, p, t, p % 4) for i in range(6) for p, t in enumerate(["x", "▁de", "fe", "▁ou", "▁", "a"])] + [(None, 0, "▁e", 1)]
    pred = spark.createDataFrame(rows, "id long, pos int, token string, tag_idx int")
    tags = spark.createDataFrame([(1, "e", "é"), (1, "d", "đ"), (2, "f", "ph"), (2, "", "z"), (3, None, "z"), (None, "e", "z"), (3, "ou", "où")],
                                 "tag_idx int, raw string, accented string")
    words = TG.merge_subwords(pred)
    assert [(r["word_pos"], r["word"], r["tags"]) for r in words.where("id = 3").orderBy("word_pos").collect()] == \
        [(1, "x", [0]), (2, "defe", [1, 2]), (3, "ou", [3]), (4, "a", [0, 1])]
    small = TG.apply_tags(words, tags)
    large = TG.apply_tags(words, tags, max_bytes=0)
    assert sorted(small.collect(), key=str) == sorted(large.collect(), key=str)
    by = {r["id"]: r["text"] for r in small.collect()}
    assert by[3] == "x đefe où a" and by[None] == "e"
    plan = TG.apply_tags(words, tags)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(id") == 1 and "SortMergeJoin" not in plan
