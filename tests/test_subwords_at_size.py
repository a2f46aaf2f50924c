"""Pieces and words are put in order without a lambda at each comparison."""

from commentguard.operators import tags as TG


def test_sorted_without_lambdas(spark):
    pieces = [(1, 3, "b", 1), (1, 0, None, 0), (1, 2, "▁a", 0), (1, 1, "x", 1), (1, 4, "▁", 0), (1, None, "n", 0)]
    words = TG.merge_subwords(spark.createDataFrame(pieces, "id long, pos int, token string, tag_idx int"))
    assert [(r["word_pos"], r["word"]) for r in words.orderBy("word_pos").collect()] == [(1, "n"), (2, ""), (3, "x"), (4, "ab"), (5, "")]
    tags = spark.createDataFrame([(0, "a", "à")], "tag_idx int, raw string, accented string")
    out = TG.apply_tags(words, tags)
    assert [r["text"] for r in out.collect()] == ["n  x àb "]
    plan = out._jdf.queryExecution().analyzed().toString()
    assert plan.count("sort_array(collect_list") == 2 and "array_sort(collect_list" not in plan
