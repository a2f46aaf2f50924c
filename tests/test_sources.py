"""Golden tests for file sources and sinks."""

import json
import os
import uuid

import pytest
from pyspark.sql.utils import AnalysisException

from commentguard.session import scratch_path
from commentguard.sources import lexicon as LX
from commentguard.sources import tables as TB
from commentguard import vocab as V


@pytest.fixture()
def folder(spark):
    p = scratch_path(spark, f"tests/src-{uuid.uuid4().hex[:8]}")
    os.makedirs(p, exist_ok=True)
    return p


def test_read_lines_strips_and_drops_blanks(spark, folder):
    path = f"{folder}/words.txt"
    with open(path, "w", encoding="utf-8") as f:
        f.write("  có_thể \n\n\t\nđến_nỗi\n")
    assert [r[0] for r in LX.read_lines(spark, path).collect()] == ["có_thể", "đến_nỗi"]
    with pytest.raises(AnalysisException):
        LX.read_lines(spark, f"{folder}/missing.txt")


def test_load_lexicon_later_duplicate_wins(spark, folder):
    path = f"{folder}/teencode.csv"
    with open(path, "w", encoding="utf-8") as f:
        f.write("abbr,full\nko,khong\nvs,với\nko,không\n")
    got = {r["abbr"]: r["full"] for r in LX.load_lexicon(spark, path).collect()}
    assert got == {"ko": "không", "vs": "với"}


def test_url_list_and_csv_append(spark, folder):
    urls = f"{folder}/urls.csv"
    with open(urls, "w", encoding="utf-8") as f:
        f.write("url\nhttps://m.example.com/a\nhttps://example.com/b\n")
    df = TB.read_urls(spark, urls)
    assert df.count() == 2
    out = f"{folder}/comments"
    rows = spark.createDataFrame([("https://www.example.com/a", "xin chào")], "url string, cmt string")
    TB.append_csv(rows, out)
    TB.append_csv(rows, out)
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["url", "cmt"] and back.count() == 2


def test_label_vocab_json(spark, folder):
    out = f"{folder}/labels"
    LX.write_label_vocab(spark, out)
    rows = sorted((r["idx"], r["name"]) for r in spark.read.json(out).collect())
    assert rows == list(enumerate(V.TYPE_ATTACK_LABELS))


def test_tag_table_parsing(spark):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("tag_idx", T.IntegerType()), T.StructField("name", T.StringType())])
    df = LX.tag_table_from(LX.local_table(spark, [(0, "-"), (1, "a-á"), (2, "a-b-c")], schema))
    got = {r["tag_idx"]: (r["raw"], r["accented"]) for r in df.collect()}
    assert got == {0: ("", ""), 1: ("a", "á"), 2: (None, None)}


def test_tag_table_line_numbers(spark, folder):
    path = f"{folder}/tags.txt"
    lines = ["-", "a-à", "a-á"] + [f"x{i}-y{i}" for i in range(300)]
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    got = {r["tag_idx"]: (r["raw"], r["accented"]) for r in LX.tag_table(spark, path).collect()}
    assert len(got) == len(lines) and got[1] == ("a", "à") and got[302] == ("x299", "y299")
    idx = LX.with_line_index(spark.range(1000).repartition(5).sortWithinPartitions("id"))
    assert sorted(r["line_idx"] for r in idx.collect()) == list(range(1000))


def test_lines_of_several_files_keep_their_place(spark, tmp_path):
    from commentguard.sources import lexicon as LX
    for name, lines in (("b", ["b-1", "b-2", "k,late"]), ("a", ["a-1", "a-2", "a-3", "k,early"])):
        (tmp_path / f"{name}.csv").write_text("abbr,full\n" + "\n".join(lines) + "\n")
    import os
    os.utime(tmp_path / "a.csv")  # the newer file, yet the first by path
    got = {r["tag_idx"]: r["raw"] for r in LX.tag_table(spark, str(tmp_path)).collect()}
    assert [got[k] for k in sorted(got)] == [None, "a", "a", "a", None, None, "b", "b", None] and sorted(got) == list(range(9))
    assert {r["abbr"]: r["full"] for r in LX.load_lexicon(spark, str(tmp_path)).collect()}["k"] == "late"
