"""Golden rows for page blocks (A13) and sub-word merging / tag rules."""

from commentguard.operators import collect as CL
from commentguard.operators import tags as TG
from commentguard.sources import lexicon as LX
from pyspark.sql import types as T


def test_page_blocks_golden(spark):
    html = ('<html><head><style>p{x}</style><script>var t="<p>no</p>";</script></head><body>'
            '<!-- <p>hidden</p> --><p class="c"> Hello <b>big</b> &amp; bold </p>'
            '<ul><li>Đang tải...</li><li>  </li><li>second</li></ul><p>Hello <b>big</b> &amp; bold</p></body></html>')
    pages = spark.createDataFrame([("https://m.site.org/post/1", html)], "url string, html string")
    got = sorted((r["url"], r["cmt"]) for r in CL.page_blocks(pages).collect())
    assert got == [("https://www.site.org/post/1", "Hello big & bold"), ("https://www.site.org/post/1", "second")]


def test_merge_subwords_leading_unprefixed(spark):
    rows = [(1, 0, "ab", 1), (1, 1, "c", 2), (1, 2, "▁de", 1), (1, 3, "f", 3), (1, 4, "▁g", 0)]
    pred = spark.createDataFrame(rows, "id long, pos long, token string, tag_idx int")
    words = TG.merge_subwords(pred)
    got = sorted((r["word_pos"], r["word"], r["tags"]) for r in words.collect())
    # leading pieces without the marker are words on their own; marked pieces start words
    assert got == [(1, "ab", [1]), (2, "c", [2]), (3, "def", [1, 3]), (4, "g", [0])]
    schema = T.StructType([T.StructField("tag_idx", T.IntegerType()), T.StructField("name", T.StringType())])
    tags = LX.tag_table_from(LX.local_table(spark, [(0, "-"), (1, "e-é"), (2, "z-y"), (3, "f-ph")], schema))
    text = TG.apply_tags(words, tags).first()["text"]
    # "def": first piece with an applicable tag is pos 2 (tag 1: e -> é); "c": tag 2 ("z") does not apply
    assert text == "ab c déf g"


def test_page_blocks_selector_and_numeric_entities(spark):
    from commentguard.operators import collect as CL
    html = ("<DIV class=x dir='auto'>Vi&#7879;t &#x1EC7; &amp;#65; &#0; &#39;q&#39;</DIV><div dir=ltr>no</div>"
            "<div dir=\"auto\" id=1>two</div><P>para</P>")
    pages = spark.createDataFrame([("http://m.a/1", html)], "url string, html string")
    got = sorted(r["cmt"] for r in CL.page_blocks(pages, selectors=("div[dir='auto']",)).collect())
    assert got == ["Vi\u1ec7t \u1ec7 &#65; &#0; 'q'", "two"]
    assert [r["cmt"] for r in CL.page_blocks(pages).collect()] == ["para"]
