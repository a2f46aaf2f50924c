"""Collected-comment operators.

The browser/network collection itself is not reproduced; these are its data
steps over raw pages and comment threads already in tables.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.text import normalise_url
from ..sizing import maybe_broadcast
from .markup import Selector, elements

# Named HTML entities decoded in extracted text (as a browser shows it); numeric ones are decoded by rule.
_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def decode_numeric(text: Column) -> Column:
    """&#7879; and &#x1EC7; -> their characters; codes that are none stay."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit("&#([0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});"), 1))

    def char(code: Column) -> Column:
        n = F.when(F.lower(code).startswith("x"), F.conv(F.substring(code, 2, 8), 16, 10)).otherwise(code).cast("long")
        valid = ((n > 0) & (n < 0xD800)) | ((n > 0xDFFF) & (n < 0x110000))
        return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))

    decoded = F.aggregate(found, text, lambda t, c: F.coalesce(F.replace(t, F.concat(F.lit("&#"), c, F.lit(";")), char(c)), t))
    return F.when(F.instr(text, "&#") > 0, decoded).otherwise(text)


def _block_reader(selectors: tuple[str, ...], unclosed: bool):
    wanted = [Selector.parse(x) for x in selectors]

    @F.arrow_udf("array<string>")
    def blocks(html: pa.Array) -> pa.Array:
        return pa.array([elements(h, wanted, unclosed) if h is not None else None for h in html.cast(pa.binary()).to_pylist()], pa.list_(pa.string()))

    return blocks


def page_blocks(pages: DataFrame, phrases: DataFrame | None = None, url_col: str = "url",
                html_col: str = "html", selectors: tuple[str, ...] = ("p", "li"),
                unclosed: bool = False) -> DataFrame:
    """Text of each element that a selector names (``markup.elements``: nested, unclosed and void ones by rule),
    tags removed, stripped; drop blanks and UI phrases; distinct per URL.

    URL hosts are normalised first (B11). ``phrases`` is a DataFrame(phrase);
    default the fixed UI phrases. A page is scanned once, whatever the number of selectors.
    """
    out = pages.select(normalise_url(url_col).alias("url"), F.explode(_block_reader(selectors, unclosed)(F.col(html_col))).alias("block"))
    text = decode_numeric(F.col("block"))
    for ent, ch in _ENTITIES:
        text = F.replace(text, F.lit(ent), F.lit(ch))
    out = out.select("url", F.regexp_replace(text, V.EDGE_WHITESPACE, "").alias("cmt")).filter(F.col("cmt") != "")
    if phrases is None:
        from ..sources.lexicon import local_table, PHRASE_SCHEMA
        phrases = local_table(pages.sparkSession, [(p,) for p in V.UI_PHRASES], PHRASE_SCHEMA)
    ui = phrases.select(F.col("phrase").alias("cmt"))
    out = out.join(maybe_broadcast(ui), "cmt", "left_anti")
    return out.dropDuplicates(["url", "cmt"]).select("url", "cmt")


def flatten_threads(threads: DataFrame, url_col: str = "url", items_col: str = "comments") -> DataFrame:
    """Nested per-item comments -> (url, pos, cmt), keeping non-empty text."""
    ex = threads.select(F.col(url_col).alias("url"), F.posexplode(items_col).alias("pos", "c"))
    return ex.select("url", "pos", F.col("c.text").alias("cmt")).filter(F.coalesce(F.col("cmt") != "", F.lit(False)))


def first_k(comments: DataFrame, k: int | None, url_col: str = "url", pos_col: str = "pos",
            salt: int = 64) -> DataFrame:
    """first k comments per URL by position (None = all).

    Two phases so a hot URL is never ranked in one task: the first k per
    (URL, salt bucket) -- buckets split each URL's rows by a hash -- then the
    first k among those <= salt * k survivors per URL. Ties on position are
    broken by the remaining columns, so the result is deterministic.
    """
    if k is None:
        return comments
    others = [F.col(c) for c in comments.columns if c not in (url_col, pos_col)]
    order = [F.col(pos_col)] + others
    bucket = F.pmod(F.xxhash64(*[F.col(c) for c in comments.columns]), F.lit(salt))
    w1 = Window.partitionBy(url_col, "__salt").orderBy(*order)
    survivors = comments.withColumn("__salt", bucket) \
        .withColumn("__rn", F.row_number().over(w1)).filter(F.col("__rn") <= k).drop("__rn", "__salt")
    w2 = Window.partitionBy(url_col).orderBy(*order)
    return survivors.withColumn("__rn", F.row_number().over(w2)).filter(F.col("__rn") <= k).drop("__rn")


def distinct_per_url(comments: DataFrame, url_col: str = "url", text_col: str = "cmt") -> DataFrame:
    """Number of distinct comments per URL (set union over rounds)."""
    return comments.select(url_col, text_col).distinct().groupBy(url_col).agg(F.count(F.lit(1)).alias("n_distinct"))


def new_per_round(comments: DataFrame, url_col: str = "url", text_col: str = "cmt",
                  round_col: str = "round") -> DataFrame:
    """Comments first seen in each round (first appearance = min round)."""
    first = comments.groupBy(url_col, text_col).agg(F.min(round_col).alias(round_col))
    return first.groupBy(url_col, round_col).agg(F.count(F.lit(1)).alias("n_new"))
