"""Comment cleaning (B4-B8): abbreviation expansion, compound segmentation, stopwords.

Cleaning is row-local. Lexicons that are proven small (``sizing.BROADCAST_BYTES``) are sent to
the tasks once and looked up by an Arrow function (``lookup.Cleaner``: whole arrays of words, no
loop over rows) on the natively normalised text: one scan, no exchange, rows are never matched to
one another, so nothing depends on ids or on how the input is partitioned. The function is
declared non-deterministic, which keeps Catalyst from running it a second time for the blank filter.

Lexicons beyond that size are joined instead (``_clean_by_join``): each distinct text is
shuffled once, tokenised, looked up, put together again and joined back on the text itself.
Both ways give the same results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions import text as TX
from ..sizing import BROADCAST_BYTES, fits
from .lookup import Cleaner, slices

_CAND_TYPE = "array<struct<n:int,key:string,stop:boolean>>"


@dataclass
class Lexicons:
    """Small lexicons as Python tables: abbreviation -> words, stopwords, compounds by syllables."""

    expand: dict[str, list[str]] = field(default_factory=dict)
    stop: set[str] = field(default_factory=set)
    compounds: list[list[str]] = field(default_factory=list)


def _expansion(full: Column) -> Column:
    return F.filter(F.split(full, V.WHITESPACE_RUN), lambda x: x != "")


def _syllables(phrase: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(phrase, "_", " "), " "), lambda x: x != "")


def prepare_lexicons(abbreviations: DataFrame | None = None, compounds: DataFrame | None = None,
                     stopwords: DataFrame | None = None, max_bytes: int = BROADCAST_BYTES) -> Lexicons | None:
    """The lexicons as Python tables if they are proven small, else None.

    Streams prepare them once and hand them to every micro-batch. An abbreviation that repeats
    takes its greatest expansion.
    """
    if not fits(abbreviations, compounds, stopwords, max_bytes=max_bytes):
        return None
    out = Lexicons()
    if abbreviations is not None:
        once = abbreviations.where("abbr is not null and full is not null").groupBy("abbr").agg(F.max("full").alias("full"))
        out.expand = {r["abbr"]: list(r["words"]) for r in once.select("abbr", _expansion(F.col("full")).alias("words")).collect()}
    if stopwords is not None:
        out.stop = {r["word"] for r in stopwords.where("word is not null").select("word").distinct().collect()}
    if compounds is not None:
        rows = compounds.select(_syllables(F.col("phrase")).alias("s")).where(F.size("s") >= 2).distinct().collect()
        out.compounds = [list(r["s"]) for r in rows]
    return out


def _vectorised(shared):
    @F.arrow_udf("string")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lexicons = shared.value
        cleaner = Cleaner(lexicons.expand, lexicons.stop, lexicons.compounds)
        for texts in batches:
            yield pa.chunked_array([cleaner.apply(part) for part in slices(texts)], pa.string()).combine_chunks()

    return clean.asNondeterministic()


def build_word_facts(stopwords: DataFrame | None, compounds: DataFrame | None) -> DataFrame | None:
    """One lookup table keyed by word: stopword flag and compound candidates.

    A compound "a b c" (or "a_b_c") becomes candidate (n=3, key="a b c") of
    word "a"; its ``stop`` flag says whether "a_b_c" is itself a stopword.
    """
    if stopwords is None and compounds is None:
        return None
    sw = stopwords.select(F.col("word").alias("__w")).distinct() if stopwords is not None else None
    facts = None
    if compounds is not None:
        syl = F.filter(F.split(F.regexp_replace(F.col("phrase"), "_", " "), " "), lambda x: x != "")
        comp = compounds.select(syl.alias("syl")).filter(F.size("syl") >= 2).select(
            F.element_at("syl", 1).alias("__w"),
            F.size("syl").alias("n"),
            F.array_join("syl", " ").alias("key"),
            F.array_join("syl", "_").alias("joined"),
        ).distinct()
        if sw is not None:
            comp = comp.join(sw.select(F.col("__w").alias("joined"), F.lit(True).alias("stop")), "joined", "left")
        else:
            comp = comp.withColumn("stop", F.lit(None).cast("boolean"))
        comp = comp.select("__w", F.struct(
            F.col("n").cast("int").alias("n"), "key", F.coalesce("stop", F.lit(False)).alias("stop")).alias("c"))
        facts = comp.groupBy("__w").agg(F.collect_list("c").alias("__cands"))
    if sw is not None:
        flags = sw.select("__w", F.lit(True).alias("__stop"))
        facts = flags.withColumn("__cands", F.lit(None).cast(_CAND_TYPE)) if facts is None else \
            flags.join(facts, "__w", "full")
    else:
        facts = facts.withColumn("__stop", F.lit(None).cast("boolean"))
    return facts.select("__w", F.coalesce("__stop", F.lit(False)).alias("__stop"), "__cands")


def _let(value: str, var: str, body: str) -> str:
    """Bind ``value`` to lambda variable ``var`` inside ``body``, evaluated once.

    Catalyst inlines a column alias wherever it is referenced, including inside
    lambda bodies, where it would then be re-evaluated per element. Binding
    through a one-element ``transform`` keeps each intermediate array computed
    once per comment.
    """
    return f"element_at(transform(array({value}), {var} -> {body}), 1)"


# Array-space assembly over the ordered tokens of one comment: ``t`` is the
# sorted array of struct(pos, sub, w, stop, cands), ``ws`` the words, ``wst``
# (word, stop) per position, ``best`` the longest compound starting at each
# position (n = 1 when none).
_BEST = """transform(t, (x, i) -> named_struct(
    'p', i + 1,
    'm', coalesce(
        array_max(filter(
            transform(x.__cands, c -> if(array_join(slice(ws, i + 1, c.n), ' ') = c.key,
                                         named_struct('n', c.n, 'stop', c.stop), null)),
            y -> y is not null)),
        named_struct('n', 1, 'stop', x.__stop))))"""
# Greedy left-to-right longest match: walk only the positions that start a
# compound; one is taken when it begins at or after the end of the last one.
_CHOSEN = """aggregate(
    filter(best, b -> b.m.n > 1),
    named_struct('nxt', 1, 'acc', cast(array() as array<struct<p:int,n:int,stop:boolean>>)),
    (s, b) -> if(b.p >= s.nxt,
                 named_struct('nxt', b.p + b.m.n,
                              'acc', concat(s.acc, array(named_struct('p', b.p, 'n', b.m.n, 'stop', b.m.stop)))),
                 s),
    s -> s.acc)"""
# Output in position order without sorting: chosen compounds are sorted and do
# not overlap, so the result is, per compound, the words since the previous one
# followed by the compound itself, then the words after the last one. Each
# element of ``wst`` is struct(word, stop) for one position.
_OUT = """array_join(transform(filter(flatten(concat(
        transform(chosen, (c, k) -> concat(
            slice(wst, if(k = 0, 1, element_at(chosen, k).p + element_at(chosen, k).n),
                  c.p - if(k = 0, 1, element_at(chosen, k).p + element_at(chosen, k).n)),
            array(named_struct('word', array_join(slice(ws, c.p, c.n), '_'), 'stop', c.stop)))),
        array(slice(wst, if(size(chosen) = 0, 1, element_at(chosen, -1).p + element_at(chosen, -1).n),
                    size(wst) + 1 - if(size(chosen) = 0, 1, element_at(chosen, -1).p + element_at(chosen, -1).n))))),
    u -> not u.stop and u.word != ''), u -> u.word), ' ')"""


def assemble_sql(tokens: str) -> str:
    """SQL expression: ordered token structs -> cleaned comment string."""
    return _let(f"array_sort({tokens})", "t",
                _let("transform(t, x -> x.__w)", "ws",
                     _let("transform(t, x -> named_struct('word', x.__w, 'stop', x.__stop))", "wst",
                          _let(_BEST, "best",
                               _let(_CHOSEN, "chosen", _OUT)))))


def _clean_by_join(df: DataFrame, text: Column, abbreviations: DataFrame | None, compounds: DataFrame | None,
                   stopwords: DataFrame | None, out_col: str) -> DataFrame:
    """The cleaner for lexicons too large to send around: keyed by the text, never null, so every row finds its result."""
    base = df.withColumn("__t", text).withColumn("__h", F.xxhash64("__t"))
    toks = base.select("__h", "__t").distinct().select("__h", "__t", F.posexplode(F.split("__t", " ")).alias("__pos", "__tok"))
    if abbreviations is not None:
        lex = abbreviations.where("abbr is not null and full is not null").groupBy(F.col("abbr").alias("__tok")).agg(F.max("full").alias("__full"))
        toks = toks.join(lex, "__tok", "left")
    else:
        toks = toks.withColumn("__full", F.lit(None).cast("string"))
    words = F.when(F.col("__full").isNotNull(), _expansion(F.col("__full"))).otherwise(F.array("__tok"))
    words = F.flatten(F.transform(words, lambda x: F.when(
        (F.length(x) > 1) & x.endswith("."), F.array(x.substr(F.lit(1), F.length(x) - 1), F.lit("."))).otherwise(F.array(x))))
    toks = toks.select("__h", "__t", "__pos", F.posexplode_outer(words).alias("__sub", "__w"))
    facts = build_word_facts(stopwords, compounds)
    if facts is not None:
        toks = toks.join(facts, "__w", "left")
    else:
        toks = toks.withColumn("__stop", F.lit(False)).withColumn("__cands", F.lit(None).cast(_CAND_TYPE))
    tokens = ("collect_list(struct(__pos, coalesce(__sub, 0) AS __sub, coalesce(__w, '') AS __w, "
              "coalesce(__stop, false) AS __stop, __cands))")
    done = toks.groupBy("__h", "__t").agg(F.expr(assemble_sql(tokens)).alias(out_col))
    return base.join(done, ["__h", "__t"]).select(*df.columns, out_col)


def clean_comments(
    df: DataFrame,
    abbreviations: DataFrame | None = None,
    compounds: DataFrame | None = None,
    stopwords: DataFrame | None = None,
    *,
    mode: str = "online",
    text_col: str = "cmt",
    out_col: str = "cmt_processed",
    strip_author: bool = True,
    drop_blank: bool = True,
    lexicons: Lexicons | None = None,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """B7 (mode="online") / B8 (mode="offline") cleaner; adds ``out_col``.

    online:  null->"" , drop author line, denoise, newline->". ", strip, lower,
             collapse whitespace, expand abbreviations, segment compounds,
             drop stopwords.
    offline: null->"", lower, expand abbreviations, segment, drop stopwords.
    With ``drop_blank`` the rows whose result is blank are dropped (C1).
    ``lexicons`` (from ``prepare_lexicons``) replaces the three lexicon tables.
    """
    if mode == "online":
        text = TX.online_text(text_col, strip_author)
    elif mode == "offline":
        text = TX.offline_text(text_col)
    else:
        raise ValueError(f"mode must be 'online' or 'offline', not {mode!r}")
    small = lexicons or prepare_lexicons(abbreviations, compounds, stopwords, max_bytes)
    if small is not None:
        clean = _vectorised(df.sparkSession.sparkContext.broadcast(small))
        out = df.withColumn(out_col, clean(text))
    else:
        out = _clean_by_join(df, text, abbreviations, compounds, stopwords, out_col)
    return out.filter(F.col(out_col) != "") if drop_blank else out
