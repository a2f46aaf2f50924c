"""Sub-word tag handling and accent restoration.

B23/B24 consume per-sub-word predictions (id, pos, token, tag_idx): pieces are
merged into words per id and the tag rule is applied per word. B25 replaces the neural accent tagger by corpus
statistics: an unaccented token takes the most frequent accented form of
its folded spelling.
"""

from __future__ import annotations

import unicodedata
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sizing import BROADCAST_BYTES, fits, maybe_broadcast
from .lookup import Replacer, slices, words_of

WORD_PREFIX = "▁"  # sentencepiece word-start marker
# Frequent words whose lines of a large table are sent to the tasks: at most so many, and as fit at so many bytes each.
HOT_WORDS, HOT_BYTES = 200_000, 256
TAG_ROWS = 4096


def merge_subwords(pred: DataFrame, prefix: str = WORD_PREFIX, id_col: str = "id") -> DataFrame:
    """B23 + F4: (id, pos, token, tag_idx) -> (id, word_pos, word, tags, pieces).

    A token starting with ``prefix`` starts a word and loses the prefix; the
    following unprefixed tokens are appended. Tokens before the first
    prefixed one are words on their own. ``tags`` is the sorted set of tag
    indices seen in the word; ``pieces`` keeps (pos, tag_idx) for B24. The pieces of
    an id are put in order once, as one array that is cut into words where they start
    (by ``sort_array``: ``array_sort`` evaluates a lambda at each comparison).
    """
    piece = F.struct("pos", "token", "tag_idx")
    whole = pred.groupBy(id_col).agg(F.sort_array(F.collect_list(piece)).alias("__p")) \
        .withColumn("__pre", F.transform("__p", lambda x: F.coalesce(x["token"].startswith(prefix), F.lit(False)))) \
        .withColumn("__first", F.coalesce(F.nullif(F.array_position("__pre", True), F.lit(0)), F.size("__p") + 1).cast("int")) \
        .withColumn("__starts", F.filter(F.sequence(F.lit(1), F.size("__p")), lambda i: (i <= F.col("__first")) | F.get("__pre", i - 1)))
    words = F.transform("__starts", lambda s, i: F.slice("__p", s, F.coalesce(F.get("__starts", i + 1), F.size("__p") + 1) - s))
    return whole.select(id_col, F.posexplode(words).alias("__i", "__w")).select(
        id_col, (F.col("__i") + 1).cast("long").alias("word_pos"),
        F.array_join(F.transform("__w", lambda x: F.when(x["token"].startswith(prefix), F.substr(x["token"], F.lit(len(prefix) + 1))).otherwise(x["token"])), "").alias("word"),
        F.array_sort(F.array_distinct(F.transform("__w", lambda x: x["tag_idx"]))).alias("tags"),
        F.transform("__w", lambda x: F.struct(x["pos"].alias("pos"), x["tag_idx"].alias("tag_idx"))).alias("pieces"),
    )


def apply_tags(words: DataFrame, tag_table: DataFrame, id_col: str = "id",
               max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per word, the first piece (lowest position) whose tag has a non-empty ``raw``
    contained in the word replaces every occurrence of ``raw`` by ``accented``;
    words without such a tag stay. Returns (id, text) with words joined by spaces.

    A table of at most ``TAG_ROWS`` lines that is proven small goes to every word as one map, so
    words stay where they are; a larger one is joined to the pieces.
    """
    tags = tag_table.select("tag_idx", "raw", "accented").filter(F.col("raw").isNotNull() & (F.col("raw") != "") & F.col("tag_idx").isNotNull())
    if tags.limit(TAG_ROWS + 1).count() <= TAG_ROWS and fits(tags, max_bytes=max_bytes):
        by_tag = tags.groupBy("tag_idx").agg(F.collect_list(F.struct("raw", "accented")).alias("rules")) \
            .agg(F.map_from_entries(F.collect_list(F.struct("tag_idx", "rules"))).alias("__tags"))
        hit = F.transform("pieces", lambda p: F.transform(
            F.filter(F.try_element_at("__tags", p["tag_idx"]), lambda r: F.instr(F.col("word"), r["raw"]) > 0),
            lambda r: F.struct(p["pos"].alias("pos"), r["raw"].alias("raw"), r["accented"].alias("accented"))))
        rule = F.when(F.col(id_col).isNotNull() & F.col("word_pos").isNotNull(), F.array_min(F.flatten(F.filter(hit, lambda h: h.isNotNull()))))
        ruled = words.crossJoin(F.broadcast(by_tag)).select(id_col, "word_pos", "word", rule.alias("rule"))
    else:
        pieces = words.select(id_col, "word_pos", "word", F.explode("pieces").alias("pc")) \
            .select(id_col, "word_pos", "word", F.col("pc.pos").alias("pos"), F.col("pc.tag_idx").alias("tag_idx"))
        hits = pieces.join(maybe_broadcast(tags, max_bytes), "tag_idx") \
            .filter(F.instr(F.col("word"), F.col("raw")) > 0) \
            .groupBy(id_col, "word_pos").agg(F.min(F.struct("pos", "raw", "accented")).alias("rule"))
        ruled = words.join(hits, [id_col, "word_pos"], "left")
    fixed = ruled.select(
        id_col, "word_pos",
        F.when(F.col("rule").isNull(), F.col("word"))
         .otherwise(F.replace(F.col("word"), F.col("rule.raw"), F.col("rule.accented"))).alias("word"))
    return fixed.groupBy(id_col).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("word_pos", "word"))), lambda x: x.word),
                     " ").alias("text"))


def _fold_pairs() -> tuple[str, str]:
    """Accented Latin letters -> base letter, from Unicode decomposition (a rule, not a list)."""
    src, dst = [], []
    ranges = [(0x00C0, 0x0250), (0x1E00, 0x1F00)]
    for lo, hi in ranges:
        for cp in range(lo, hi):
            ch = chr(cp)
            base = unicodedata.normalize("NFD", ch)[0]
            if base != ch and base.isascii() and base.isalpha():
                src.append(ch)
                dst.append(base)
    for ch, base in (("đ", "d"), ("Đ", "D"), ("ø", "o"), ("Ø", "O"), ("ł", "l"), ("Ł", "L")):
        src.append(ch)
        dst.append(base)
    return "".join(src), "".join(dst)


FOLD_FROM, FOLD_TO = _fold_pairs()


def fold(c):
    """Strip accents from Latin letters with one native ``translate``."""
    col = F.col(c) if isinstance(c, str) else c
    return F.translate(col, FOLD_FROM, FOLD_TO)


def kept(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read again."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def word_counts(texts: DataFrame, text_col: str = "__t") -> DataFrame:
    """(word, n): the words between single spaces, counted with partial aggregation."""
    return texts.select(F.explode(F.split(text_col, " ")).alias("word")).filter(F.col("word") != "") \
        .groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """The rows of counts with the greatest ``n``: those of at least a power of two, as low as leaves ``most`` rows or fewer."""
    powers = counts.groupBy(F.floor(F.log2("n")).alias("power")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("power")).collect()  # 64 rows at most
    least = 64
    for r in powers:
        most -= r["rows"]
        if most < 0:
            break
        least = r["power"]
    return counts.where(F.col("n") >= 1 << least) if least < 64 else counts.limit(0)


def _rare_words(shared):
    @F.arrow_udf("array<string>")
    def rare(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = pa.array(list(shared.value), pa.string())
        kind = pa.list_(pa.string())
        for texts in batches:
            out = []
            for part in slices(texts):
                distinct, codes, off = words_of(part)
                fresh = ~pc.is_in(distinct, value_set=known).to_numpy(zero_copy_only=False) if len(known) else np.ones(len(distinct), bool)
                row = np.repeat(np.arange(len(part)), np.diff(off))
                take = fresh[codes]
                once = np.unique(row[take] * max(len(distinct), 1) + codes[take])
                ends = np.searchsorted(once, np.arange(len(part) + 1) * max(len(distinct), 1))
                out.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), distinct.take(pa.array(once % max(len(distinct), 1)))))
            yield pa.chunked_array(out, kind).combine_chunks()

    return rare


def looked_up(texts: DataFrame, table: DataFrame, counts: DataFrame | None, max_bytes: int = BROADCAST_BYTES,
              text_col: str = "__t") -> tuple[dict, DataFrame]:
    """Lines of a large ``table`` (word, value; unaccented words) for the words of texts.

    Returns the lines of frequent words, by ``counts`` (word, n), as a dict (None: the table has no
    such line), and (__h, found (word, value)) for the other words, by the text's xxhash64. Each text
    asks once for each such word, so a row holds no text; texts that share a hash share their
    lines, which hold for any text.
    """
    hot = {}
    if counts is not None:
        words = frequent(counts, min(HOT_WORDS, max_bytes // HOT_BYTES))
        hot = {r["word"]: r["value"] for r in words.select("word").join(table, "word", "left").collect()}
    rare = _rare_words(texts.sparkSession.sparkContext.broadcast(hot))
    asked = texts.select(F.xxhash64(text_col).alias("__h"), rare(text_col).alias("words")) \
        .select("__h", F.explode("words").alias("word")).where(F.col("word") == fold("word"))
    return hot, asked.join(table, "word").groupBy("__h").agg(F.collect_set(F.struct("word", "value")).alias("found"))


def accent_dictionary(tokens: DataFrame, word_col: str = "w") -> DataFrame:
    """B25 statistics: folded spelling -> most frequent accented form.

    Counting (folded, form) pairs is a partial-aggregated group-by, so very
    frequent words collapse before the shuffle. Ties: higher count, then the
    greater form. Only folded keys that have an accented form are kept.
    """
    counts = tokens.select(fold(word_col).alias("folded"), F.col(word_col).alias("form")) \
        .filter(F.col("folded") != F.col("form")) \
        .groupBy("folded", "form").agg(F.count(F.lit(1)).alias("n"))
    return _most_frequent(counts)


def _most_frequent(counts: DataFrame) -> DataFrame:
    return counts.groupBy("folded").agg(F.max_by("form", F.struct("n", "form")).alias("restored"))


def _restorer(shared):
    @F.arrow_udf("string")
    def restore(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        replacer = Replacer({k: [w] for k, w in shared.value.items()})
        for texts in batches:
            yield pa.chunked_array([replacer.apply(part) for part in slices(texts)], pa.string()).combine_chunks()

    return restore


def _restorer_of_rest(shared):
    """Frequent words by the shared table, others by what was found for the texts of a slice: an entry of one text holds for all."""
    @F.arrow_udf("string")
    def restore(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        replacer = Replacer({k: [w] for k, w in shared.value.items() if w is not None})
        for texts, found in batches:
            out, at = [], 0
            for part in slices(texts):
                entries = found.slice(at, len(part)).flatten()
                rest = Replacer({k: [w] for k, w in zip(entries.field("word").to_pylist(), entries.field("value").to_pylist())})
                out.append(rest.apply(replacer.apply(part)))
                at += len(part)
            yield pa.chunked_array(out, pa.string()).combine_chunks()

    return restore


def restore_accents(docs: DataFrame, id_col: str = "id", text_col: str = "text",
                    dictionary: DataFrame | None = None, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(id, text) -> (id, restored): every unaccented token whose spelling has an
    accented form in the corpus takes the most frequent one; tokens are split on
    single spaces of the lower-cased, whitespace-collapsed text.

    Statistics count every row, from the scan, with partial aggregation. A dictionary that is
    proven small is sent to the tasks and applied row by row without an exchange. Of a larger one,
    the lines of the most frequent words are sent; the other words of a text meet it in a join, once
    each and without their text, and the lines found go to the text by its hash (see ``looked_up``).
    """
    from ..functions.text import offline_text

    base = docs.select(id_col, offline_text(text_col).alias("__t"))
    counts = None
    if dictionary is None:
        counts = kept(word_counts(base), "words")  # measured and read again below
        forms = counts.select(fold("word").alias("folded"), F.col("word").alias("form"), "n").filter(F.col("folded") != F.col("form"))
        dictionary = kept(_most_frequent(forms), "accents")
    if fits(dictionary, max_bytes=max_bytes):
        table = {r["folded"]: r["restored"] for r in dictionary.collect()}
        restore = _restorer(docs.sparkSession.sparkContext.broadcast(table))
        return base.select(id_col, restore("__t").alias("restored"))
    hot, found = looked_up(base, dictionary.select(F.col("folded").alias("word"), F.col("restored").alias("value")), counts, max_bytes)
    restore = _restorer_of_rest(docs.sparkSession.sparkContext.broadcast(hot))
    none = F.array().cast(found.schema["found"].dataType)
    return base.withColumn("__h", F.xxhash64("__t")).join(found, "__h", "left") \
        .select(id_col, restore("__t", F.coalesce("found", none)).alias("restored"))
