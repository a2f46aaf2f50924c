"""Column expressions for comment text.

All of them are native Catalyst expressions, so they stay inside whole-stage
codegen and never cross into Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab as V


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_to_empty(c: str | Column) -> Column:
    """Null becomes "", everything else its string form."""
    return F.coalesce(col_of(c).cast("string"), F.lit(""))


def strip_author(c: str | Column) -> Column:
    """B1: drop the first line (author name) only when a newline exists.

    Same result as removing AUTHOR_LINE_PATTERN, without a regex scan.
    """
    x = col_of(c)
    nl = F.instr(x, "\n")
    return F.when(nl > 0, x.substr(nl + 1, F.lit(2147483647))).otherwise(x)


def denoise(c: str | Column) -> Column:
    """B2: URLs, @mentions, e-mails and any non-word non-space char become one space.

    Texts without "@" take the reduced pattern (identical result, cheaper scan).
    """
    x = col_of(c)
    return F.when(F.instr(x, "@") > 0, F.regexp_replace(x, V.NOISE_PATTERN, " ")) \
        .otherwise(F.regexp_replace(x, V.NOISE_PATTERN_NO_AT, " "))


def strip_edges(c: str | Column) -> Column:
    return F.regexp_replace(col_of(c), V.EDGE_WHITESPACE, "")


def collapse_whitespace(c: str | Column) -> Column:
    return F.regexp_replace(col_of(c), V.WHITESPACE_RUN, " ")


def normalise(c: str | Column) -> Column:
    """Newline -> ". ", strip, lower, collapse whitespace, in that order.

    Lower-casing never creates or removes whitespace, so stripping before the
    collapse equals collapsing first and then trimming the single spaces left
    at the ends, which saves a regex pass.
    """
    x = F.replace(col_of(c), F.lit("\n"), F.lit(". "))
    return F.trim(collapse_whitespace(F.lower(x)))


def online_text(c: str | Column, strip_author_line: bool = True) -> Column:
    """B12 -> B1 -> B2 -> B3: the row-local part of the online cleaner."""
    x = null_to_empty(c)
    if strip_author_line:
        x = strip_author(x)
    return normalise(denoise(x))


def offline_text(c: str | Column) -> Column:
    """B12 -> lower -> whitespace split/join: the row-local part of the offline cleaner."""
    return F.trim(collapse_whitespace(F.lower(null_to_empty(c))))


def is_non_blank(c: str | Column) -> Column:
    """Keep rows whose text has a non-whitespace character."""
    return F.coalesce(strip_edges(col_of(c)) != F.lit(""), F.lit(False))


def text_fallback(df, candidates: list[str], default: str = "No content") -> Column:
    """First candidate column present in the schema, else a constant.

    The choice is made on the schema, then nulls fall back to the default.
    """
    present = [c for c in candidates if c in df.columns]
    if not present:
        return F.lit(default)
    return F.coalesce(F.col(present[0]).cast("string"), F.lit(default))


def short_id(key: str | Column | None = None) -> Column:
    """An 8-hex-digit id. Deterministic (sha-256 of a key) unless key is None."""
    if key is None:
        return F.substring(F.expr("uuid()"), 1, 8)
    return F.substring(F.sha2(col_of(key).cast("string"), 256), 1, 8)


def normalise_url(c: str | Column) -> Column:
    """Mobile hosts (mbasic., m.) become www."""
    return F.regexp_replace(col_of(c), r"://(mbasic|m)\.", "://www.")


def truncate_tokens(c: str | Column, n: int) -> Column:
    """Keep the first n whitespace tokens."""
    toks = F.split(strip_edges(col_of(c)), V.WHITESPACE_RUN)
    return F.array_join(F.slice(F.filter(toks, lambda x: x != F.lit("")), 1, n), " ")
