"""Column expressions for scores and labels.

Arrays are handled with higher-order functions, so the whole scoring
contract stays a native projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab as V
from .text import col_of


def to_double_array(c: str | Column) -> Column:
    return F.transform(col_of(c), lambda x: x.cast("double"))


def bind(value: Column, body) -> Column:
    """body(value) with the value worked out once per row, also inside the body's lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def softmax(c: str | Column) -> Column:
    """Numerically stable softmax (subtract the max first)."""
    arr = to_double_array(c)
    return bind(arr, lambda a: bind(F.array_max(a), lambda m: bind(
        F.transform(a, lambda x: F.exp(x - m)), lambda ex: bind(
            F.aggregate(ex, F.lit(0.0), lambda acc, x: acc + x), lambda total: F.transform(ex, lambda x: x / total)))))


def argmax(c: str | Column) -> Column:
    """0-based index of the maximum; the first maximum wins."""
    arr = to_double_array(c)
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def sigmoid(c: str | Column) -> Column:
    """Element-wise logistic function."""
    return F.transform(to_double_array(c), lambda x: F.lit(1.0) / (F.lit(1.0) + F.exp(-x)))


def threshold(probs: str | Column, t: float = V.TYPE_THRESHOLD, strict: bool = True) -> Column:
    """0/1 per element; serving uses strict ``> t``, evaluation ``>= t``."""
    tl = F.lit(float(t))
    return F.transform(col_of(probs), lambda p: F.when(p > tl if strict else p >= tl, 1).otherwise(0))


def is_hate(targets: str | Column, level: int = V.TOXIC_LEVEL) -> Column:
    """Any severity >= level."""
    return F.exists(col_of(targets), lambda x: x >= level)


def gate(targets: str | Column, level: int = V.GATE_LEVEL) -> Column:
    """Stage-2 gate, any severity == level."""
    return F.exists(col_of(targets), lambda x: x == level)


def level_name(code: str | Column) -> Column:
    """Severity code -> name; anything else -> Unknown."""
    c = col_of(code)
    expr = None
    for k, name in V.LEVEL_NAMES.items():
        expr = F.when(c == k, name) if expr is None else expr.when(c == k, name)
    return expr.otherwise(V.UNKNOWN_LEVEL)


def encode_bits(bits: str | Column, width: int = len(V.TYPE_ATTACK_LABELS)) -> Column:
    """0/1 array -> string truncated or right-padded with '0' to ``width``."""
    s = F.array_join(F.transform(col_of(bits), lambda b: b.cast("string")), "")
    return F.rpad(F.substring(s, 1, width), width, "0")


def decode_bits(bits: str | Column, labels: list[str] | None = None) -> Column:
    """Bit string -> label names whose bit is '1', in index order; extra bits ignored."""
    names = F.array(*[F.lit(n) for n in (labels or V.TYPE_ATTACK_LABELS)])
    b = col_of(bits)
    picked = F.transform(names, lambda n, i: F.when(F.substring(b, i + 1, 1) == "1", n))
    return F.filter(picked, lambda x: x.isNotNull())


def split_tags(c: str | Column) -> Column:
    """B17: "A, B" -> [A, B]; trimmed, empties dropped, null -> []."""
    parts = F.transform(F.split(F.coalesce(col_of(c).cast("string"), F.lit("")), ","), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def one_hot(tags: str | Column, labels: list[str] | None = None) -> Column:
    """Fixed-order 0/1 vector; unknown tags are ignored."""
    names = F.array(*[F.lit(n) for n in (labels or V.TYPE_ATTACK_LABELS)])
    t = col_of(tags)
    return F.transform(names, lambda n: F.array_contains(t, n).cast("int"))


def from_one_hot(bits: str | Column, labels: list[str] | None = None) -> Column:
    """Inverse of B18: 0/1 vector -> names in index order."""
    names = F.array(*[F.lit(n) for n in (labels or V.TYPE_ATTACK_LABELS)])
    b = col_of(bits)
    return F.filter(F.transform(names, lambda n, i: F.when(F.element_at(b, i + 1) == 1, n)),
                    lambda x: x.isNotNull())


def has_known_label(tags: str | Column, labels: list[str] | None = None) -> Column:
    """At least one tag is in the vocabulary."""
    names = F.array(*[F.lit(n) for n in (labels or V.TYPE_ATTACK_LABELS)])
    return F.arrays_overlap(col_of(tags), names)


def coerce_level(c: str | Column, lo: int = 0, hi: int = 3) -> Column:
    """Non-numeric and NaN -> 0, clip to [lo, hi] (infinities too), truncate to int."""
    x = F.coalesce(F.expr(f"try_cast({_sql_name(c)} as double)"), F.lit(0.0))
    x = F.when(F.isnan(x), 0.0).otherwise(x)
    return F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), x)).cast("int")


def _sql_name(c: str | Column) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("coerce_level takes a column name")
