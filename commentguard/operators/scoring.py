"""The two-stage scoring contract (J2) and the Python scoring hook.

``assemble_log`` turns per-comment logits into the monitor-log record entirely
with native expressions: severities by argmax, the is_hate flag, the stage-2
gate, thresholded type bits scattered back with "" for ungated rows, and the
decoded attack-type names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions import scores as S


def severities(df: DataFrame, heads: tuple[str, str, str] = ("ind", "grp", "soc")) -> DataFrame:
    """Stage 1: one argmax per head -> targets array<int>[3]."""
    return df.withColumn("targets", F.array(*[S.argmax(h) for h in heads]))


def type_bits(df: DataFrame, logits: str = "typ", threshold: float = V.TYPE_THRESHOLD,
              gate_level: int = V.GATE_LEVEL, strict: bool = True) -> DataFrame:
    """Stage 2 on gated rows only; ungated rows get "" (D5, B16, B22)."""
    bits = S.encode_bits(S.threshold(S.sigmoid(logits), threshold, strict))
    return df.withColumn("type_bits", F.when(S.gate("targets", gate_level), bits).otherwise(F.lit("")))


def assemble_log(scored: DataFrame, toxic_level: int = V.TOXIC_LEVEL, keep: list[str] | None = None) -> DataFrame:
    """J2 record assembly from (targets, type_bits): names, is_hate, type_attack."""
    hate = S.is_hate("targets", toxic_level)
    types = F.when(hate & (F.col("type_bits") != ""), S.decode_bits("type_bits")) \
        .otherwise(F.array().cast("array<string>"))
    named = [S.level_name(F.element_at("targets", i + 1)).alias(t) for i, t in enumerate(V.TARGETS)]
    return scored.select(*(keep or []), *named, types.alias("type_attack"), hate.alias("is_hate"))


def cascade(logits: DataFrame, keep: list[str] | None = None, threshold: float = V.TYPE_THRESHOLD,
            gate_level: int = V.GATE_LEVEL, toxic_level: int = V.TOXIC_LEVEL) -> DataFrame:
    """J2 end to end over logits columns (ind, grp, soc, typ)."""
    scored = type_bits(severities(logits), threshold=threshold, gate_level=gate_level)
    out = assemble_log(scored, toxic_level, keep=(keep or []) + ["targets", "type_bits"])
    return out


def attach_scores(comments: DataFrame, scores: DataFrame, id_col: str = "id", text_col: str = "cmt",
                  order_col: str | None = None) -> DataFrame:
    """Scores keep the original text by id, "" when absent.

    Only comments that have a score are kept, then one text per id: that with the greatest
    ``order_col`` (the last to arrive), ties and no order column: the greatest text.
    """
    scored = comments.join(scores.select(id_col), id_col, "left_semi")
    last = F.max(text_col) if order_col is None else F.max_by(F.col(text_col), F.struct(order_col, text_col))
    texts = scored.groupBy(id_col).agg(last.alias(text_col))
    out = scores.join(texts, id_col, "left")
    return out.withColumn(text_col, F.coalesce(F.col(text_col), F.lit("")))


def score_with(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
               chunk: int = 128) -> DataFrame:
    """Apply a pandas scoring function per chunk of ``chunk`` rows, stays a DataFrame.

    Spark streams Arrow batches to the Python worker; we cut them into chunks
    so a remote or model call never sees more than ``chunk`` rows, and results
    flow back batch by batch (nothing is buffered per partition).
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for start in range(0, len(pdf), chunk):
                yield fn(pdf.iloc[start:start + chunk])

    return df.mapInPandas(run, schema)
