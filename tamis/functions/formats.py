"""Structural checks of common training formats, as one boolean column each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.functions.messages import from_sharegpt, messages_valid
from tamis.functions.text import blank

#: Columns that a format needs.
COLUMNS = {
    "alpaca": ["instruction", "output"], "sharegpt": ["conversations"], "chatml": ["messages"], "dpo": ["prompt", "chosen", "rejected"], "kto": ["prompt", "completion", "label"], "plaintext": ["text"],
}


def _filled(c: str) -> Column:
    return F.coalesce(~blank(F.col(c).cast("string")), F.lit(False))


def is_valid(df: DataFrame, fmt: str) -> Column:
    """Whether a row is sound under the format; raises where the table lacks a column of it."""
    if fmt not in COLUMNS:
        raise ValueError(f"unknown format {fmt}; one of {sorted(COLUMNS)}")
    if lacking := [c for c in COLUMNS[fmt] if c not in df.columns]:
        raise ValueError(f"{fmt} needs {lacking}")
    if fmt == "sharegpt":
        return messages_valid(from_sharegpt(F.col("conversations")))
    if fmt == "chatml":
        return messages_valid(F.col("messages"))
    if fmt == "dpo":
        return _filled("prompt") & _filled("chosen") & _filled("rejected") & (F.col("chosen") != F.col("rejected"))
    if fmt == "kto":
        return _filled("prompt") & _filled("completion") & F.col("label").isNotNull()
    out = F.lit(True)
    for c in COLUMNS[fmt]:
        out = out & _filled(c)
    return out


def report(df: DataFrame, fmt: str) -> DataFrame:
    """One row: rows and sound rows."""
    return df.select(is_valid(df, fmt).alias("ok")).agg(F.count(F.lit(1)).alias("rows"), F.count_if("ok").alias("valid"))
