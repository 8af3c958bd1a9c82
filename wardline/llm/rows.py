"""Whole input rows carried as one struct, so that no column of theirs can clash with an operator's own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def packed(docs: DataFrame, **named: Column) -> DataFrame:
    """``_row`` (all columns as a struct) and the named expressions over ``docs``."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(whole.alias("_row"), *[c.alias(name) for name, c in named.items()])


def unpacked(rows: DataFrame, docs: DataFrame, **replaced: Column) -> DataFrame:
    """The columns of ``docs`` again, some of them replaced."""
    return rows.select(*[(replaced[c] if c in replaced else F.col("_row").getField(c)).alias(c) for c in docs.columns])
