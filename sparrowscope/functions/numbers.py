"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; 0 where the denominator is zero or null."""
    return F.when(denominator != 0, numerator / denominator).otherwise(F.lit(0.0))


def sentinel_to_number(column: Column, sentinel: str = "Unavailable") -> Column:
    """Text counter to bigint: the sentinel counts as 0, anything that is not a
    64-bit integer becomes null (also in ANSI mode)."""
    text = column.cast("string")
    return F.when(text == sentinel, F.lit(0).cast("bigint")).otherwise(text.try_cast("bigint"))
