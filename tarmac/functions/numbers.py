"""Exact numeric rules shared by the cleaning and aggregation code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Wide enough for a 64-bit integer part and exact for every decimal literal a payload carries.
EXACT = "decimal(38,18)"


def half_away(value: Column, to: str) -> Column:
    """Round a decimal half away from zero into an integer type; overflow gives NULL."""
    return F.round(value, 0).try_cast(to)


def truncate(value: Column, scale: int) -> Column:
    """Cut a decimal toward zero."""
    return F.when(value < 0, F.ceil(value, F.lit(scale))).otherwise(F.floor(value, F.lit(scale)))
