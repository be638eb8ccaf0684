"""Integer arithmetic that stays integer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_div(value: Column, by: int | Column) -> Column:
    """SQL ``DIV``: no detour through double."""
    divisor = F.lit(by) if isinstance(by, int) else by
    return F.call_function("div", value.cast("bigint"), divisor.cast("bigint"))


def ceil_div(value: Column, by: int) -> Column:
    return whole_div(value + (by - 1), by)
