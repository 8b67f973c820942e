"""Casts and defaults that never fail a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_DDL = "decimal(18,4)"


def lenient_boolean(column: Column) -> Column:
    """'true', '1' and 'yes' in any case are true, other text is false, null stays null."""
    return F.lower(column).isin("true", "1", "yes")


def money(column: Column) -> Column:
    return column.try_cast(MONEY_DDL)


def is_blank(column: Column) -> Column:
    """Null or the empty string."""
    return column.isNull() | (column == "")


def is_falsy(column: Column, type_name: str) -> Column:
    """Null, empty text or zero, the values a required field may not have."""
    if type_name == "string":
        return is_blank(column)
    return column.isNull() | (column == 0)


def non_negative_gap(later: Column, earlier: Column) -> Column:
    return F.greatest(F.lit(0), later - earlier)


def positive_or_false(condition: Column) -> Column:
    """A condition for which unknown means no."""
    return F.coalesce(condition, F.lit(False))
