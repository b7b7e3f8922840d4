"""Aggregate expressions with the blank rules of the semantic model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_if_zero(count: Column) -> Column:
    """Counting no rows gives blank rather than 0."""
    return F.nullif(count, F.lit(0).cast("bigint"))


def rows(condition: Column | None = None) -> Column:
    """Row count, all rows or those meeting ``condition``; blank if none."""
    return blank_if_zero(F.count(F.lit(1)) if condition is None else F.count_if(condition))


def distinct_with_blank(value: Column) -> Column:
    """Distinct values where null counts as one more value; blank over no rows."""
    has_null = F.coalesce(F.max(value.isNull().cast("int")), F.lit(0))
    return blank_if_zero(F.count_distinct(value) + has_null)


def divide(numerator: Column, denominator: Column, alternate: Column) -> Column:
    """Ratio with ``alternate`` for an empty or zero denominator; a blank numerator stays blank."""
    usable = denominator.isNotNull() & (denominator != 0)
    return F.when(usable, numerator / denominator).otherwise(alternate)


def only_value(value: Column, default: str) -> Column:
    """The single distinct value as text, or ``default`` when there are none or several."""
    one = (F.count_distinct(value) + F.coalesce(F.max(value.isNull().cast("int")), F.lit(0))) == 1
    return F.when(one, F.coalesce(F.max(value).cast("string"), F.lit(""))).otherwise(F.lit(default))
