"""Date expressions and banding."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band labels, upper bounds and sort positions (the stay labels use an en dash).
AGE_BANDS = [("0-17", 18, 1), ("18-34", 35, 2), ("35-49", 50, 3), ("50-64", 65, 4)]
AGE_LAST = ("65+", 5)
AGE_UNKNOWN = ("Unknown", 99)
STAY_BANDS = [
    ("0 – 1 day", 1, 1),
    ("2 – 3 days", 3, 2),
    ("4 – 7 days", 7, 3),
    ("8 – 14 days", 14, 4),
    ("15 – 30 days", 30, 5),
]
STAY_LAST = ("30+ days", 6)
STAY_UNKNOWN = ("Not Applicable", 99)


def day_or_null(value: Column) -> Column:
    """Calendar day of a text value; partial dates start their period, dirty text gives null."""
    return F.try_to_date(value)


def date_key(day: Column) -> Column:
    """Integer ``yyyyMMdd`` key."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def age_in_years(birth: Column, as_of: date) -> Column:
    """Whole years by the 365.25-day rule."""
    return F.floor(F.datediff(F.lit(as_of), birth) / F.lit(365.25)).cast("int")


def implausible(day: Column, min_year: int, max_year: int | None = None) -> Column:
    """True for a date outside the year range (up to the current year unless told); false for null."""
    last = F.year(F.current_date()) if max_year is None else F.lit(max_year)
    outside = (F.year(day) < min_year) | (F.year(day) > last)
    return F.coalesce(outside, F.lit(False))


def _banded(value: Column, bands, last, unknown, field: int, below) -> Column:
    out = F.when(value.isNull(), F.lit(unknown[field]))
    for label, bound, position in bands:
        out = out.when(below(value, bound), F.lit((label, position)[field]))
    return out.otherwise(F.lit(last[field]))


def age_band(age: Column) -> Column:
    return _banded(age, AGE_BANDS, AGE_LAST, AGE_UNKNOWN, 0, lambda v, b: v < b)


def age_band_position(age: Column) -> Column:
    return _banded(age, AGE_BANDS, AGE_LAST, AGE_UNKNOWN, 1, lambda v, b: v < b).cast("int")


def stay_band(days: Column) -> Column:
    return _banded(days, STAY_BANDS, STAY_LAST, STAY_UNKNOWN, 0, lambda v, b: v <= b)


def stay_band_position(days: Column) -> Column:
    return _banded(days, STAY_BANDS, STAY_LAST, STAY_UNKNOWN, 1, lambda v, b: v <= b).cast("int")
