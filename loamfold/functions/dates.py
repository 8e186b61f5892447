"""Collection dates: day-first parsing, parts with defaults, durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loamfold.functions.fixed import DATE_LAYOUTS, DEFAULT_DECADE, WET_MONTHS
from loamfold.functions.nulls import flag


def parse_dayfirst(text: Column, layouts: list[str] | None = None) -> Column:
    """Text to date by a declared list of layouts; text that fits none becomes NULL."""
    attempts = [F.try_to_timestamp(text, F.lit(layout)) for layout in layouts or DATE_LAYOUTS]
    return F.coalesce(*attempts).cast("date")


def year_or(date: Column, default: int) -> Column:
    return F.coalesce(F.year(date), F.lit(default))


def month_or(date: Column, default: int) -> Column:
    return F.coalesce(F.month(date), F.lit(default))


def duration_days(start: Column, end: Column) -> Column:
    """Days from start to end; 0 if either is missing."""
    return F.coalesce(F.datediff(end, start), F.lit(0))


def decade(year: Column) -> Column:
    return F.coalesce((F.floor(year / F.lit(10.0)) * 10).cast("int"), F.lit(DEFAULT_DECADE))


def year_span(start_year: Column, end_year: Column) -> Column:
    return end_year - start_year


def year_middle(start_year: Column, end_year: Column) -> Column:
    return (start_year + end_year) / F.lit(2.0)


def wet_season(month: Column) -> Column:
    return flag(month.isin(WET_MONTHS))


def trailing_year(text: Column, default: int) -> Column:
    """The last four characters as a year, or the default when they are not a number."""
    return F.coalesce(F.right(F.trim(text), F.lit(4)).try_cast("int"), F.lit(default))
