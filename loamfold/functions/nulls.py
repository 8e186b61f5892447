"""Null-safe building blocks. A missing measurement is NULL throughout, never NaN."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loamfold.functions.fixed import EPSILON

_NUMBER = r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$"


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def clip_lower(value: Column, floor: float = 0.0) -> Column:
    """Raise values to ``floor``; a missing value stays missing (``greatest`` would drop it)."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(floor)))


def to_number(text: Column) -> Column:
    """Text to double; anything that is not a plain decimal number becomes NULL."""
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def nodata_to_null(value: Column, nodata: Column) -> Column:
    return F.nullif(value, nodata)


def padded_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio with a small constant under the line, so a zero denominator stays finite."""
    return F.try_divide(numerator, denominator + F.lit(EPSILON))


def log_positive(value: Column) -> Column:
    """``log1p`` of the value floored at zero."""
    return F.log1p(clip_lower(value))


def from_log(value: Column) -> Column:
    """Back from the log scale, floored at zero."""
    return clip_lower(F.expm1(value))
