"""Depth intervals such as ``0-20`` and horizon bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamfold.functions.fixed import DEEP_MIN, SHALLOW_MAX
from loamfold.functions.nulls import flag, to_number


def _part(text: Column, position: int) -> Column:
    parts = F.split(F.replace(text, F.lit(" "), F.lit("")), "-")
    return to_number(F.try_element_at(parts, F.lit(position)))


def midpoint_split(text: Column) -> Column:
    """Mean of both sides of the dash; NULL unless both are numbers."""
    return (_part(text, 1) + _part(text, 2)) / F.lit(2.0)


def midpoint_regex(text: Column) -> Column:
    """Mean of the first two numbers in the text; a lone number stands for itself."""
    numbers = F.regexp_extract_all(text, F.lit(r"[\d.]+"), F.lit(0))
    first = to_number(F.try_element_at(numbers, F.lit(1)))
    second = to_number(F.try_element_at(numbers, F.lit(2)))
    return F.when(F.size(numbers) >= 2, (first + second) / F.lit(2.0)).when(F.size(numbers) == 1, first)


def midpoint(text: Column, profile: str) -> Column:
    return {"split": midpoint_split, "regex": midpoint_regex}[profile](text)


def bounds(text: Column) -> tuple[Column, Column]:
    """Upper and lower bound of the interval, NULL without a dash or without a number."""
    dashed = F.contains(text, F.lit("-"))
    return F.when(dashed, _part(text, 1)), F.when(dashed, _part(text, 2))


def depth_flags(mid: Column, profile: str) -> tuple[Column, Column]:
    """Shallow and deep flags under the profile's thresholds."""
    return flag(mid <= F.lit(SHALLOW_MAX[profile])), flag(mid > F.lit(DEEP_MIN[profile]))


def with_horizon(df: DataFrame, depth: str = "Depth_cm") -> DataFrame:
    """Horizon bounds, middle and thickness, from the horizon columns if the table has them, else from the interval."""
    if "horizon_upper" in df.columns:
        upper, lower = to_number(F.col("horizon_upper").cast("string")), to_number(F.col("horizon_lower").cast("string"))
        middle = (upper + lower) / F.lit(2.0)
    else:
        upper, lower = bounds(F.col(depth))
        middle = midpoint_split(F.col(depth))
    return df.withColumns(
        {
            "horizon_upper": upper,
            "horizon_lower": lower,
            "horizon_mid": middle,
            "horizon_thick": lower - upper,
        }
    )
