"""Descriptive statistics in long form, one pass over the rows wherever the statistic allows it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamfold.functions.fixed import DESCRIBE_FRACTIONS, HISTOGRAM_BINS
from loamfold.functions.nulls import log_positive
from loamfold.operators.quantiles import exact_medians, exact_quantiles, long_form
from loamfold.session import stored


def per_column(df: DataFrame, columns: Sequence[str], measures: dict[str, callable], keys: Sequence[str] = ()) -> DataFrame:
    """Every measure of every column, as rows ``(*keys, metric, measures…)``.

    The columns are stacked and combined by name on the map side: a few aggregates
    over one value column stay within generated code, hundreds over a wide row do not.
    """
    stacked = df.select(*keys, *columns).unpivot(list(keys), list(columns), "metric", "value")
    results = stacked.groupBy(*keys, "metric").agg(*[fn(F.col("value")).alias(name) for name, fn in measures.items()])
    if keys:
        return results
    names = df.sparkSession.range(len(columns)).select(F.get(F.lit(list(columns)), F.col("id").cast("int")).alias("metric"))
    return names.join(results, "metric", "left")


def shapes(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per named table."""
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_cols")
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def column_types(df: DataFrame) -> DataFrame:
    """Columns with their types, as the schema states them, positions, and the values they hold."""
    cells = [
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("column_name"), F.lit(kind).alias("data_type"), F.count(name).alias("n_values"))
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def missing_pct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Percentage missing per column, only columns with any."""
    gaps = df.select(*[F.col(c).isNull().cast("double").alias(c) for c in columns])
    rates = per_column(gaps, columns, {"missing_pct": lambda c: F.avg(c) * 100.0})
    return rates.where(F.col("missing_pct") > 0)


def target_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, exact median and maximum per column."""
    plain = per_column(df, columns, {"mean": F.avg, "max": F.max})
    medians = exact_quantiles(df, columns, [0.5]).select("metric", F.col("q0").alias("median"))
    return plain.join(medians, "metric", "left")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def group_medians(df: DataFrame, key: str, columns: Sequence[str], keep_null_group: bool) -> DataFrame:
    """Exact median of each column per class."""
    rows = df if keep_null_group else df.where(F.col(key).isNotNull())
    return exact_medians(rows, columns, [key])


def sample_skew(value: Column) -> Column:
    """Bias-adjusted skewness; NULL below three values or without spread."""
    n = F.count(value).cast("double")
    adjusted = F.skewness(value) * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0))
    return F.when((n > 2) & (F.stddev_pop(value) > 0), adjusted)


def cv_pct(value: Column) -> Column:
    """Coefficient of variation in percent, one decimal."""
    return F.round(F.try_divide(F.stddev_samp(value), F.avg(value)) * 100.0, 1)


def describe(df: DataFrame, columns: Sequence[str], fractions: Sequence[float] = tuple(DESCRIBE_FRACTIONS)) -> DataFrame:
    """Count, mean, deviation, extremes and exact quantiles per column."""
    plain = per_column(
        df,
        columns,
        {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max},
    )
    named = [F.col(f"q{i}").alias(f"p{round(f * 100)}") for i, f in enumerate(fractions)]
    return plain.join(exact_quantiles(df, columns, fractions).select("metric", *named), "metric", "left")


def histogram(df: DataFrame, columns: Sequence[str], bins: int = HISTOGRAM_BINS, log: bool = False) -> DataFrame:
    """Equal-width bins between minimum and maximum, the last bin closed on the right: ``(metric, bin, n)``."""
    rows = long_form(df, columns).where(F.col("value").isNotNull())
    if log:
        rows = rows.where(F.col("value") > 0).withColumn("value", log_positive(F.col("value")))
    limits = stored(rows.groupBy("metric").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi")), "limits")
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    place = F.coalesce(F.floor(F.try_divide(F.col("value") - F.col("_lo"), width)), F.lit(0))
    return (
        rows.join(limits, "metric")
        .groupBy("metric", F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
    )


def box_stats(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers and outlier counts of the log values per class and column."""
    logs = df.where(F.col(key).isNotNull()).select(key, *[log_positive(F.col(c)).alias(c) for c in columns])
    rows = long_form(logs, columns, [key]).where(F.col("value").isNotNull())
    quartiles = stored(exact_quantiles(logs, columns, [0.25, 0.5, 0.75], [key]), "quartiles")
    fences = quartiles.select(
        key,
        "metric",
        F.col("q0").alias("q1"),
        F.col("q1").alias("median"),
        F.col("q2").alias("q3"),
        (F.col("q0") - 1.5 * (F.col("q2") - F.col("q0"))).alias("_low"),
        (F.col("q2") + 1.5 * (F.col("q2") - F.col("q0"))).alias("_high"),
    )
    inside = F.col("value").between(F.col("_low"), F.col("_high"))
    return (
        rows.join(fences, [key, "metric"])
        .groupBy(key, "metric", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def mask_coverage(mask: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Kept count and percentage per column and over all columns (``metric = 'all'``)."""
    per = per_column(mask, columns, {"kept": lambda c: F.sum(c.cast("bigint")), "cells": F.count})
    both = per.unionByName(
        per.agg(F.lit("all").alias("metric"), F.sum("kept").alias("kept"), F.sum("cells").alias("cells"))
    )
    return both.select("metric", "kept", (F.try_divide(F.col("kept"), F.col("cells")) * 100.0).alias("kept_pct"))


def nonnull_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return per_column(df, columns, {"n": F.count})


def nonzero_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, minimum, exact median and maximum of the values above zero."""
    positive = df.select(*[F.when(F.col(c) > 0, F.col(c)).alias(c) for c in columns])
    plain = per_column(positive, columns, {"n": F.count, "mean": F.avg, "min": F.min, "max": F.max})
    medians = exact_quantiles(positive, columns, [0.5]).select("metric", F.col("q0").alias("median"))
    return plain.join(medians, "metric", "left")


def linear_trend(df: DataFrame, x: str, targets: Sequence[str], points: int = 100) -> DataFrame:
    """Straight-line fit of each ``log1p`` target on ``x`` and the line at evenly spaced points."""
    logs = df.select(F.col(x).alias("_x"), *[F.log1p(F.when(F.col(t) > -1, F.col(t))).alias(t) for t in targets])
    pairs = logs.unpivot(["_x"], list(targets), "metric", "_y").where("_x is not null and _y is not null")
    slope = F.try_divide(F.covar_pop("_y", "_x"), F.var_pop("_x"))
    fits = pairs.groupBy("metric").agg(
        slope.alias("slope"),
        (F.avg("_y") - slope * F.avg("_x")).alias("intercept"),
        F.min("_x").alias("_lo"),
        F.max("_x").alias("_hi"),
    )
    step = F.col("k") / F.lit(float(points - 1))
    grid = fits.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).withColumn(
        "x", F.col("_lo") + (F.col("_hi") - F.col("_lo")) * step
    )
    return grid.select(
        "metric", "k", "slope", "intercept", "x", (F.col("slope") * F.col("x") + F.col("intercept")).alias("y")
    )


def climate_normals(daily: DataFrame, key: str, temperature: str, rain: str, year_days: int) -> DataFrame:
    """Mean and deviation of temperature and yearly rain per key, from parallel arrays of daily values with gaps."""
    days = daily.select(key, F.inline_outer(F.arrays_zip(F.col(temperature).alias("t"), F.col(rain).alias("p"))))
    years = F.greatest(F.floor(F.count("p") / F.lit(float(year_days))), F.lit(1))
    return days.groupBy(key).agg(
        F.avg("t").alias("climate_annual_temp_mean"),
        F.try_divide(F.sum("p"), years).alias("climate_annual_precip_mm"),
        F.stddev_pop("t").alias("climate_temp_std"),
    )
