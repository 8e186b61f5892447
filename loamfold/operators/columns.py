"""Projections and filters that adapt to the columns a table has."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamfold.functions.fixed import RATIO_PAIRS, SEED
from loamfold.operators.quantiles import exact_medians
from loamfold.session import stored

_NUMERIC = (T.NumericType,)
#: Ratios between targets, as either profile names them: they would leak the answer into the features.
TARGET_RATIOS = [name for a, b in RATIO_PAIRS for name in (f"{a}_{b}_ratio", f"ratio_{a}_{b}")]


def keep(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns the table has, in the given order."""
    return df.select(*[c for c in columns if c in df.columns])


def drop(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The table without the named columns; absent names are ignored."""
    return df.drop(*columns)


def id_first(df: DataFrame, key: str = "ID") -> DataFrame:
    return df.select(key, *[c for c in df.columns if c != key])


def prefixed(df: DataFrame, prefix: str, key: str = "ID") -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns if c != key})


def conform(df: DataFrame, template: Sequence[str]) -> DataFrame:
    """Exactly the template's columns in its order; absent ones are 0.0."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(0.0).alias(c) for c in template])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def feature_columns(
    df: DataFrame, targets: Sequence[str], key: str = "ID", derived: Sequence[str] = TARGET_RATIOS
) -> list[str]:
    """Numeric columns that are neither key, nor targets, nor derived from targets (their logs and ratios)."""
    excluded = {key, *targets, *derived, *[f"log_{t}" for t in targets]}
    return [c for c in numeric_columns(df) if c not in excluded and not c.startswith("Target_")]


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """Columns of ``left`` that ``right`` has too, in the order of ``left``."""
    return [c for c in left.columns if c in right.columns]


def ensure(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add the columns (name to type) the table lacks, as NULL."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def rows_with(df: DataFrame, target: str) -> DataFrame:
    return df.where(F.col(target).isNotNull())


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def fill_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.na.fill({c: v for c, v in values.items() if c in df.columns})


def fit_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One stored row with the exact median of every column."""
    return stored(exact_medians(df, columns), "medians")


def fill_medians(df: DataFrame, medians: DataFrame) -> DataFrame:
    """Fill missing values from the one row of ``medians``, read as a scalar subquery."""
    row = medians.select(F.struct(*medians.columns)).scalar()
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), row.getField(c)) for c in medians.columns if c in df.columns}
    )


def coalesce_alternates(df: DataFrame, columns: Sequence[str], suffix: str = "_dates") -> DataFrame:
    """Fill each column from its suffixed twin and drop the twin."""
    present = [c for c in columns if f"{c}{suffix}" in df.columns]
    filled = df.withColumns(
        {c: F.coalesce(F.col(c), F.col(f"{c}{suffix}")) if c in df.columns else F.col(f"{c}{suffix}") for c in present}
    )
    return filled.drop(*[f"{c}{suffix}" for c in present])


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = SEED) -> DataFrame:
    """At most ``n`` rows by the order of a seeded hash of the key; does not depend on the partitioning."""
    mixed = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return df.orderBy(mixed, key).limit(n)
