"""Set operations and schema comparison."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamfold.operators.ordering import first_per_key


def union_locations(tables: Sequence[DataFrame], key: str = "ID") -> DataFrame:
    """Points of several tables, the first table's row per id, complete coordinates only.

    Of the rows that repeat an id in one table, the one with the smallest latitude, then longitude, counts; missing
    ones come last.
    """
    columns = [key, "Latitude", "Longitude"]

    def place(i: int) -> Column:
        parts = [part for c in columns[1:] for part in (F.col(c).isNull(), F.col(c))]
        return F.struct(F.lit(i).alias("table"), *[p.alias(f"p{j}") for j, p in enumerate(parts)]).alias("_order")

    ranked = [t.select(*columns, place(i)) for i, t in enumerate(tables)]
    stacked = reduce(DataFrame.unionByName, ranked)
    return first_per_key(stacked, key, "_order").drop("_order").na.drop(subset=columns[1:])


def union_varying(tables: Sequence[DataFrame]) -> DataFrame:
    """Rows with differing columns in one table, absent columns NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def union_categories(tables: Sequence[DataFrame], column: str) -> DataFrame:
    """Distinct values of a column over several tables."""
    return reduce(DataFrame.unionByName, [t.select(column) for t in tables]).distinct()


def schema_diff(df: DataFrame, template: Sequence[str]) -> DataFrame:
    """Columns missing from and extra to a template, with the values they hold: ``(column_name, status, n_values)``."""
    extra = [c for c in df.columns if c not in template]
    entries = [(c, "missing", F.lit(0).cast("long")) for c in template if c not in df.columns]
    entries += [(c, "extra", F.count(c)) for c in extra]
    if not entries:
        return df.sparkSession.createDataFrame([], "column_name string, status string, n_values long")
    cells = [F.struct(F.lit(c).alias("column_name"), F.lit(s).alias("status"), n.alias("n_values")) for c, s, n in entries]
    return df.agg(F.array(*cells).alias("cells"), F.count("*")).select(F.inline("cells"))
