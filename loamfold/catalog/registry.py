"""Registry of the queries and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamfold.catalog.views import spark_view, table, with_views


@dataclass(frozen=True)
class Tables:
    """Access to the views and tables of one data folder."""

    spark: SparkSession
    folder: str

    def view(self, name: str) -> DataFrame:
        return spark_view(self.spark, self.folder, name)

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)


RUNNERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: str = "", recursive: bool = False):
    """Register ``fn(tables)`` under ``name``; ``views`` names the views the SQL reads."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in RUNNERS:
            raise ValueError(f"query {name} is registered twice")
        RUNNERS[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = with_views(views.split(), sql, recursive)
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6, columns: list[str] | None = None) -> DataFrame:
    """Round the double columns (or the named ones), for comparison with another engine."""
    chosen = columns or [c for c, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: F.round(F.col(c), digits) for c in chosen})


def r(column: Column | str, digits: int = 6) -> Column:
    return F.round(column, digits)
