"""Queries over the test tables, each with the SQL it is checked against."""

from loamfold.catalog import (  # noqa: F401
    column_queries,
    join_queries,
    learning_queries,
    pipeline_queries,
    scalar_queries,
    source_queries,
    statistic_queries,
)
from loamfold.catalog.registry import ORACLES, RUNNERS  # noqa: F401
