"""Keyed joins. Sides are never hinted: the planner broadcasts what its size statistics prove small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamfold.functions.nulls import log_positive
from loamfold.operators.columns import any_of, fill_medians, fit_medians


def left_on_id(df: DataFrame, other: DataFrame, columns: Sequence[str], key: str = "ID") -> DataFrame:
    """Left join of the named columns of ``other``; only those columns are read."""
    return df.join(other.select(key, *columns), key, "left")


def left_with_suffix(
    df: DataFrame, other: DataFrame, columns: Sequence[str], suffix: str = "_dates", key: str = "ID"
) -> DataFrame:
    """Left join where colliding names of ``other`` get a suffix."""
    renamed = [F.col(c).alias(f"{c}{suffix}" if c in df.columns else c) for c in columns]
    return df.join(other.select(key, *renamed), key, "left")


def covariate_chain(spine: DataFrame, tables: Sequence[DataFrame], key: str = "ID") -> DataFrame:
    """Spine left-joined to each table; names already present are dropped from the right side first."""
    out = spine
    for table in tables:
        fresh = [c for c in table.columns if c != key and c not in out.columns]
        out = out.join(table.select(key, *fresh), key, "left")
    return out


def optional_merge(df: DataFrame, covariates: DataFrame | None, key: str = "ID") -> DataFrame:
    """Left join the covariates if there are any, else pass the table through."""
    return df if covariates is None else covariate_chain(df, [covariates], key)


def pending(points: DataFrame, cache: DataFrame, key: str = "ID") -> DataFrame:
    """Points without a cached record that holds at least one value."""
    values = [F.col(c).isNotNull() for c in cache.columns if c != key]
    done = cache.where(any_of(values)).select(key).distinct()
    return points.join(done, key, "left_anti")


def cache_progress(points: DataFrame, cache: DataFrame, key: str = "ID") -> DataFrame:
    """One row: how many points are cached and how many remain."""
    open_ids = pending(points, cache, key).select(key, F.lit(1).alias("_open"))
    return (
        points.select(key)
        .join(open_ids, key, "left")
        .agg(
            F.count_if(F.col("_open").isNull()).alias("cached"),
            F.count("_open").alias("remaining"),
        )
    )


def with_code(df: DataFrame, codes: DataFrame, column: str, name: str, unseen: int = -1) -> DataFrame:
    """Look a value up in a code table; an unseen value gets ``unseen``."""
    table = codes.select(F.col(column), F.col("code").alias(name))
    joined = df.join(table, column, "left")
    return joined.select(*df.columns, F.coalesce(F.col(name), F.lit(unseen).cast("bigint")).alias(name))


def batch_results(requests: DataFrame, replies: DataFrame, value: str) -> DataFrame:
    """Match list replies to requests by batch and position; a short reply leaves NULL.

    ``requests`` has ``batch_id, pos``; ``replies`` has ``batch_id`` and an array ``results``.
    """
    items = replies.select("batch_id", F.posexplode("results").alias("pos", value))
    items = items.withColumn("pos", F.col("pos").cast("bigint"))
    return requests.join(items, ["batch_id", "pos"], "left")


def stage1_features(
    features: DataFrame,
    predictions: DataFrame,
    target: str,
    targets: Sequence[str],
    profile: str = "split",
    is_test: bool = False,
    key: str = "ID",
) -> DataFrame:
    """Attach the first-stage predictions of all other targets as ``oof_*``.

    ``split`` keeps the original scale and fills gaps with the table's own
    medians; ``regex`` uses the log scale and fills gaps of the test table with 0.
    """
    others = [t for t in targets if t != target and t in predictions.columns]
    scaled = [(log_positive(F.col(t)) if profile == "regex" else F.col(t)).alias(f"oof_{t}") for t in others]
    cross = predictions.select(key, *scaled)
    joined = features.join(cross, key, "left")
    names = [f"oof_{t}" for t in others]
    if profile == "regex" and is_test:
        return joined.na.fill(0.0, subset=names)
    return fill_medians(joined, fit_medians(joined, names))
