"""Spatial group folds: every block stays whole, folds are balanced."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamfold.functions.coords import block_key
from loamfold.functions.fixed import BATCH_ROWS, FOLDS
from loamfold.operators.ordering import with_row_index
from loamfold.session import stored

#: Half-degree cells of the globe: the most spatial blocks there can be.
MAX_BLOCKS = 360 * 720
#: Begins the block of rows without a place; spatial keys begin with a number.
FALLBACK = "r"


def with_blocks(df: DataFrame, key: str = "ID", block: str = "spatial_block") -> DataFrame:
    """Add the half-degree block; rows without a place get blocks of ``BATCH_ROWS`` in the order of ``key``."""
    placed = df.withColumn(block, block_key(F.col("Latitude"), F.col("Longitude")))
    nowhere = with_row_index(placed.where(F.col(block).isNull()).select(key), [key], "_index")
    number = F.floor(F.col("_index") / F.lit(float(BATCH_ROWS))).cast("bigint").cast("string")
    named = nowhere.select(F.col(key).alias("_key"), F.concat(F.lit(FALLBACK), number).alias("_block"))
    joined = placed.join(named, F.col(key) == F.col("_key"), "left")
    return joined.withColumn(block, F.coalesce(block, "_block")).drop("_key", "_block")


def block_sizes(df: DataFrame, block: str = "spatial_block") -> DataFrame:
    return df.groupBy(block).agg(F.count("*").alias("n"))


def assign_folds(sizes: DataFrame, folds: int = FOLDS) -> DataFrame:
    """``(target, block, n)`` to ``(target, block, fold)``.

    Largest block first, each to the lightest fold; ties by block key and fold
    number. Only block counts reach a task, never rows: a target has at most one
    count per half-degree cell of the globe.
    """
    limit = MAX_BLOCKS

    def balance(group: pd.DataFrame) -> pd.DataFrame:
        if len(group) > limit:
            raise ValueError("more blocks than half-degree cells on the globe; check the coordinates")
        ordered = group.sort_values(["n", "block"], ascending=[False, True], kind="stable")
        loads = [(0, fold) for fold in range(folds)]
        assigned = []
        for n in ordered["n"]:
            load, fold = heapq.heappop(loads)
            assigned.append(fold)
            heapq.heappush(loads, (load + int(n), fold))
        return ordered.assign(fold=assigned)[["target", "block", "fold"]]

    return sizes.groupBy("target").applyInPandas(balance, "target string, block string, fold int")


def labelled_long(df: DataFrame, targets: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per id and present target: ``(*keep, target, y)``."""
    rows = df.select(*keep, *targets).unpivot(list(keep), list(targets), "target", "y")
    return rows.where(F.col("y").isNotNull())


def target_folds(long: DataFrame, block: str = "spatial_block", folds: int = FOLDS) -> DataFrame:
    """``(target, block, fold)``, stored; folds are balanced on the labelled rows of each target.

    Spatial blocks, of which there are boundedly many, are dealt largest first.
    Fallback blocks are of one size and of any number: they go round the folds.
    """
    sizes = long.groupBy("target", F.col(block).alias("block")).agg(F.count("*").alias("n"))
    counted = stored(sizes.where(F.col("block").isNotNull()), "block-sizes")
    spatial = ~F.col("block").startswith(FALLBACK)
    number = F.substring("block", 2, 20).try_cast("bigint")
    fallback = counted.where(~spatial).select("target", "block", F.pmod(number, F.lit(folds)).cast("int").alias("fold"))
    return stored(assign_folds(counted.where(spatial), folds).unionByName(fallback).withColumnRenamed("block", block), "folds")


def with_target_folds(long: DataFrame, block: str = "spatial_block", folds: int = FOLDS) -> DataFrame:
    """Add ``fold`` to labelled rows; see ``with_blocks`` for rows without a place."""
    return long.join(target_folds(long, block, folds), ["target", block])
