"""Prediction tables: masking, conforming, blending, checking. Everything is keyed by ``ID``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamfold.functions.fixed import TARGETS
from loamfold.functions.nulls import clip_lower
from loamfold.operators.columns import conform
from loamfold.operators.statistics import per_column


def _mask_columns(mask: DataFrame, targets: Sequence[str]) -> list:
    return [F.col(t).alias(f"_keep_{t}") for t in targets if t in mask.columns]


def mask_lenient(
    predictions: DataFrame, mask: DataFrame, targets: Sequence[str] = TARGETS, prefix: str = "Target_"
) -> DataFrame:
    """Multiply by the 0/1 mask; an id without a mask row is masked out."""
    joined = predictions.join(mask.select("ID", *_mask_columns(mask, targets)), "ID", "left")
    masked = {
        f"{prefix}{t}": F.col(f"{prefix}{t}") * F.coalesce(F.col(f"_keep_{t}"), F.lit(0))
        for t in targets
        if t in mask.columns and f"{prefix}{t}" in predictions.columns
    }
    return joined.withColumns(masked).select(*predictions.columns)


def mask_strict(
    predictions: DataFrame, mask: DataFrame, targets: Sequence[str] = TARGETS, prefix: str = "Target_"
) -> DataFrame:
    """Multiply by the mask; an id without a mask row is an error, a target the mask lacks becomes 0."""
    side = mask.select("ID", F.lit(True).alias("_found"), *_mask_columns(mask, targets))
    # the check is a filter on the joined rows, so no choice of columns and no count can drop it
    missing = F.raise_error(F.concat(F.lit("no mask row for id "), F.coalesce(F.col("ID").cast("string"), F.lit("NULL")))).cast("boolean")
    joined = predictions.join(side, "ID", "left").where(F.when(F.col("_found").isNull(), missing).otherwise(F.lit(True)))
    present = [t for t in targets if f"{prefix}{t}" in predictions.columns]
    cells = {f"{prefix}{t}": F.col(f"{prefix}{t}") * F.col(f"_keep_{t}") if t in mask.columns else F.lit(0.0) for t in present}
    return joined.withColumns(cells).select(*predictions.columns)


def blend(
    tables: Sequence[tuple[DataFrame, float]], targets: Sequence[str] = TARGETS, prefix: str = "Target_"
) -> DataFrame:
    """Weighted mean per id and target; missing counts as 0, the weights are those of all tables."""
    names = [f"{prefix}{t}" for t in targets]
    total = float(sum(weight for _, weight in tables))
    weighted = [
        df.select(
            "ID",
            *[
                (F.coalesce(F.col(c), F.lit(0.0)) * F.lit(weight) if c in df.columns else F.lit(0.0)).alias(c)
                for c in names
            ],
        )
        for df, weight in tables
    ]
    stacked = reduce(DataFrame.unionByName, weighted)
    return stacked.groupBy("ID").agg(*[(F.sum(c) / F.lit(total)).alias(c) for c in names])


def clipped(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: clip_lower(F.col(c)) for c in columns if c in df.columns})


def submission(
    predictions: DataFrame,
    mask: DataFrame,
    template: Sequence[str],
    targets: Sequence[str] = TARGETS,
    strict: bool = False,
) -> DataFrame:
    """Mask, floor at zero and conform to the template."""
    apply = mask_strict if strict else mask_lenient
    masked = apply(predictions, mask, targets)
    return conform(clipped(masked, [f"Target_{t}" for t in targets]), template)


def violations(
    predictions: DataFrame, mask: DataFrame, targets: Sequence[str] = TARGETS, prefix: str = "Target_"
) -> DataFrame:
    """Nulls, negatives and unmasked cells per target: ``(target, nulls, negatives, mask_violations)``."""
    present = [t for t in targets if f"{prefix}{t}" in predictions.columns]
    joined = predictions.join(mask.select("ID", *_mask_columns(mask, targets)), "ID", "left")

    def broken(t: str):
        if t not in mask.columns:
            return F.lit(False)
        # A missing prediction under a zero mask is not zero either.
        nonzero = F.coalesce(F.col(f"{prefix}{t}") != 0, F.lit(True))
        return F.coalesce(F.col(f"_keep_{t}") == 0, F.lit(False)) & nonzero

    cells = []
    for t in present:
        p = F.col(f"{prefix}{t}")
        cells.append(
            F.struct(
                F.lit(t).alias("target"),
                F.count_if(p.isNull()).alias("nulls"),
                F.count_if(p < 0).alias("negatives"),
                F.count_if(broken(t)).alias("mask_violations"),
            )
        )
    return joined.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def validate(
    predictions: DataFrame, mask: DataFrame, sample: DataFrame, targets: Sequence[str] = TARGETS
) -> DataFrame:
    """Check table ``(check, status, n)`` and a last row with the verdict.

    Checks: row count, columns, nulls, negatives, mask, ranges. Extra columns only warn.
    """
    missing = len([c for c in sample.columns if c not in predictions.columns])
    extra = len([c for c in predictions.columns if c not in sample.columns])
    present = [f"Target_{t}" for t in targets if f"Target_{t}" in predictions.columns]
    positive = per_column(predictions, present, {"n": lambda c: F.count_if(c > 0)})
    facts = violations(predictions, mask, targets).agg(
        *[F.sum(c).alias(c) for c in ("nulls", "negatives", "mask_violations")],
        F.max(predictions.agg(F.count("*")).scalar()).alias("rows"),
        F.max(sample.agg(F.count("*")).scalar()).alias("expected"),
        F.max(positive.agg(F.count_if(F.col("n") > 0)).scalar()).alias("with_range"),
    )

    def entry(name: str, bad, n):
        status = F.when(bad, F.lit("fail")).otherwise(F.lit("ok")) if not isinstance(bad, str) else F.lit(bad)
        return F.struct(F.lit(name).alias("check"), status.alias("status"), n.cast("bigint").alias("n"))

    column_status = "fail" if missing else "warn" if extra else "ok"
    wrong_rows = F.col("rows") != F.col("expected")
    problems = [F.col("nulls") > 0, F.col("negatives") > 0, F.col("mask_violations") > 0]
    failed = wrong_rows | F.lit(missing > 0) | problems[0] | problems[1] | problems[2]
    return facts.select(
        F.inline(
            F.array(
                entry("rows", wrong_rows, F.col("rows")),
                entry("columns", column_status, F.lit(missing or extra)),
                entry("nulls", problems[0], F.col("nulls")),
                entry("negatives", problems[1], F.col("negatives")),
                entry("mask", problems[2], F.col("mask_violations")),
                entry("ranges", "ok", F.col("with_range")),
                entry("verdict", failed, failed.cast("int")),
            )
        )
    )
