"""Chemistry interactions, ratios between targets, and target transforms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamfold.functions.fixed import CHEMISTRY, RATIO_PAIRS, TARGETS
from loamfold.functions.nulls import log_positive, padded_ratio, to_number


def coerced_chemistry(df: DataFrame) -> DataFrame:
    """Chemistry columns as doubles; a column the table lacks is added as NULL."""
    return df.withColumns(
        {c: to_number(F.col(c).cast("string")) if c in df.columns else F.lit(None).cast("double") for c in CHEMISTRY}
    )


def interactions(profile: str) -> dict[str, Column]:
    """Interaction columns. Under ``split`` missing carbon propagates, under ``regex`` it counts as zero."""
    ph, organic, total = F.col("ph"), F.col("C_organic"), F.col("C_total")
    if profile == "split":
        return {
            "ph_sq": ph * ph,
            "log_C_organic": log_positive(organic),
            "log_C_total": log_positive(total),
            "C_org_x_ph": organic * ph,
            "C_total_C_org_ratio": padded_ratio(total, organic),
        }
    organic, total = F.coalesce(organic, F.lit(0.0)), F.coalesce(total, F.lit(0.0))
    return {
        "ph_x_Corg": ph * organic,
        "C_inorganic": total - organic,
        "Corg_ratio": padded_ratio(organic, total),
    }


def target_ratios(columns: list[str], profile: str) -> dict[str, Column]:
    """Ratios between targets: suffix form for the available pairs, prefix form with NULL for absent targets.

    These are derived from targets and must not become model features.
    """
    if profile == "split":
        return {
            f"{a}_{b}_ratio": padded_ratio(F.col(a), F.col(b))
            for a, b in RATIO_PAIRS[:3]
            if a in columns and b in columns
        }

    def value(name: str) -> Column:
        return F.col(name) if name in columns else F.lit(None).cast("double")

    return {f"ratio_{a}_{b}": padded_ratio(value(a), value(b)) for a, b in RATIO_PAIRS}


def log_targets(columns: list[str], in_place: bool) -> dict[str, Column]:
    """``log1p`` of the targets, over the originals or as ``log_<target>``."""
    return {(t if in_place else f"log_{t}"): log_positive(F.col(t)) for t in TARGETS if t in columns}
