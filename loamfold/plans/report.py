"""The numbers behind an exploratory report, as one long table ``(section, item, metric, value)``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamfold.functions.fixed import PH_TARGETS, SCATTER_PAIRS, TARGETS
from loamfold.operators import correlation, statistics


def _rows(df: DataFrame, section: str, item, measures: Sequence[str]) -> DataFrame:
    """Each measure of each row as one report row."""
    cells = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in measures]
    )
    return df.select(F.lit(section).alias("section"), item.alias("item"), F.inline(cells))


def report(train: DataFrame, test: DataFrame, mask: DataFrame, targets: Sequence[str] = TARGETS) -> DataFrame:
    chemistry = ["ph", "electrical_conductivity", "C_organic", "C_total"]
    skews = statistics.per_column(
        train, targets, {"skew": statistics.sample_skew, "cv_pct": statistics.cv_pct}
    )
    pair = F.concat_ws("~", "x_name", "y_name")
    sections = [
        _rows(
            statistics.shapes({"train": train, "test": test, "mask": mask}),
            "shape", F.col("table_name"), ["n_rows", "n_cols"],
        ),
        _rows(
            statistics.missing_pct(train, [*chemistry, *targets]), "missing", F.col("metric"), ["missing_pct"]
        ),
        _rows(
            statistics.describe(train, targets),
            "describe", F.col("metric"),
            ["count", "mean", "std", "min", "max", "p10", "p25", "p50", "p75", "p90"],
        ),
        _rows(skews, "spread", F.col("metric"), ["skew", "cv_pct"]),
        _rows(statistics.value_counts(train, "Depth_cm"), "depth_train", F.col("Depth_cm"), ["n"]),
        _rows(statistics.value_counts(test, "Depth_cm"), "depth_test", F.col("Depth_cm"), ["n"]),
        _rows(statistics.mask_coverage(mask, targets), "mask", F.col("metric"), ["kept", "kept_pct"]),
        _rows(correlation.pearson(train, targets), "pearson", pair, ["r"]),
        _rows(
            correlation.transformed(train, [*[("ph", t) for t in PH_TARGETS], *SCATTER_PAIRS[:2]]),
            "scatter", pair, ["r_raw", "r_semilog", "r_log"],
        ),
        _rows(
            statistics.histogram(train, targets, log=True),
            "histogram", F.concat_ws("~", "metric", F.col("bin").cast("string")), ["n"],
        ),
        _rows(
            statistics.box_stats(train, "Depth_cm", PH_TARGETS),
            "box", F.concat_ws("~", "Depth_cm", "metric"),
            ["q1", "median", "q3", "whisker_low", "whisker_high", "outliers"],
        ),
    ]
    return reduce(DataFrame.unionByName, sections)
