"""From stage predictions to a checked submission."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamfold.functions.fixed import TARGETS
from loamfold.operators.learning import best_stage, rmse_macro
from loamfold.operators.predictions import submission, validate


def choose_stage(scores: dict[str, DataFrame], predictions: dict[str, DataFrame]) -> DataFrame:
    """Predictions of the stage with the smallest macro RMSE; the choice is made inside the plan."""
    chosen = best_stage(rmse_macro(scores)).scalar()
    tagged = [df.where(F.lit(name) == chosen) for name, df in predictions.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df)
    return out


def final_submission(
    scores: dict[str, DataFrame],
    predictions: dict[str, DataFrame],
    mask: DataFrame,
    template: Sequence[str],
    targets: Sequence[str] = TARGETS,
) -> DataFrame:
    return submission(choose_stage(scores, predictions), mask, template, targets)


def checked(submitted: DataFrame, mask: DataFrame, sample: DataFrame) -> DataFrame:
    return validate(submitted, mask, sample)
