"""Per-target models on spatial folds: out-of-fold predictions, fold averages, search, clustering.

The fold, scatter and averaging steps do not depend on the learner. The
straight line per target and fold is here, fitted for all of them from one
aggregate pass; boosted trees are in ``trees``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamfold.functions.fixed import FOLDS, SEED
from loamfold.functions.nulls import clip_lower, from_log, log_positive
from loamfold.operators import spatial
from loamfold.session import side_by_side, stored

#: Degrees, and part of a cost, within which a settled k-means run may differ from its optimum by rounding.
SETTLED = 1e-9


# --- straight line per target and fold -------------------------------------------------


def fit_lines(long: DataFrame, x: str, label: str = "y_log", folds: int = FOLDS) -> DataFrame:
    """``(target, fold, slope, intercept)``, each fitted on all rows outside the fold.

    One pass gathers counts, means and centred moments per target and fold; leaving a
    fold out then merges the moments of the others, so no fold is read twice.
    The table has at most targets x folds rows.
    """
    px, py = F.col(x).cast("double"), F.col(label).cast("double")
    complete = long.where(px.isNotNull() & py.isNotNull())
    moments = complete.groupBy("target", "fold").agg(
        F.count("*").cast("double").alias("n"),
        F.avg(px).alias("mx"),
        F.avg(py).alias("my"),
        F.var_pop(px).alias("vx"),
        F.covar_pop(px, py).alias("cxy"),
    )
    others = moments.select(*[F.col(c).alias(f"o_{c}") for c in moments.columns])
    numbers = long.select("target").distinct().withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
    merged = (
        numbers.join(others, (F.col("target") == F.col("o_target")) & (F.col("fold") != F.col("o_fold")))
        .groupBy("target", "fold")
        .agg(
            F.sum("o_n").alias("n"),
            (F.sum(F.col("o_n") * F.col("o_mx")) / F.sum("o_n")).alias("mx"),
            (F.sum(F.col("o_n") * F.col("o_my")) / F.sum("o_n")).alias("my"),
            F.collect_list(F.struct("o_n", "o_mx", "o_my", "o_vx", "o_cxy")).alias("parts"),
        )
    )

    def total(term) -> Column:
        return F.aggregate("parts", F.lit(0.0), lambda acc, p: acc + term(p))

    sxx = total(lambda p: p["o_n"] * (p["o_vx"] + (p["o_mx"] - F.col("mx")) * (p["o_mx"] - F.col("mx"))))
    sxy = total(lambda p: p["o_n"] * (p["o_cxy"] + (p["o_mx"] - F.col("mx")) * (p["o_my"] - F.col("my"))))
    lines = merged.withColumn("slope", F.coalesce(F.try_divide(sxy, sxx), F.lit(0.0)))
    return stored(
        lines.select("target", "fold", "slope", (F.col("my") - F.col("slope") * F.col("mx")).alias("intercept")),
        "lines",
    )


def line_oof(long: DataFrame, lines: DataFrame, x: str) -> DataFrame:
    """Each labelled row predicted by the model that did not see its fold: ``(ID, target, fold, y, pred_log)``."""
    return long.join(lines, ["target", "fold"]).select(
        "ID", "target", "fold", "y", (F.col("slope") * F.col(x) + F.col("intercept")).alias("pred_log")
    )


def line_parameters(lines: DataFrame) -> dict[str, list[tuple[float, float]]]:
    """Fitted slopes and intercepts by target, in fold order: at most targets x folds numbers."""
    fitted: dict[str, list[tuple[float, float]]] = {}
    for row in sorted(lines.collect(), key=lambda r: (r["target"], r["fold"])):
        fitted.setdefault(row["target"], []).append((row["slope"], row["intercept"]))
    return fitted


def line_scatter(
    rows: DataFrame, fold_table: DataFrame, lines: DataFrame, x: str, targets: Sequence[str], block: str = "spatial_block"
) -> DataFrame:
    """Out-of-fold predictions, original scale, for wide rows: ``(ID, targets…)``, unlabelled cells NULL.

    A row needs only the folds of its block and the lines, both far smaller than
    the rows, so nothing is stacked and no row is shuffled for its targets.
    ``fold_table`` is ``(target, block, fold)``.
    """
    fitted = line_parameters(lines)
    per_block = stored(
        fold_table.groupBy(block).agg(*[F.max(F.when(F.col("target") == t, F.col("fold"))).alias(f"_fold_{t}") for t in targets]),
        "block-folds",
    )
    joined = rows.select("ID", block, x, *targets).join(per_block, block, "left")

    def predicted(t: str) -> Column:
        if t not in fitted:
            return F.lit(None).cast("double").alias(t)
        slopes, intercepts = (F.lit([line[part] for line in fitted[t]]) for part in (0, 1))
        fold = F.col(f"_fold_{t}")
        log = F.get(slopes, fold) * F.col(x) + F.get(intercepts, fold)
        return F.when(F.col(t).isNotNull(), F.expm1(log)).alias(t)

    return joined.select("ID", *[predicted(t) for t in targets])


def line_test(test: DataFrame, lines: DataFrame, x: str) -> DataFrame:
    """Every fold's model on every test row: ``(ID, target, fold, pred_log)``."""
    row = lines.agg(F.collect_list(F.struct("target", "fold", "slope", "intercept")).alias("models")).scalar()
    return test.select("ID", F.col(x).alias("_x"), F.inline(row)).select(
        "ID", "target", "fold", (F.col("slope") * F.col("_x") + F.col("intercept")).alias("pred_log")
    )


def line_test_average(test: DataFrame, lines: DataFrame, x: str, targets: Sequence[str]) -> DataFrame:
    """Fold mean of the lines, transformed back and floored at zero: ``(ID, targets…)``.

    The mean of lines is a line, so a test row is read once and never shuffled.
    """
    fitted = line_parameters(lines)

    def predicted(t: str) -> Column:
        if t not in fitted:
            return F.lit(None).cast("double").alias(t)
        slope, intercept = (sum(line[part] for line in fitted[t]) / len(fitted[t]) for part in (0, 1))
        return from_log(F.lit(slope) * F.col(x) + F.lit(intercept)).alias(t)

    return test.select("ID", *[predicted(t) for t in targets])


# --- learner-independent steps ----------------------------------------------------------


def with_log_label(long: DataFrame) -> DataFrame:
    return long.withColumn("y_log", log_positive(F.col("y")))


def fold_mean(predictions: DataFrame, value: str = "pred_log") -> DataFrame:
    """Mean over the fold models per row and target."""
    return predictions.groupBy("ID", "target").agg(F.avg(value).alias(value))


def to_wide(long: DataFrame, value: str, targets: Sequence[str], prefix: str = "") -> DataFrame:
    """``(ID, target, value)`` to one column per target."""
    return long.groupBy("ID").agg(
        *[F.max(F.when(F.col("target") == t, F.col(value))).alias(f"{prefix}{t}") for t in targets]
    )


def scatter(rows: DataFrame, oof: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Out-of-fold predictions, original scale, back on all rows; unlabelled cells stay NULL."""
    wide = to_wide(oof.withColumn("pred", F.expm1("pred_log")), "pred", targets)
    return rows.select("ID").join(wide, "ID", "left")


def test_average(predictions: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Fold mean on the log scale, transformed back and floored at zero, one column per target."""
    mean = fold_mean(predictions).withColumn("pred", from_log(F.col("pred_log")))
    return to_wide(mean, "pred", targets)


def rmse(y: Column, p: Column) -> Column:
    return F.sqrt(F.avg((y - p) * (y - p)))


def rmse_pooled(oof: DataFrame) -> DataFrame:
    """RMSE per target over all out-of-fold rows, original scale, prediction floored at zero."""
    return oof.groupBy("target").agg(rmse(F.col("y"), clip_lower(F.col("pred"))).alias("rmse"))


def rmse_fold_mean(oof: DataFrame, y: str = "y_log", pred: str = "pred_log") -> DataFrame:
    """Mean over folds of the RMSE per fold, log scale."""
    per_fold = oof.groupBy("target", "fold").agg(rmse(F.col(y), F.col(pred)).alias("r"))
    return per_fold.groupBy("target").agg(F.avg("r").alias("rmse_log"))


def rmse_macro(stages: dict[str, DataFrame]) -> DataFrame:
    """Mean RMSE over targets per stage: ``(stage, macro_rmse)``."""
    out = None
    for name, table in stages.items():
        part = table.agg(F.avg("rmse").alias("macro_rmse")).select(F.lit(name).alias("stage"), "macro_rmse")
        out = part if out is None else out.unionByName(part)
    return out


def best_stage(macro: DataFrame) -> DataFrame:
    """The stage with the smallest measured error, ties to the first name."""
    return macro.agg(F.min_by("stage", F.struct("macro_rmse", "stage")).alias("stage"))


# --- clustering -------------------------------------------------------------------------


@dataclass(frozen=True)
class Centres:
    """A settled k-means run: its centres, the distinct places with weight and centre, and what each restart had reached."""

    centres: DataFrame
    placed: DataFrame
    restart_costs: list[float]

    def check(self) -> DataFrame:
        """One row: places and their weight, places that another centre is nearer to, used centres that are not the
        weighted mean of their places, and restarts with a lower cost. A settled run has 0 in the last three."""
        near = spatial.nearest_centre(self.placed.withColumnRenamed("cluster", "_own"), self.centres, F.col("Latitude"), F.col("Longitude"))
        named = self.centres.withColumnRenamed("cluster", "_own")
        away = F.pow(F.col("Latitude") - F.col("c_lat"), 2) + F.pow(F.col("Longitude") - F.col("c_lon"), 2)
        own = near.join(named, "_own").withColumn("_away", away)
        by_centre = own.groupBy("_own").agg(
            F.count("*").alias("places"),
            F.sum("weight").alias("weight"),
            # a place as near to two centres may belong to either
            F.count_if(F.sqrt("_away") > F.col("centre_distance") + SETTLED).alias("misplaced"),
            (F.abs(F.sum(F.col("weight") * F.col("Latitude")) / F.sum("weight") - F.first("c_lat")) > SETTLED).alias("off_lat"),
            (F.abs(F.sum(F.col("weight") * F.col("Longitude")) / F.sum("weight") - F.first("c_lon")) > SETTLED).alias("off_lon"),
            F.sum(F.col("weight") * F.col("_away")).alias("cost"),
        )
        lower = [F.when(F.sum("cost") > F.lit(c) * (1 + SETTLED) + SETTLED, 1).otherwise(0) for c in self.restart_costs]
        return by_centre.agg(
            F.count("*").alias("used_centres"),
            F.sum("places").alias("places"),
            F.sum("weight").cast("long").alias("weight"),
            F.sum("misplaced").alias("misplaced"),
            F.count_if(F.col("off_lat") | F.col("off_lon")).alias("moved_centres"),
            reduce(lambda x, y: x + y, lower, F.lit(0)).alias("cheaper_restarts"),
        )


def settle_centres(points: DataFrame, k: int, restarts: int = 10, seed: int = SEED, rounds: int = 300) -> Centres:
    """The k-means run with the lowest cost over several seeds, carried on until its centres rest.

    Missing coordinates count as 0. Equal places are weighted, not repeated. A round assigns every place to its nearest
    centre and brings k means to the driver. A centre without places stays where it is. No rows give no centres.
    """
    spark = points.sparkSession
    grouped = (
        points.select(
            F.coalesce("Latitude", F.lit(0.0)).alias("Latitude"), F.coalesce("Longitude", F.lit(0.0)).alias("Longitude")
        )
        .groupBy("Latitude", "Longitude")
        .agg(F.count("*").cast("double").alias("weight"))
        .sort("Latitude", "Longitude")
    )
    places = stored(grouped, "places")
    kinds = "cluster int, c_lat double, c_lon double"
    if places.isEmpty():
        return Centres(spark.createDataFrame([], kinds), places.withColumn("cluster", F.lit(None).cast("int")), [])
    vectors = VectorAssembler(inputCols=["Latitude", "Longitude"], outputCol="_place").transform(places)
    vectors.persist()

    def fit(attempt: int):
        model = KMeans(k=k, seed=seed + attempt, featuresCol="_place", weightCol="weight").fit(vectors)
        return model.summary.trainingCost, attempt, model

    runs = side_by_side(spark, fit, range(restarts))
    centres = [(i, float(c[0]), float(c[1])) for i, c in enumerate(min(runs, key=lambda run: run[:2])[2].clusterCenters())]
    vectors.unpersist()
    mean = [(F.sum(F.col("weight") * F.col(c)) / F.sum("weight")).alias(c) for c in ("Latitude", "Longitude")]
    for _ in range(rounds):
        table = spark.createDataFrame(centres, kinds)
        placed = spatial.nearest_centre(places, table, F.col("Latitude"), F.col("Longitude"))
        means = {row["cluster"]: (row["Latitude"], row["Longitude"]) for row in placed.groupBy("cluster").agg(*mean).collect()}
        following = [(i, *means.get(i, (lat, lon))) for i, lat, lon in centres]
        gap = max(max(abs(a[1] - b[1]), abs(a[2] - b[2])) for a, b in zip(centres, following))
        if gap <= SETTLED / 10:
            return Centres(table, placed.select("Latitude", "Longitude", "weight", "cluster"), [run[0] for run in runs])
        centres = following
    raise RuntimeError(f"centres still move after {rounds} rounds")


def fit_centres(points: DataFrame, k: int, restarts: int = 10, seed: int = SEED) -> DataFrame:
    """The centres of ``settle_centres``: ``(cluster, c_lat, c_lon)``."""
    return settle_centres(points, k, restarts, seed).centres
