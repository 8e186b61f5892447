"""Boosted trees for every target and fold: layout, fits side by side, out-of-fold rows, test means, models on disk, search.

Labelled rows of all targets are one select per target over wide rows that are stored with the fold of every target: a
filter on the target reads the wide rows once, and nothing is stored per target and row. A fit is trained on all labelled
rows outside its fold, where they lie, and every row is scored. Only the search compares its candidates on a sample.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamfold.functions.fixed import FOLDS, SEED
from loamfold.functions.nulls import log_positive
from loamfold.session import PARALLEL_JOBS, side_by_side, stored
from loamfold.sources.readers import read_json_lines
from loamfold.sources.writers import write_json

#: Labelled rows of a target and fold that a search sees, about; those with the smallest hashes. All rows where there are fewer.
TRAINED = 10_000
#: Rows of a fit for which there is another task at the least.
TASK_ROWS = 50_000
#: Rows of all fits that run at a time, about. Spark holds the binned rows of a fit, which has one fit at a time if it is larger.
HELD_ROWS = 10_000_000
#: What the described training sets, as far as the learner has it; ``validationTol`` is the least gain of a tree worth keeping.
DEFAULTS = {"maxIter": 100, "maxDepth": 6, "stepSize": 0.05, "minInstancesPerNode": 20, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "validationTol": 0.001, "seed": SEED}
#: Settings of the profile that fits absolute errors.
ABSOLUTE = {"lossType": "absolute"}

Features = Mapping[str, Sequence[str]]


def fold_layout(wide: DataFrame, columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """``(ID, y, y_log, <features>…, target, fold)`` of the labelled rows of ``wide``, which has ``_fold_<target>`` beside each target.

    ``wide`` is stored, once for all targets. ``columns`` names the features of each target; others are NULL in its rows
    unless more than half of the targets have them.
    """
    names = sorted({name for own in columns.values() for name in own})
    kinds = {f.name: f.dataType for f in wide.schema.fields}
    common = {n for n in names if 2 * sum(n in own for own in columns.values()) > len(columns)}
    dealt = stored(wide, "fold-rows")

    def of(target: str) -> DataFrame:
        own = [F.col(n) if n in common or n in columns[target] else F.lit(None).cast(kinds[n]).alias(n) for n in names]
        y, fold = F.col(target), F.col(f"_fold_{target}")
        known = dealt.where(y.isNotNull() & fold.isNotNull())
        return known.select("ID", y.alias("y"), log_positive(y).alias("y_log"), *own, F.lit(target).alias("target"), fold.alias("fold"))

    return reduce(DataFrame.unionByName, map(of, columns))


def training_sample(rows: DataFrame, trained: int = TRAINED) -> DataFrame:
    """For a search: about ``trained`` rows of each target and fold, stored by target; which ones depends on ids alone. Its size is bounded."""
    counts = stored(rows.groupBy("target", "fold").agg(F.count("*").alias("_n")), "fold-counts")
    place = F.pmod(F.xxhash64(F.lit(SEED), "ID", "target"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = rows.join(counts, ["target", "fold"]).where(place * F.col("_n") < trained).drop("_n")
    return stored(chosen.repartition("target").sortWithinPartitions("target", "fold", "ID"), "training-sample", partition_by=["target"])


@dataclass(frozen=True)
class Fit:
    """One model: of a target, trained on all folds but ``fold``, with what it was given and its number of trees."""

    target: str
    fold: int
    features: tuple[str, ...]
    settings: dict
    model: PipelineModel

    @property
    def trees(self) -> int:
        return len(self.model.stages[-1].trees)


def fit_one(rows: DataFrame, target: str, fold: int, features: Sequence[str], settings: Mapping, stop_early: bool, tasks: int = 1) -> Fit:
    """Trees over all of the target's rows outside the fold; with ``stop_early`` the fold's own rows end the growth of the ensemble.

    The rows are read by ``tasks`` tasks at most, and are in order where it is one, so that the fit does not depend on
    how they were dealt.
    """
    own = rows.where(F.col("target") == target).select("ID", *features, "y_log", "fold").coalesce(tasks)
    own = own.sortWithinPartitions("fold", "ID") if tasks == 1 else own
    own = own.select(*features, "y_log", (F.col("fold") == fold).alias("_held"))
    options = {**DEFAULTS, **settings}
    if stop_early:
        options["validationIndicatorCol"] = "_held"
    else:
        own = own.where(~F.col("_held"))
    assembler = VectorAssembler(inputCols=list(features), outputCol="_features")
    learner = GBTRegressor(featuresCol="_features", labelCol="y_log", predictionCol="pred_log", **options)
    return Fit(target, fold, tuple(features), dict(settings), PipelineModel([assembler, learner.fit(assembler.transform(own))]))


@dataclass(frozen=True)
class Forest:
    """The fits of all targets and folds."""

    spark: SparkSession
    fits: tuple[Fit, ...]

    def metrics(self) -> DataFrame:
        """``(target, fold, best_iteration)``: the trees that were kept."""
        return self.spark.createDataFrame([(f.target, f.fold, f.trees) for f in self.fits], "target string, fold int, best_iteration int")

    def oof(self, rows: DataFrame) -> DataFrame:
        """``(ID, target, fold, y, y_log, pred_log)``: each row by the model of its own fold. The rows of a target are read once for all folds."""

        def of(own: list[Fit]) -> DataFrame:
            scored = own[0].model.stages[0].transform(rows.where((F.col("target") == own[0].target) & F.col("fold").isin([f.fold for f in own])))
            for fit in own:
                scored = fit.model.stages[-1].copy().setPredictionCol(f"_pred_{fit.fold}").transform(scored)
            # a branch that is not taken is not computed
            predicted = F.coalesce(*[F.when(F.col("fold") == f.fold, F.col(f"_pred_{f.fold}")) for f in own])
            return scored.select("ID", "target", "fold", "y", "y_log", predicted.alias("pred_log"))

        return reduce(DataFrame.unionByName, map(of, self._by_target().values()))

    def _by_target(self) -> dict[str, list[Fit]]:
        found: dict[str, list[Fit]] = {}
        for fit in self.fits:
            found.setdefault(fit.target, []).append(fit)
        return found

    def test(self, test: DataFrame) -> DataFrame:
        """``(ID, <target>…)``: mean of the fold models on the log scale. All models see a row in one pass, so nothing is shuffled."""
        scored, done = test, []
        for target, own in self._by_target().items():
            scored = own[0].model.stages[0].transform(scored)
            names = [f"_{target}_{f.fold}" for f in own]
            for name, fit in zip(names, own, strict=True):
                scored = fit.model.stages[-1].copy().setPredictionCol(name).transform(scored)
            mean = reduce(lambda a, b: a + b, [F.col(n) for n in names]) / F.lit(float(len(names)))
            done.append(f"_mean_{target}")
            scored = scored.select(*test.columns, *done[:-1], mean.alias(done[-1]))
        return scored.select("ID", *[F.col(name).alias(target) for name, target in zip(done, self._by_target(), strict=True)])

    def save(self, path: str, stage: str) -> DataFrame:
        """Write every model and, last, the manifest that ``load`` reads: ``(stage, target, fold, path, trees, features, settings)``."""

        def write(fit: Fit) -> str:
            place = f"{path}/stage={stage}/target={fit.target}/fold={fit.fold}"
            fit.model.write().overwrite().save(place)
            return place

        places = side_by_side(self.spark, write, self.fits)
        listed = [(stage, f.target, f.fold, place, f.trees, list(f.features), json.dumps(f.settings, sort_keys=True)) for f, place in zip(self.fits, places, strict=True)]
        manifest = self.spark.createDataFrame(listed, MANIFEST)
        write_json(manifest.coalesce(1), f"{path}/manifest/stage={stage}")
        return manifest


MANIFEST = "stage string, target string, fold int, path string, trees int, features array<string>, settings string"


def load_forest(spark: SparkSession, path: str, stage: str) -> Forest:
    """The models a manifest names. A model that is gone is an error of the read."""
    rows = read_json_lines(spark, f"{path}/manifest/stage={stage}", MANIFEST).orderBy("target", "fold").collect()

    def read(row) -> Fit:
        return Fit(row["target"], row["fold"], tuple(row["features"]), json.loads(row["settings"]), PipelineModel.load(row["path"]))

    return Forest(spark, tuple(side_by_side(spark, read, rows)))


def present(rows: DataFrame, folds: int = FOLDS) -> list[tuple[str, int]]:
    """The targets and folds that have rows: at most targets x folds. A sample tells them as well as the rows it is of."""
    found = rows.where(F.col("fold").between(0, folds - 1)).select("target", "fold").distinct().collect()
    return sorted((r["target"], r["fold"]) for r in found)


def fit_forest(
    rows: DataFrame,
    features: Features,
    settings: Mapping[str, Mapping] | None = None,
    folds: int = FOLDS,
    stop_early: bool = True,
    parallelism: int = PARALLEL_JOBS,
    **common,
) -> Forest:
    """A model per target and fold of ``rows`` (a ``fold_layout``), each trained on all of them; several at a time.

    ``features`` names those of each target; ``settings`` has settings by target, which go before ``common`` ones.
    """
    own = settings or {}
    # at most targets x folds
    counts = {(r["target"], r["fold"]): r["count"] for r in rows.groupBy("target", "fold").count().collect()}
    labelled: dict[str, int] = {}
    for (target, _), n in counts.items():
        labelled[target] = labelled.get(target, 0) + n

    def fit(task: tuple[str, int]) -> Fit:
        target, fold = task
        return fit_one(rows, target, fold, features[target], {**common, **own.get(target, {})}, stop_early, math.ceil(labelled[target] / TASK_ROWS))

    at_a_time = max(1, min(parallelism, HELD_ROWS // max(labelled.values(), default=1)))
    present_folds = sorted((target, fold) for target, fold in counts if 0 <= fold < folds)
    return Forest(rows.sparkSession, tuple(side_by_side(rows.sparkSession, fit, present_folds, at_a_time)))


# --- search -----------------------------------------------------------------------------


def search_space(trials: int, seed: int = SEED, most_trees: int = 20) -> list[dict]:
    """Seeded random settings; rates are drawn on a log scale."""
    draw = random.Random(seed)
    return [
        {
            "maxIter": draw.choice([most_trees // 4, most_trees // 2, most_trees]),
            "stepSize": 10 ** draw.uniform(-2, -0.5),
            "maxDepth": draw.randint(2, 4),
            "minInstancesPerNode": draw.randint(10, 100),
            "subsamplingRate": draw.uniform(0.5, 1.0),
            "featureSubsetStrategy": str(round(draw.uniform(0.4, 1.0), 3)),
        }
        for _ in range(trials)
    ]


def rmse_log(predictions: DataFrame) -> Column:
    error = F.col("y_log") - F.col("pred_log")
    return F.sqrt(F.avg(error * error))


def search(
    rows: DataFrame,
    features: Features,
    candidates: Sequence[Mapping],
    survivors: int = 2,
    folds: int = FOLDS,
    trained: int = TRAINED,
    parallelism: int = PARALLEL_JOBS,
) -> DataFrame:
    """Successive halving for every target: all candidates on its first fold, the best ``survivors`` on the others.

    Errors are RMSE on the log scale over sampled rows of the fold left out. Returns one row per target and trial:
    ``(target, trial, settings, n_folds, rmse_log, pruned, best)``; ``rmse_log`` is the mean over its folds, and the best
    is that of the survivors with the smallest, ties to the lower trial.
    """
    spark, sample = rows.sparkSession, training_sample(rows, trained)
    by_target: dict[str, list[int]] = {}
    for target, fold in present(sample, folds):
        by_target.setdefault(target, []).append(fold)

    def score(task: tuple[str, int, int]) -> float:
        target, fold, trial = task
        fit = fit_one(sample, target, fold, features[target], candidates[trial], stop_early=False)
        held = sample.where((F.col("target") == target) & (F.col("fold") == fold))
        return fit.model.transform(held).agg(rmse_log(held)).first()[0]

    def scores(tasks: list[tuple[str, int, int]]) -> dict[tuple[str, int, int], float]:
        return dict(zip(tasks, side_by_side(spark, score, tasks, parallelism), strict=True))

    found = scores([(target, own[0], trial) for target, own in by_target.items() for trial in range(len(candidates))])
    kept = {target: sorted(range(len(candidates)), key=lambda trial: (found[target, own[0], trial], trial))[:survivors] for target, own in by_target.items()}
    found |= scores([(target, fold, trial) for target, own in by_target.items() for fold in own[1:] for trial in kept[target]])

    results = []
    for target, own in by_target.items():
        mean = {}
        for trial in range(len(candidates)):
            known = [found[target, fold, trial] for fold in own if (target, fold, trial) in found]
            mean[trial] = (sum(known) / len(known), len(known))
        best = min(kept[target], key=lambda trial: (mean[trial][0], trial))
        for trial, settings in enumerate(candidates):
            text = json.dumps(dict(settings), sort_keys=True)
            results.append((target, trial, text, mean[trial][1], float(mean[trial][0]), trial not in kept[target], trial == best))
    return spark.createDataFrame(results, "target string, trial int, settings string, n_folds int, rmse_log double, pruned boolean, best boolean")


def write_settings(found: DataFrame, path: str) -> None:
    """The best settings of each target as JSON lines."""
    write_json(found.where("best").select("target", "settings").coalesce(1), path)


def read_settings(spark: SparkSession, path: str) -> dict[str, dict]:
    """Settings by target, as ``write_settings`` wrote them."""
    return {r["target"]: json.loads(r["settings"]) for r in read_json_lines(spark, path, "target string, settings string").collect()}
