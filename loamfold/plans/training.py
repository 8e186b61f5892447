"""The two-stage training plan over all targets, for any learner.

Stage 1 predicts every labelled row out of fold and every test row by the mean of the fold models. Stage 2 sees, beside
the features, what stage 1 says of the row's *other* targets. These are pivoted once for all targets, next to the wide
rows; a target's own prediction is left out by name. Two learners: straight lines, all fitted in one aggregate pass, and
boosted trees, fitted side by side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamfold.functions.fixed import FOLDS, TARGETS
from loamfold.functions.nulls import from_log
from loamfold.operators import columns, folds, learning, trees
from loamfold.session import stored


class Fitted(Protocol):
    """Models of all targets and folds."""

    def oof(self, rows: DataFrame) -> DataFrame:
        """``(ID, target, fold, y, y_log, pred_log)`` of labelled rows, each by the model that did not see its fold."""

    def test(self, test: DataFrame) -> DataFrame:
        """``(ID, <target>…)``: mean of the fold models, log scale."""


class Learner(Protocol):
    """What ``two_stages`` needs: its columns, how gaps are filled, which features a target has, and a fit."""

    base: Sequence[str]

    def filled(self, train: DataFrame, test: DataFrame, names: Sequence[str]) -> tuple[DataFrame, DataFrame]: ...

    def crossed(self, frame: DataFrame, targets: Sequence[str]) -> DataFrame: ...

    def features(self, stage: int, targets: Sequence[str]) -> dict[str, list[str]]: ...

    def fit(self, rows: DataFrame, features: Mapping[str, Sequence[str]]) -> Fitted: ...


def oof_name(target: str) -> str:
    return f"oof_{target}"


@dataclass(frozen=True)
class FittedLines:
    lines: DataFrame
    features: Mapping[str, Sequence[str]]

    def oof(self, rows: DataFrame) -> DataFrame:
        predicted = (F.col("slope") * _own_feature(self.features) + F.col("intercept")).alias("pred_log")
        return rows.join(self.lines, ["target", "fold"]).select("ID", "target", "fold", "y", "y_log", predicted)

    def test(self, test: DataFrame) -> DataFrame:
        fitted = learning.line_parameters(self.lines)

        def mean(target: str) -> Column:
            # the mean of lines is a line
            slope, intercept = (sum(line[part] for line in fitted[target]) / len(fitted[target]) for part in (0, 1))
            return F.lit(slope) * F.col(self.features[target][0]) + F.lit(intercept)

        return test.select("ID", *[(mean(t) if t in fitted else F.lit(None).cast("double")).alias(t) for t in self.features])


def _own_feature(features: Mapping[str, Sequence[str]]) -> Column:
    """The one feature of the row's target."""
    names = {t: f[0] for t, f in features.items()}
    if len(set(names.values())) == 1:
        return F.col(next(iter(names.values())))
    return F.coalesce(*[F.when(F.col("target") == t, F.col(name)) for t, name in names.items()])


@dataclass(frozen=True)
class Lines:
    """A straight line on ``x``, then one on the mean of the other targets' predictions. Gaps stay: such rows are not predicted."""

    x: str

    @property
    def base(self) -> list[str]:
        return [self.x]

    def filled(self, train: DataFrame, test: DataFrame, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
        return train, test

    def crossed(self, frame: DataFrame, targets: Sequence[str]) -> DataFrame:
        """Add ``others_<target>``, in place of the single predictions."""

        def others(target: str) -> Column:
            rest = F.array_compact(F.array(*[F.col(oof_name(t)) for t in targets if t != target]))
            return F.when(F.size(rest) > 0, F.aggregate(rest, F.lit(0.0), lambda a, b: a + b) / F.size(rest)).alias(f"others_{target}")

        kept = [c for c in frame.columns if c not in {oof_name(t) for t in targets}]
        return frame.select(*kept, *[others(t) for t in targets])

    def features(self, stage: int, targets: Sequence[str]) -> dict[str, list[str]]:
        return {t: [self.x if stage == 1 else f"others_{t}"] for t in targets}

    def fit(self, rows: DataFrame, features: Mapping[str, Sequence[str]]) -> FittedLines:
        return FittedLines(learning.fit_lines(rows.withColumn("_x", _own_feature(features)), "_x"), features)


@dataclass(frozen=True)
class BoostedTrees:
    """Boosted trees on ``base``, then on it and the other targets' predictions. Gaps get the median of the training table's column.

    ``settings`` are those of single targets, as a search stores them; ``common`` those of all.
    """

    base: Sequence[str]
    common: Mapping[str, object] = field(default_factory=dict)
    settings: Mapping[str, Mapping] = field(default_factory=dict)
    stop_early: bool = True

    def filled(self, train: DataFrame, test: DataFrame, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
        medians = columns.fit_medians(train, names)
        return columns.fill_medians(train, medians), columns.fill_medians(test, medians)

    def crossed(self, frame: DataFrame, targets: Sequence[str]) -> DataFrame:
        return frame

    def features(self, stage: int, targets: Sequence[str]) -> dict[str, list[str]]:
        return {t: [*self.base, *([oof_name(o) for o in targets if o != t] if stage == 2 else [])] for t in targets}

    def fit(self, rows: DataFrame, features: Mapping[str, Sequence[str]]) -> trees.Forest:
        return trees.fit_forest(rows, features, self.settings, FOLDS, self.stop_early, **self.common)


@dataclass(frozen=True)
class Stage:
    """``oof`` and ``test`` as a ``Fitted`` gives them, stored, and the models."""

    oof: DataFrame
    test: DataFrame
    models: Fitted

    def scores(self) -> DataFrame:
        """RMSE per target on the original scale."""
        return learning.rmse_pooled(self.oof.where(F.col("pred_log").isNotNull()).withColumn("pred", F.expm1("pred_log")))

    def predictions(self, prefix: str = "Target_") -> DataFrame:
        return self.test.select("ID", *[from_log(F.col(t)).alias(f"{prefix}{t}") for t in self.test.columns if t != "ID"])


def _rows(train: DataFrame, fold_table: DataFrame, targets: Sequence[str], features: Mapping[str, Sequence[str]]) -> DataFrame:
    """Labelled rows of all targets, each with the features of its own target; those that few targets have are NULL for others."""
    names = sorted({name for own in features.values() for name in own})
    of_block = [F.max(F.when(F.col("target") == t, F.col("fold"))).alias(f"_fold_{t}") for t in targets]
    wide = train.select("ID", "spatial_block", *names, *[t for t in targets if t not in names])
    # rows get the folds of all targets at once, and are dealt to tasks before there is one per target
    placed = wide.join(fold_table.groupBy("spatial_block").agg(*of_block), "spatial_block").drop("spatial_block")
    # in order, so that the rows that are drawn for a tree are the same in every run
    dealt = placed.repartition("ID", *targets).sortWithinPartitions("ID", *targets, *names)
    return trees.fold_layout(dealt, {t: features[t] for t in targets})


def _stage(learner: Learner, rows: DataFrame, test: DataFrame, number: int, targets: Sequence[str]) -> Stage:
    fitted = learner.fit(rows, learner.features(number, targets))
    return Stage(stored(fitted.oof(rows), f"oof-{number}"), stored(fitted.test(test), f"test-{number}"), fitted)


@dataclass(frozen=True)
class Training:
    """Wide ``train`` (``ID``, place, targets, features) and ``test`` tables prepared for a learner."""

    learner: Learner
    train: DataFrame
    test: DataFrame
    fold_table: DataFrame
    targets: Sequence[str] = tuple(TARGETS)

    @classmethod
    def of(cls, train: DataFrame, test: DataFrame, learner: Learner, targets: Sequence[str] = TARGETS) -> Training:
        placed, seen = learner.filled(folds.with_blocks(train), test, learner.base)
        wide = stored(placed.select("ID", "spatial_block", *learner.base, *[t for t in targets if t not in learner.base]), "training-table")
        table = folds.target_folds(folds.labelled_long(wide, targets, ["ID", "spatial_block"]))
        return cls(learner, wide, stored(seen.select("ID", *learner.base), "test-table"), table, targets)

    def rows(self) -> DataFrame:
        """Labelled rows of all targets in folders per target and fold."""
        return _rows(self.train, self.fold_table, self.targets, self.learner.features(1, self.targets))

    def first(self) -> Stage:
        return _stage(self.learner, self.rows(), self.test, 1, self.targets)

    def second(self, first: Stage) -> Stage:
        """On the rows with the other targets' predictions: out of fold for labelled rows, the fold mean for test rows."""
        names = [oof_name(t) for t in self.targets]
        pivoted = stored(learning.to_wide(first.oof, "pred_log", self.targets, "oof_"), "crossed")
        # read again for the medians and for the rows
        train = stored(self.train.join(pivoted, "ID", "left"), "crossed-table")
        test = self.test.join(first.test.select("ID", *[F.col(t).alias(oof_name(t)) for t in self.targets]), "ID", "left")
        train, test = self.learner.filled(train, test, names)
        crossed, seen = (self.learner.crossed(frame, self.targets) for frame in (train, test))
        rows = _rows(crossed, self.fold_table, self.targets, self.learner.features(2, self.targets))
        return _stage(self.learner, rows, seen, 2, self.targets)

    def both(self) -> tuple[Stage, Stage]:
        first = self.first()
        return first, self.second(first)


def two_stages(train: DataFrame, test: DataFrame, learner: Learner, targets: Sequence[str] = TARGETS) -> tuple[Stage, Stage]:
    """Both stages of ``train`` and ``test``; see ``Training``. Targets without a labelled row have no models and NULL predictions."""
    return Training.of(train, test, learner, targets).both()
