"""Checks that once gave wrong or unstable answers."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from loamfold.functions.fixed import TARGETS
from loamfold.operators import columns, folds, predictions, tables


def test_strict_mask_raises_whatever_is_asked(spark):
    preds = spark.createDataFrame([(1, 2.0), (2, 3.0)], "ID long, Target_Al double")
    mask = spark.createDataFrame([(1, 1)], "ID long, Al int")
    for ask in (lambda df: df.count(), lambda df: df.select("ID").collect(), lambda df: df.collect()):
        with pytest.raises(PySparkException, match="no mask row for id 2"):
            ask(predictions.mask_strict(preds, mask))
        with pytest.raises(PySparkException, match="no mask row"):
            ask(predictions.mask_strict(preds, mask.select("ID")))
    assert predictions.mask_strict(preds.where("ID = 1"), mask).collect() == [(1, 2.0)]


def test_union_of_locations_does_not_depend_on_partitions(spark):
    rows = [(1, float(i % 7), float(i % 5)) for i in range(60)] + [(2, None, 1.0), (2, 3.0, None), (2, 3.0, 4.0), (3, None, None)]
    first = spark.createDataFrame(rows, "ID long, Latitude double, Longitude double")
    second = spark.createDataFrame([(1, -9.0, -9.0), (3, 5.0, 5.0)], first.schema)
    for n in (1, 3, 8):
        got = sorted(tables.union_locations([first.repartition(n), second]).collect())
        assert got == [(1, 0.0, 0.0), (2, 3.0, 4.0)]


def test_ratios_of_targets_are_no_features(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0, 3.0, 4.0, 5.0)], "ID long, Al double, Ca_Mg_ratio double, ratio_Ca_K double, log_Al double, ph double")
    assert columns.feature_columns(df, TARGETS) == ["ph"]


def test_rows_without_a_place_get_folds(spark):
    rows = [(i, None if i % 3 == 0 else float(i % 11), float(i % 13), 1.0 if i % 2 else None) for i in range(1000)]
    df = folds.with_blocks(spark.createDataFrame(rows, "ID long, Latitude double, Longitude double, Al double"))
    assert df.where("spatial_block IS NULL").isEmpty()
    fallback = [r["spatial_block"] for r in df.where("Latitude IS NULL").orderBy("ID").collect()]
    assert fallback == [f"r{i // 100}" for i in range(334)]
    folded = folds.with_target_folds(folds.labelled_long(df, ["Al"], ["ID", "spatial_block"]))
    assert folded.count() == 500
    assert folded.groupBy("spatial_block").agg(F.countDistinct("fold").alias("n")).where("n > 1").isEmpty()
    assert {r["fold"] for r in folded.where("spatial_block LIKE 'r%'").select("fold").distinct().collect()} == {0, 1, 2, 3}
