"""Readers, writers, the memo table and the resumable stream on broken input."""

import os
import pathlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamfold.operators import joins
from loamfold.session import clear_stored, fresh_path, shared_folder, stored
from loamfold.sources import readers, writers
from loamfold.streaming.enrich import enrich_available


def test_shared_folder_is_the_configured_one(spark):
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_stored_keeps_rows_and_schema(spark):
    df = spark.range(5).withColumn("v", F.when(F.col("id") > 2, F.col("id") * 1.5))
    back = stored(df, "test")
    assert back.schema.simpleString() == df.schema.simpleString()
    assert back.exceptAll(df).isEmpty() and back.count() == 5


def test_clearing_removes_what_was_stored_and_nothing_else(spark):
    clear_stored(spark)
    mine, other = stored(spark.range(3), "mine"), fresh_path(spark, "other")
    spark.range(2).write.parquet(other)
    kept = fresh_path(spark, "kept")
    mine.where("id > 0").write.parquet(kept)
    (path,) = {name.rsplit("/", 1)[0] for name in mine.inputFiles()}
    assert readers.exists(spark, path) and clear_stored(spark) == 1
    assert not readers.exists(spark, path) and clear_stored(spark) == 0
    assert spark.read.parquet(kept).count() == 2 and spark.read.parquet(other).count() == 2


def test_json_lines_skip_broken_ones(spark):
    path = fresh_path(spark, "lines")
    lines = ['{"ID": 1, "a": 2.0}', '{"ID": 2, "b": 3.0}', '{"ID": 3, "a"', "garbage", '{"ID": 4}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    rows = readers.read_json_lines(spark, path, "ID long, a double, b double").collect()
    assert sorted((r["ID"], r["a"], r["b"]) for r in rows if r["ID"] != 4) == [(1, 2.0, None), (2, None, 3.0)]
    assert len(rows) == 3


def test_null_documents_are_misses(spark):
    path = fresh_path(spark, "docs")
    docs = [("a", "null"), ("b", '{"properties": {"layers": []}}'), ("c", "{broken"), ("d", '{"x": 1}')]
    writers.write_documents(spark.createDataFrame(docs, "key string, text string"), path)
    landed = readers.read_documents(spark, path, r"key=([^/]+)/")
    assert {r["key"] for r in landed.collect()} == {"a", "b", "c", "d"}
    assert {r["key"] for r in readers.usable_documents(landed).collect()} == {"b"}


def test_pending_counts_empty_records_as_open(spark):
    points = spark.range(1, 5).withColumnRenamed("id", "ID")
    cache = spark.createDataFrame([(1, 2.0, None), (2, None, None), (2, None, 1.0), (3, None, None)], "ID long, a double, b double")
    assert sorted(r["ID"] for r in joins.pending(points, cache).collect()) == [3, 4]
    assert joins.cache_progress(points, cache).first().asDict() == {"cached": 2, "remaining": 2}


def test_optional_merge_passes_through(spark):
    df = spark.range(2).withColumnRenamed("id", "ID")
    assert joins.optional_merge(df, None) is df
    assert readers.read_if_present(spark, fresh_path(spark, "absent"), "ID long") is None


def test_memo_table_computes_once(spark):
    path, calls = fresh_path(spark, "memo"), []

    def compute():
        calls.append(1)
        return spark.range(3)

    assert writers.memo_table(spark, path, compute).count() == 3
    assert writers.memo_table(spark, path, compute).count() == 3
    assert calls == [1]


def test_stream_resumes_and_skips_done_ids(spark):
    root = fresh_path(spark, "stream")
    schema = spark.createDataFrame([], "ID long, seq long, a double").schema

    def drop(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(f"{root}/drops")

    def run():
        return enrich_available(
            spark, f"{root}/drops", f"{root}/store", f"{root}/checkpoint", schema, "seq",
            lambda df: df.withColumn("twice", F.col("a") * 2),
        )

    drop([(1, 1, 5.0), (1, 2, 6.0), (2, 3, None)])
    assert [(r["ID"], r["a"], r["twice"]) for r in run().collect()] == [(1, 6.0, 12.0)]
    assert run().count() == 1
    drop([(1, 4, 9.0), (2, 5, 7.0)])
    assert sorted((r["ID"], r["a"]) for r in run().collect()) == [(1, 6.0), (2, 7.0)]


def test_stream_of_several_files_is_replayed_without_doubles(spark):
    root = fresh_path(spark, "stream")
    schema = spark.createDataFrame([], "ID long, seq long, at timestamp, a double").schema
    drops, store, checkpoint = f"{root}/drops", f"{root}/store", f"{root}/checkpoint"

    def drop(rows):
        # times with microseconds, a null order, a null key, long numbers
        spark.createDataFrame(rows, "ID long, seq long, at string, a double").repartition(3).write.mode("append").json(drops)

    def run():
        out = enrich_available(spark, drops, store, checkpoint, schema, "seq", lambda df: df.withColumn("us", F.date_format("at", "SSSSSS")))
        return sorted(((r["ID"], r["seq"], r["a"], r["us"]) for r in out.collect()), key=repr)

    big = 2**60 + 1
    drop([(1, big, "2024-01-01T00:00:00.000123Z", 1.0), (1, None, None, 2.0), (1, big - 1, None, 3.0), (None, 7, None, 4.0), (3, None, None, 8.0), (2, 1, None, None)])
    first = [(1, big, 1.0, "000123"), (3, None, 8.0, None), (None, 7, 4.0, None)]
    assert run() == first
    drop([(1, 2**61, None, 9.0), (None, 8, None, 9.0), (2, 5, None, 5.0), (2, 6, None, 6.0)])
    second = sorted([*first, (2, 6, 6.0, None)], key=repr)
    assert run() == second
    # the last batch was written but not marked as done: it comes again and replaces its folder
    last = max((int(name) for name in os.listdir(f"{checkpoint}/commits") if name.isdigit()))
    for name in (f"{last}", f".{last}.crc"):
        if os.path.exists(f"{checkpoint}/commits/{name}"):
            os.remove(f"{checkpoint}/commits/{name}")
    assert run() == second
    with pytest.raises(ValueError, match="checkpoint"):
        enrich_available(spark, drops, store, f"{root}/other", schema, "seq", lambda df: df)


def test_documents_are_written_by_many_tasks(spark):
    path = fresh_path(spark, "docs")
    docs = spark.range(0, 64, 1, 1).select(F.col("id").cast("string").alias("key"), F.lit("{}").alias("text"))
    writers.write_documents(docs, path)
    tasks = F.regexp_extract(F.col("path"), r"part-(\d+)-", 1)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(tasks.alias("task"))
    assert files.count() == 64
    assert files.distinct().count() > 4
    assert {r["key"] for r in readers.read_documents(spark, path, r"key=([^/]+)/").collect()} == {str(i) for i in range(64)}


def test_first_records_of_a_stream(spark):
    """The newest record of the first batch, chosen without a Python process: equal orders, null orders, null keys, later batches."""
    root = fresh_path(spark, "first")
    schema = T.StructType.fromDDL("ID long, seq long, a string")
    batches = [
        [(1, 5, "x"), (1, 5, "y"), (1, 4, "z"), (2, None, "n"), (2, 0, "o"), (3, None, "b"), (3, None, "a"), (4, 9, None), (None, 1, "p")],
        [(1, 6, "late"), (4, 1, "open"), (None, 2, "late"), (5, 1, "new")],
        [(1, 7, "late"), (4, 2, "late"), (2, 3, "late")],
    ]
    plans = []

    def enrich(df):
        plans.append(df._jdf.queryExecution().toString())
        return df

    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(f"{root}/drops")
        out = enrich_available(spark, f"{root}/drops", f"{root}/store", f"{root}/checkpoint", schema, "seq", enrich)
    found = sorted(((r["ID"], r["seq"], r["a"]) for r in out.collect()), key=str)
    assert found == sorted([(1, 5, "y"), (2, 0, "o"), (3, None, "b"), (4, 1, "open"), (None, 1, "p"), (5, 1, "new")], key=str)
    states = "".join(p.read_text() for p in pathlib.Path(f"{root}/checkpoint/state").rglob("metadata") if p.is_file())
    assert "stateStoreSave" in states and "applyInPandas" not in states and "GroupsWithState" not in states
