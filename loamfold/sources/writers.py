"""Sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamfold.sources.readers import exists

#: Tasks per core that write documents.
WRITERS = 3


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, one object per row."""
    df.write.mode("overwrite").json(path)


def write_name_list(names: DataFrame, path: str) -> None:
    """The one row of ``names``, an array, as one JSON array."""
    names.select(F.to_json("names").alias("value")).write.mode("overwrite").text(path)


def write_documents(df: DataFrame, path: str, key: str = "key", text: str = "text") -> None:
    """One folder ``key=<key>`` per document, as landed responses are laid out.

    A document costs a file, whatever its length, so documents are dealt to all cores by number, and tasks put their
    files in place themselves instead of leaving all of them to the driver.
    """
    dealt = df.select(key, F.col(text).alias("value")).repartition(WRITERS * df.sparkSession.sparkContext.defaultParallelism, key)
    dealt.write.mode("overwrite").option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy(key).text(path)


def memo_table(spark: SparkSession, path: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """The stored table if a finished write is present, else compute, store and read it back."""
    if not exists(spark, f"{path}/_SUCCESS"):
        compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
