"""Readers with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamfold.functions.documents import parse_document


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Header CSV with a declared schema; with ``columns`` only those are parsed."""
    table = spark.read.schema(schema).option("header", True).csv(path)
    return table if columns is None else table.select(*columns)


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    table = spark.read.parquet(path)
    return table if columns is None else table.select(*columns)


def read_documents(spark: SparkSession, path: str, key_pattern: str = r"([^/]+)\.json$") -> DataFrame:
    """One row per document file: ``(key, text)``; the key is the pattern's first group in the file path."""
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(path)
    return files.select(
        F.regexp_extract(F.col("_metadata.file_path"), key_pattern, 1).alias("key"), F.trim("value").alias("text")
    )


def usable_documents(documents: DataFrame) -> DataFrame:
    """Documents that can be read; a literal null or broken text is a miss, to be fetched again."""
    return documents.where(parse_document(F.col("text"))["properties"].isNotNull())


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines with varying keys; broken lines are skipped, absent keys are NULL."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_name_list(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of names, one row per name with its position."""
    whole = spark.read.option("wholetext", True).text(path)
    return whole.select(F.posexplode(F.from_json("value", "array<string>")).alias("position", "name"))


def missing_names(required: DataFrame, listing: DataFrame) -> DataFrame:
    """Required file names that the listing does not hold."""
    return required.join(listing, "file_name", "left_anti")


def list_folder(spark: SparkSession, path: str, name_pattern: str = r"([^/]+)$") -> DataFrame:
    """Names of the files in a folder, on any file system Spark reads; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.regexp_extract("path", name_pattern, 1).alias("file_name")).distinct()


def exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark finds the path, on any file system it reads; contents are not read."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_if_present(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    """A CSV covariate table, or None when it has not been landed."""
    return read_csv(spark, path, schema) if exists(spark, path) else None
