"""Resumable enrichment: new records are appended to a store once per id."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamfold.operators.columns import any_of
from loamfold.sources.readers import exists

#: Times keep their microseconds on the way through a record's text.
TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def read_store(spark: SparkSession, store: str, schema: T.StructType) -> DataFrame:
    """The store without its batch column; empty before the first batch."""
    if not exists(spark, store):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(store).drop("batch")


def first_records(stream: DataFrame, key: str, order: str) -> DataFrame:
    """``record`` (JSON) of each key of a stream once: the usable one that is last by ``order`` in the key's first batch.

    Keyed state holds, for good and divided over the shuffle partitions of the first start, the newest record of each key
    and the times of the first and the last batch it was in; a key in its first batch has been in no other. A batch that
    is repeated has the time of its first try. A record without any value is not usable. Equal orders: the greatest text;
    a null order comes before all others; a null key is a key.
    """
    values = [F.col(c).isNotNull() for c in stream.columns if c not in (key, order)]
    records = stream.where(any_of(values)).select(
        F.col(key).alias("_key"),
        F.struct(F.col(order).alias("order"), F.to_json(F.struct(*stream.columns), TIMES).alias("record")).alias("_newest"),
        F.current_timestamp().alias("_batch"),
    )
    known = records.groupBy("_key").agg(F.max("_newest").alias("newest"), F.min("_batch").alias("first"), F.max("_batch").alias("last"))
    return known.where(F.col("first") == F.col("last")).select(F.col("newest.record").alias("record"))


def enrich_available(
    spark: SparkSession,
    drops: str,
    store: str,
    checkpoint: str,
    schema: T.StructType,
    order: str,
    enrich: Callable[[DataFrame], DataFrame],
    key: str = "ID",
    files_per_batch: int = 1000,
) -> DataFrame:
    """Process every record that has been dropped so far, then stop; a later call resumes.

    A record without any value is not stored, so its id stays open. Within a
    batch the latest usable record per id wins, across batches the first stored one.
    The store is only written: which ids are done is keyed state. A batch writes its own
    folder, so a replay after a failure replaces it. Store and checkpoint belong
    together; a store whose checkpoint is gone is an error.
    """
    if exists(spark, store) and not exists(spark, checkpoint):
        raise ValueError(f"{store} has records, but its checkpoint {checkpoint} is missing")
    out_schema = enrich(spark.createDataFrame([], schema)).schema

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(F.from_json("record", schema, TIMES).alias("r")).select("r.*")
        enrich(rows).write.mode("overwrite").parquet(f"{store}/batch={batch_id}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(drops)
    query = (
        first_records(stream, key, order)
        .writeStream.foreachBatch(write_batch)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return read_store(spark, store, out_schema)
