"""Structured Streaming counterparts: an extension, as batches are all that the operators need."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.stages import stage_root


def source(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table's files as a stream. The pattern names just that table."""
    schema = spark.read.parquet(f"{folder}/{table}.parquet").schema
    return spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(f"{folder}/{table[:-1]}[{table[-1]}].parquet")


def timed(df: DataFrame, ts: str, late: str) -> DataFrame:
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)


def tumbling_counts(df: DataFrame, ts: str, size: str, keys: list[str], value: str) -> DataFrame:
    return df.groupBy(F.window(ts, size), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))


def session_counts(df: DataFrame, ts: str, gap: str, keys: list[str]) -> DataFrame:
    return df.groupBy(F.session_window(ts, gap), *keys).agg(F.count(F.lit(1)).alias("n"))


def without_repeats(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.dropDuplicatesWithinWatermark(keys)


def completed(stream: DataFrame, mode: str) -> DataFrame:
    """Everything a stream gives until its present input is used up, as a table in the shared folder.

    complete: each batch replaces the table. append: batches add to it, once each.
    """
    spark, folder = stream.sparkSession, f"{stage_root(stream.sparkSession)}/streams/{uuid.uuid4().hex}"
    schema = stream.schema

    def put(batch: DataFrame, epoch: int) -> None:
        where = f"{folder}/table" if mode == "complete" else f"{folder}/table/epoch={epoch}"
        batch.write.mode("overwrite").parquet(where)

    query = stream.writeStream.foreachBatch(put).outputMode(mode).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{folder}/table")
