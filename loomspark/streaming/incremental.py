"""Glossary and turn counts over summaries as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import glossary as G
from ..sources.readers import exists

ADDITIONS = "seq bigint, seen_at double, pos int, term string, definition string"


def additions_stream(spark: SparkSession, path: str) -> DataFrame:
    """Additions from Parquet files as they are put into a folder."""
    return spark.readStream.schema(schemas.struct(ADDITIONS)).parquet(path)


def glossary_stream(additions: DataFrame, table: str, checkpoint: str):
    """Merge each micro-batch into the glossary kept under ``table``, one version a batch.

    A batch that is run again finds the version before it and writes its own anew.
    """
    spark = additions.sparkSession

    def merge(batch: DataFrame, number: int) -> None:
        before = f"{table}/v={number - 1}"
        prior = spark.read.parquet(before) if number and exists(spark, before) else spark.createDataFrame([], schemas.GLOSSARY_ENTRY)
        G.merge(batch, prior).write.mode("overwrite").parquet(f"{table}/v={number}")

    return additions.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)


def activity_stream(events: DataFrame, time: str = "ts", late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Events by window and type; what is later than the watermark is left out."""
    own = events.withWatermark(time, late)
    return own.groupBy(F.window(time, width), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
