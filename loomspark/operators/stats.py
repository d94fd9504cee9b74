"""Counters of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def thread_counters(threads: DataFrame) -> DataFrame:
    """One row: threads, their messages, and the bytes of the messages' texts."""
    texts = F.coalesce(F.col("messages.text"), F.array().cast("array<string>"))
    size = F.aggregate(texts, F.lit(0).cast("bigint"), lambda a, t: a + F.coalesce(F.octet_length(t), F.lit(0)))
    return threads.agg(F.count(F.lit(1)).alias("n_threads"), F.coalesce(F.sum(F.size(texts).cast("bigint")), F.lit(0)).alias("n_messages"), F.coalesce(F.sum(size), F.lit(0)).alias("n_bytes"))
