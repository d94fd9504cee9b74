"""Sharding by jump consistent hashing.

A row's key alone and the number of shards decide its shard. Appending a shard moves about 1/(n+1)
of the rows, all of them into the new shard; no ring table is kept.

Defined results: a null key hashes like the constant seed, so such rows share one shard. Repeated keys
land together, repeated rows each have a slot. A null text has size 1. Slots number the rows of a shard
without gaps, by rising doc_id (null first), size and checksum. An empty table gives an empty result. ``with_slots`` passes
all columns through, whatever they are called.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from .common import stored


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key.

    The generator's steps run for all keys at once; keys that have left the range drop out.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    state = keys.astype(np.uint64).copy()
    shard = np.zeros(len(state), dtype=np.int64)
    live = np.arange(len(state))
    ahead = np.zeros(len(state), dtype=np.int64)
    while len(live):
        shard[live] = ahead
        state[live] = state[live] * np.uint64(2862933555777941757) + np.uint64(1)
        draw = ((state[live] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        ahead = ((shard[live] + 1) * (2147483648.0 / draw)).astype(np.int64)
        inside = ahead < shards
        live, ahead = live[inside], ahead[inside]
    return shard


def jump_shard(key: Column, shards: int) -> Column:
    """Shard number 0 .. shards-1 of a key column of any type."""

    def of(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(dtype=np.int64).view(np.uint64), shards), dtype="int32")

    return F.pandas_udf(of, "int")(F.xxhash64(key))


def with_slots(df: DataFrame, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without gaps.

    Each task counts its own rows of a shard; what earlier tasks hold is added afterwards from one
    small row for each task and shard. No shard is ever gathered in one task.
    """
    packed = df.select(F.struct("*").alias("row"), F.col(shard).cast("int").alias("shard"))
    schema = T.StructType([*packed.schema.fields, T.StructField("task", T.IntegerType()), T.StructField("at", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            shards = batch.column(1).to_numpy(zero_copy_only=False)
            at = np.zeros(len(shards), dtype=np.int64)
            for s in np.unique(shards):
                own = np.flatnonzero(shards == s)
                at[own] = seen.get(int(s), 0) + np.arange(len(own))
                seen[int(s)] = seen.get(int(s), 0) + len(own)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(shards), task, dtype=np.int32)), pa.array(at)],
                names=["row", "shard", "task", "at"],
            )

    own = stored(packed.mapInArrow(number, schema), "slots")
    earlier = W.partitionBy("shard").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    before = own.groupBy("shard", "task").count().select("shard", "task", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))  # tasks x shards rows
    return own.join(before, ["shard", "task"]).select("row.*", (F.col("before") + F.col("at")).alias(slot))


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Every document's shard among ``shards``, its slot there, and its shard if one more were appended."""
    key, text = F.col("doc_id"), F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(
        key,
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        jump_shard(key, shards).alias("shard"),
        jump_shard(key, shards + 1).alias("grown_shard"),
    )
    # in order of their ids and texts, so that a shard's slots are the same however often they are made;
    # rows that are alike in all are interchangeable, and dealt out at random
    order = ["shard", "doc_id", "size", "text_crc32", "any"]
    return with_slots(slim.withColumn("any", F.rand(0)).repartitionByRange(*order).sortWithinPartitions(*order).drop("any"))
