"""Places in a total order, without any task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..shared import stored


def dealt(rows: DataFrame, keys: list[Column], parts: int | None = None) -> DataFrame:
    """(row, k0, k1, .., task, at): rows dealt out by ranges of their keys, with their place in their task.

    Ties are told apart at random, so that rows alike in their keys don't land in one task.
    """
    named = [k.alias(f"k{i}") for i, k in enumerate(keys)]
    order = [*(f"k{i}" for i in range(len(keys))), "tie"]
    packed = rows.select(F.struct("*").alias("row"), *named).withColumn("tie", F.rand(0))
    ranged = packed.repartitionByRange(*([parts] if parts else []), *order).sortWithinPartitions(*order).drop("tie")
    place = F.monotonically_increasing_id()
    return stored(ranged.withColumns({"task": F.spark_partition_id(), "at": place.bitwiseAND((1 << 33) - 1)}), "dealt")


def offsets(ranged: DataFrame) -> DataFrame:
    """(task, before): how many rows earlier tasks hold; a row for each task."""
    earlier = W.orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    return ranged.groupBy("task").agg((F.max("at") + 1).alias("n")).select("task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))


def numbered(rows: DataFrame, keys: list[Column], name: str = "pos", kind: str = "int") -> DataFrame:
    """rows with their place, from 1, in the order of the keys (which may not be descending columns)."""
    ranged = dealt(rows, keys)
    return ranged.join(F.broadcast(offsets(ranged)), "task").select("row.*", (F.col("before") + F.col("at") + 1).cast(kind).alias(name))  # tasks are few


def nth_of(rows: DataFrame, group: Column, keys: list[Column], name: str = "nth") -> DataFrame:
    """rows with their number, from 1, within their group in the order of the keys; a group may hold all rows."""
    ranged = dealt(rows, [group, *keys])
    placed = ranged.join(F.broadcast(offsets(ranged)), "task").select("row", "k0", (F.col("before") + F.col("at")).alias("p"))
    first = stored(placed.groupBy("k0").agg(F.min("p").alias("first")), "first-places")
    same = placed.withColumnRenamed("k0", "own")
    return same.join(first, F.col("own").eqNullSafe(F.col("k0"))).select("row.*", (F.col("p") - F.col("first") + 1).cast("int").alias(name))
