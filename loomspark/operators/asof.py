"""As-of join: each row beside the last row of another table at its time.

Both sides are put into one order of keys and times and dealt out by ranges of it, so a key with most of
the rows is cut by time. Within a range the last right row is carried on by a window; what a range begins
with comes from the ranges before it, of which each tells its last right row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..shared import stored
from .order import dealt

ROWS = 1 << 20  # rows of a range, on average


def as_of(left: DataFrame, right: DataFrame, by: list[str], time: str, right_time: str, values: list[str], strict: bool = False, found: str | None = None) -> DataFrame:
    """left with the values of the last right row of the same keys whose time isn't later (strict: is earlier).

    All left rows stay, once each; the values are null where there is no such row. Null keys and null times
    match nothing. Of right rows at one time the one with the greatest values counts, null as the least.
    Both tables have the keys under the names in ``by``; values must have an order; found: a name for the
    time of the row that was found. Ranges grow in number with the rows.
    """
    keys = range(len(by))
    own = right.dropna(subset=[*by, right_time]).select(
        *(F.col(c).alias(f"k{i}") for i, c in enumerate(by)), F.col(right_time).alias("time"), F.lit(1 if strict else 0).alias("side"),
        F.struct(*(F.col(c).alias(f"v{i}") for i, c in enumerate(values))).alias("tie"),
    )
    asked = left.select(*(F.col(c).alias(f"k{i}") for i, c in enumerate(by)), F.col(time).alias("time"), F.lit(0 if strict else 1).alias("side"), F.struct("*").alias("l"))
    both = stored(asked.unionByName(own, allowMissingColumns=True), "as-of")
    usual, parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-both.count() // ROWS)
    order = [*(F.col(f"k{i}") for i in keys), F.col("time"), F.col("side"), F.col("tie")]
    ranged = dealt(both, order, parts if parts > usual else None).select("task", "at", "row.*")
    last = F.when(F.col("tie").isNotNull(), F.struct(*(F.col(f"k{i}") for i in keys), "time", "tie"))
    ends = ranged.groupBy("task").agg(F.max_by(last, F.when(last.isNotNull(), F.col("at"))).alias("end"))
    before = W.orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    begins = ends.select("task", F.last("end", True).over(before).alias("begin"))  # a row for each range
    carried = F.last(last, True).over(W.partitionBy("task").orderBy("at").rowsBetween(W.unboundedPreceding, W.currentRow))
    seen = ranged.withColumn("seen", carried).filter(F.col("l").isNotNull()).join(begins, "task").withColumn("seen", F.coalesce("seen", "begin"))
    same = F.lit(True)
    for i in keys:
        same = same & (F.col(f"seen.k{i}") == F.col(f"k{i}"))
    seen = seen.withColumn("seen", F.when(same & F.col("time").isNotNull(), F.col("seen")))
    told = [F.col("seen.time").alias(found)] if found else []
    return seen.select("l.*", *told, *(F.col(f"seen.tie.v{i}").alias(c) for i, c in enumerate(values)))
