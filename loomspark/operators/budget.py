"""Windows of fixed size and prefixes under a byte budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def fixed_windows(rows: DataFrame, by: list[str], order: list[str], most: int, name: str = "window_number") -> DataFrame:
    """Rows of each group numbered by windows of ``most`` rows; one window if most isn't positive."""
    if most <= 0:
        return rows.withColumn(name, F.lit(1))
    at = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return rows.withColumn(name, (F.floor((at - 1) / most) + 1).cast("int"))


def within_budget(rows: DataFrame, by: list[str], order: list[str], line: Column, most: int) -> DataFrame:
    """Rows with _bytes (running sum of the lines' bytes) and fits: whether the budget holds up to here.

    Lines aren't empty, so the sum rises and what fits is a prefix.
    """
    running = F.sum(F.octet_length(line)).over(W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow))
    return rows.withColumn("_bytes", running).withColumn("fits", F.col("_bytes") <= most)


def prefix_text(rows: DataFrame, by: list[str], order: list[str], line: Column, most: int, marker: str, name: str) -> DataFrame:
    """One text a group: the lines that fit, and the marker if some don't."""
    cut = within_budget(rows.withColumn("_line", line), by, order, F.col("_line"), most)
    lines = F.transform(F.array_sort(F.collect_list(F.when(F.col("fits"), F.struct(*order, "_line")))), lambda x: x["_line"])
    return cut.groupBy(*by).agg(
        F.concat(F.array_join(lines, ""), F.when(F.bool_and("fits"), F.lit("")).otherwise(F.lit(marker))).alias(name),
        F.count(F.lit(1)).alias("n_lines"), F.count_if("fits").alias("n_kept"),
    )
