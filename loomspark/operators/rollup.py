"""Chunk summaries to threads: ordered groups, earliest starts, windows with partial results, resume."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import file_component, padded
from .budget import fixed_windows

ORDER = ["chunk_number", "turn_start"]


def grouped(summaries: DataFrame) -> DataFrame:
    """One row a conversation: its chunks' rows in order. Rows without an id are left out."""
    fields = [c for c in summaries.columns if c not in ("conversation_id", *ORDER)]
    named = summaries.filter(F.coalesce("conversation_id", F.lit("")) != "")
    return named.groupBy("conversation_id").agg(F.array_sort(F.collect_list(F.struct(*ORDER, *fields))).alias("chunks"), F.min("thread_start_time").alias("thread_start_time"))


def start_or(model_start: Column | str, earliest: Column | str = "thread_start_time") -> Column:
    """The earliest known start, else what the model says."""
    return F.coalesce(earliest, model_start) if isinstance(earliest, str) else F.coalesce(earliest, F.col(model_start) if isinstance(model_start, str) else model_start)


def driven_by(semantic: DataFrame, sentiment: DataFrame) -> DataFrame:
    """Sentiment chunks of conversations that have semantic ones; others are never rolled up."""
    return sentiment.join(semantic.select("conversation_id").distinct(), "conversation_id", "left_semi")


def pending(work: DataFrame, done: DataFrame, key: str = "out_path") -> DataFrame:
    """Work whose output isn't there yet."""
    return work.join(done.select(key), key, "left_anti")


def pending_chunks(chunks: DataFrame, summaries: DataFrame, sentiments: DataFrame, key: str = "rel_path") -> DataFrame:
    """Chunks that lack either output."""
    both = summaries.select(key).join(sentiments.select(key), key, "left_semi")
    return pending(chunks, both, key)


def two_level(summaries: DataFrame, partial: Callable[[DataFrame], DataFrame], final: Callable[[DataFrame], DataFrame], most: int = 5) -> tuple[DataFrame, DataFrame]:
    """(threads, parts): windows of ``most`` chunks through partial, then each thread's parts through final.

    partial takes rows with conversation_id, part, n_parts and rows (the window's chunks in order); final
    takes conversation_id and rows (the parts in order). Threads of one window skip final.
    """
    numbered = fixed_windows(summaries.filter(F.coalesce("conversation_id", F.lit("")) != ""), ["conversation_id"], ORDER, most, "part")
    fields = [c for c in summaries.columns if c not in ("conversation_id", *ORDER)]
    windows = numbered.groupBy("conversation_id", "part").agg(F.array_sort(F.collect_list(F.struct(*ORDER, *fields))).alias("rows"))
    sizes = windows.groupBy("conversation_id").agg(F.count(F.lit(1)).cast("int").alias("n_parts"))
    parts = partial(windows.join(sizes, "conversation_id"))
    payload = [c for c in parts.columns if c not in ("conversation_id", "part", "n_parts")]
    merged = final(parts.filter("n_parts > 1").groupBy("conversation_id").agg(F.array_sort(F.collect_list(F.struct("part", *payload))).alias("rows")))
    return parts.filter("n_parts = 1").select("conversation_id", *payload).unionByName(merged.select("conversation_id", *payload)), parts.filter("n_parts > 1")


def part_path(out_dir: str, kind: str = "summary") -> Column:
    """File of a partial rollup of a row with conversation_id, part and n_parts."""
    return F.concat(F.lit(out_dir.rstrip("/") + "/"), file_component("conversation_id"), F.lit(f".thread.{kind}.part"), padded("part", 2), F.lit("of"), padded("n_parts", 2), F.lit(".json"))
