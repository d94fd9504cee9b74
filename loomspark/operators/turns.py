"""Sessions by marker (turns led by the user) and chunks of turns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.text import blank, trim, unix_stamp

#: Columns that tell conversations apart, and messages within one.
CONV, IDX = "conversation_id", "msg_idx"


def assign_turns(messages: DataFrame, conv: str = CONV, idx: str = IDX) -> DataFrame:
    """messages with turn_index: a new turn at each user message.

    Messages before the first user message are in no turn; without any user message all are in turn 0.
    """
    ordered = W.partitionBy(conv).orderBy(idx).rowsBetween(W.unboundedPreceding, W.currentRow)
    users = F.sum(F.when(F.col("role") == "user", 1).otherwise(0))
    found = messages.withColumns({"_at": users.over(ordered), "_users": users.over(W.partitionBy(conv))})
    return found.filter("_at > 0 OR _users = 0").withColumn("turn_index", F.greatest(F.col("_at") - 1, F.lit(0)).cast("int")).drop("_at", "_users")


def turns(messages: DataFrame, conv: str = CONV, idx: str = IDX) -> DataFrame:
    """A row for each turn: first and last message, start time, user's text, the others' texts."""
    has = set(messages.columns)
    of = lambda c: F.coalesce(F.col(c), F.lit("")) if c in has else F.lit("")
    title_url = trim(F.concat(of("title"), F.lit(" "), of("url")))
    other = F.when(~blank("text"), trim("text")).when(title_url != "", title_url)
    start = F.col("create_time") if "create_time" in has else F.lit(None).cast("double")
    spoken = F.struct(F.col(idx).alias("i"), other.alias("s"))
    return (
        assign_turns(messages, conv, idx).groupBy(conv, "turn_index")
        .agg(
            F.min(idx).alias("start_message_idx"), F.max(idx).alias("end_message_idx"), F.min_by(start, F.col(idx)).alias("start_time"),
            F.coalesce(F.min_by(F.when(F.col("role") == "user", trim("text")), F.when(F.col("role") == "user", F.col(idx))), F.lit("")).alias("user_text"),
            F.array_join(F.transform(F.array_sort(F.collect_list(F.when((F.col("role") != "user") & other.isNotNull(), spoken))), lambda x: x.s), "\n").alias("assistant_text"),
        )
    )


def thread_start(create_time: Column, messages: Column) -> Column:
    """The conversation's time, else that of its first message."""
    return F.coalesce(create_time, F.get(messages, F.lit(0)).create_time)


def normalise_breakpoints(points: Column, total: Column) -> Column:
    """Sorted different turn numbers within 0 < b < total."""
    kept = F.array_sort(F.array_distinct(F.filter(points, lambda b: (b > 0) & (b < total))))
    return F.when(total > 1, kept).otherwise(F.array().cast("array<int>"))


def stride_breakpoints(total: Column, target: int) -> Column:
    """Every target-th turn."""
    if target <= 0:
        return F.array().cast("array<int>")
    return F.when(total > target, F.sequence(F.lit(target), total - 1, F.lit(target))).otherwise(F.array().cast("array<int>"))


def chunk_number(turn: Column, points: Column) -> Column:
    """1-based number of the chunk that a turn falls into."""
    return F.size(F.filter(points, lambda b: b <= turn)) + 1


def decide(turn_rows: DataFrame, target: int, conv: str = CONV, decided: DataFrame | None = None) -> DataFrame:
    """(conv, n_turns, breakpoints): decided(conv, breakpoints) normalised; fixed stride where it says nothing."""
    per = turn_rows.groupBy(conv).agg(F.count(F.lit(1)).cast("int").alias("n_turns"))
    n = F.col("n_turns")
    if decided is None:
        return per.withColumn("breakpoints", stride_breakpoints(n, target))
    given = F.coalesce(F.col("_given"), F.array().cast("array<int>"))
    joined = per.join(decided.select(conv, F.col("breakpoints").alias("_given")), conv, "left")
    points = F.when(F.size(given) > 0, normalise_breakpoints(given, n)).otherwise(stride_breakpoints(n, target))
    return joined.withColumn("breakpoints", points).drop("_given")


def chunk_messages(messages: DataFrame, target: int, conv: str = CONV, idx: str = IDX, decided: DataFrame | None = None) -> DataFrame:
    """messages with turn_index and chunk_number.

    Turns, decisions and chunks share one exchange by conversation.
    """
    assigned = assign_turns(messages, conv, idx)
    if decided is None and target > 0:
        return assigned.withColumn("chunk_number", (F.floor(F.col("turn_index") / target) + 1).cast("int"))
    plan = decide(assigned.select(conv, "turn_index").distinct(), target, conv, decided)
    return assigned.join(plan.select(conv, "breakpoints"), conv).withColumn("chunk_number", chunk_number(F.col("turn_index"), F.col("breakpoints"))).drop("breakpoints")


def chunks(threads: DataFrame, target: int, decided: DataFrame | None = None) -> DataFrame:
    """Chunk rows of threads (see schemas.CHUNK). Empty threads have none."""
    from .linearize import messages as exploded

    rows = chunk_messages(exploded(threads), target, decided=decided)
    fields = [c for c in rows.columns if c not in (CONV, IDX, "turn_index", "chunk_number")]
    own = rows.groupBy(CONV, "chunk_number").agg(
        F.min("turn_index").alias("turn_start"), (F.max("turn_index") + 1).alias("turn_end"),
        F.transform(F.array_sort(F.collect_list(F.struct(IDX, F.struct(*fields).alias("m")))), lambda x: x.m).alias("messages"),
    )
    head = threads.select(CONV, "title", thread_start(F.col("create_time"), F.col("messages")).alias("thread_start_time"))
    return own.join(head, CONV).select(CONV, "title", "thread_start_time", "chunk_number", "turn_start", "turn_end", "messages")


def chunk_path(stem: Column) -> Column:
    """<stem>/<start or 'thread'>_<n>.json of a chunk row."""
    start = F.coalesce(F.nullif(unix_stamp("thread_start_time"), F.lit("")), F.lit("thread"))
    return F.concat(stem, F.lit("/"), start, F.lit("_"), F.col("chunk_number").cast("string"), F.lit(".json"))
