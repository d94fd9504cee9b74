"""Greedy next-fit packing of rendered sections into shards of bounded bytes.

Each section's shard depends on all before it, yet only through the bytes of the open shard. So the
sorted sizes are dealt out by range; a partition says, for each place at which an incoming shard could
overflow, how its own packing would end. Such tables compose: neighbours are put together in a tree of
tasks, shards are followed down the tree, and the partitions number their sections. No task sees all
sections, nothing goes through the driver, and only keys and sizes are dealt out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import distinct_strings, iso8601, trim, truncate_bytes
from ..shared import stored
from .order import dealt, numbered
from .render import END, anchor_of, sentiment_section, thread_section

DEFAULT_BYTES = 102_400
MEMORY_HEADER, SENTIMENT_HEADER = "# Memory Shard {}\n\n", "# Sentiment Memory Shard {}\n\n"
MEMORY_FILE, SENTIMENT_FILE = "memories_{}.md", "sentiment_memories_{}.md"


def pack_order() -> list[Column]:
    """By start, unknown ones as 0, then by id."""
    return [F.coalesce(F.col("thread_start_time"), F.lit(0.0)), F.col("conversation_id")]


def _ends(sizes: np.ndarray, most: int, header: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes up to and with each section, and for a shard that begins at each the first section that it leaves out."""
    ends = np.cumsum(sizes)
    begin = ends - sizes
    return ends, np.maximum(np.searchsorted(ends, begin + most - header, side="right"), np.arange(len(sizes)) + 1)


def _exits(sizes: np.ndarray, most: int, header: int) -> dict[str, np.ndarray]:
    """For each first section that an incoming shard may leave out: the bytes upto its end, shards begun, last bytes.

    Sections that end at the same byte can only be left out with the first of them, so there are at most
    as many as an open shard has bytes. Shards are followed from all of them at once.
    """
    ends, to = _ends(sizes, most, header)
    n = len(sizes)
    reach = min(n, int(np.searchsorted(ends, most, side="right")) + 1)
    first = np.flatnonzero(np.append(True, ends[1:reach] != ends[: reach - 1])) if reach else np.zeros(0, dtype=np.int64)
    now, begun = first.copy(), np.ones(len(first), dtype=np.int64)
    on = to[now] < n
    while on.any():
        now[on] = to[now[on]]
        begun[on] += 1
        on = to[now] < n
    last = header + ends[-1] - (ends[now] - sizes[now]) if n else first
    return {"upto": ends[first], "begun": begun, "last": last}


def _assign(sizes: np.ndarray, most: int, header: int, state: int, number: int) -> np.ndarray:
    """Shard number of each section, given the bytes of the open shard and its number."""
    ends, to = _ends(sizes, most, header)
    out = np.empty(len(sizes), dtype=np.int64)
    at = int(np.searchsorted(ends, most - state, side="right")) if state != NONE else 0
    out[:at] = number
    while at < len(sizes):
        number += 1
        out[at : to[at]] = number
        at = int(to[at])
    return out


def _then(a: dict[str, np.ndarray], b: dict[str, np.ndarray], most: int) -> dict[str, np.ndarray]:
    """The table of two neighbours from their own: shards that a begins go on into b, one that overflows in neither takes both totals."""
    total = int(a["total"][0])
    at = np.searchsorted(b["upto"], most - a["last"], side="right")
    out = at < len(b["upto"])
    at = np.minimum(at, len(b["upto"]) - 1)
    through = {"upto": a["upto"], "begun": a["begun"] + np.where(out, b["begun"][at], 0), "last": np.where(out, b["last"][at], a["last"] + b["total"][0])}
    keep = (b["upto"] + total > a["upto"][-1]) & (a["upto"][-1] <= most)
    keep &= np.cumsum(keep & (b["upto"] + total > most)) <= 1  # all behind the first beyond an open shard's bytes are alike
    both = {"upto": b["upto"][keep] + total, "begun": b["begun"][keep], "last": b["last"][keep]}
    joined = {k: np.concatenate([through[k], both[k]]) for k in through}
    return joined | {"total": np.full(len(joined["upto"]), total + int(b["total"][0]))}


def _after(t: dict[str, np.ndarray], most: int, state: int, number: int) -> tuple[int, int]:
    """Bytes of the open shard and its number behind a table's sections; NONE is open before the first."""
    at = int(np.searchsorted(t["upto"], most - state, side="right")) if state != NONE else 0
    if at < len(t["upto"]):
        return int(t["last"][at]), number + int(t["begun"][at])
    return state + int(t["total"][0]), number


_EXITS = "task int, upto bigint, begun bigint, last bigint, total bigint"
_OPEN = "task int, state bigint, number bigint"
NONE = -1
FAN = 16  # tables put together by one task; each has at most as many rows as an open shard has bytes
ROWS = 1 << 20  # rows of a range, on average


def _of_tasks(rows: pa.Table) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    """The tables of tasks, in their order."""
    rows = rows.sort_by([("task", "ascending"), ("upto", "ascending")])
    task = rows.column("task").to_numpy()
    begin = np.flatnonzero(np.append(True, task[1:] != task[:-1])) if len(task) else np.zeros(0, dtype=np.int64)
    for i, j in zip(begin, np.append(begin[1:], len(task)), strict=True):
        yield int(task[i]), {c: rows.column(c).to_numpy()[i:j] for c in ("upto", "begun", "last", "total")}


def _opens(tables: DataFrame, most: int, tasks: int) -> DataFrame:
    """(task, state, number): the shard that is open before each task, by a tree over the tasks' tables."""

    def together(keys: tuple, rows: pa.Table) -> pa.Table:
        done = None
        for _, t in _of_tasks(rows):
            done = t if done is None else _then(done, t, most)
        return pa.table({"task": pa.array(np.full(len(done["upto"]), keys[0].as_py()), pa.int32()), **done})

    def follow(rows: pa.Table, state: int, number: int) -> pa.Table:
        out = []
        for task, t in _of_tasks(rows):
            out.append((task, state, number))
            state, number = _after(t, most, state, number)
        task, states, numbers = zip(*out, strict=True) if out else ((), (), ())
        return pa.table({"task": pa.array(task, pa.int32()), "state": pa.array(states, pa.int64()), "number": pa.array(numbers, pa.int64())})

    def down(keys: tuple, own: pa.Table, opened: pa.Table) -> pa.Table:
        return follow(own, opened.column("state")[0].as_py(), opened.column("number")[0].as_py())

    group = F.floor(F.col("task") / FAN).cast("int")
    levels = [tables]
    while tasks > FAN:
        levels.append(stored(levels[-1].groupBy(group.alias("g")).applyInArrow(together, _EXITS), "shard-exits"))
        tasks = -(-tasks // FAN)
    opened = levels.pop().groupBy(group.alias("g")).applyInArrow(lambda keys, rows: follow(rows, NONE, 0), _OPEN)
    while levels:
        opened = levels.pop().groupBy(group.alias("g")).cogroup(opened.groupBy(F.col("task").alias("g"))).applyInArrow(down, _OPEN)
    return opened


def next_fit(sections: DataFrame, size: str, order: list[str], most: int = DEFAULT_BYTES, header: int = 0, name: str = "shard_no") -> DataFrame:
    """sections with the number (from 1) of the shard that each falls into.

    size: column of bytes, null counts as 0; order: columns that fix the sequence, ties stand as they fall.
    Sections are stored once as they lie; where they have more columns than these, only a row's number is
    dealt out with its size, and the shards are joined to the rows.
    """
    most = most if most > 0 else DEFAULT_BYTES
    more = bool(set(sections.columns) - {size, *order})
    kept = stored(sections.withColumn("__row", F.monotonically_increasing_id()) if more else sections, "sections")
    own = ["__row"] if more else sections.columns
    usual, parts = int(sections.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-kept.count() // ROWS)
    slim = kept.select(F.struct(*own).alias("own"), *(F.col(c).alias(f"k{i}") for i, c in enumerate(order)), F.coalesce(F.col(size).cast("bigint"), F.lit(0)).alias("bytes"))
    ranged = dealt(slim, [F.col(f"k{i}") for i in range(len(order))], parts if parts > usual else None)
    placed = ranged.select("task", "at", "row.bytes", "row.own")

    def table(keys: tuple, rows: pa.Table) -> pa.Table:
        sizes = rows.sort_by("at").column("bytes").to_numpy()
        out = _exits(sizes, most, header)
        n = len(out["upto"])
        return pa.table({"task": np.full(n, keys[0].as_py(), dtype=np.int32), **out, "total": np.full(n, sizes.sum())})

    def assign(keys: tuple, rows: pa.Table, opened: pa.Table) -> pa.Table:
        rows = rows.sort_by("at")
        shard = _assign(rows.column("bytes").to_numpy(), most, header, opened.column("state")[0].as_py(), opened.column("number")[0].as_py())
        return rows.select(["own"]).append_column("shard", pa.array(shard, pa.int64()))

    tables = stored(placed.drop("own").groupBy("task").applyInArrow(table, _EXITS), "shard-exits")
    opened = _opens(tables, most, max(usual, parts))
    shape = T.StructType([placed.schema["own"], T.StructField("shard", T.LongType())])
    shards = placed.groupBy("task").cogroup(opened.groupBy("task")).applyInArrow(assign, shape).select("own.*", F.col("shard").alias(name))
    return kept.join(shards, "__row").drop("__row") if more else shards


def _packed(threads: DataFrame, section: Column, header: str, file: str, most: int) -> DataFrame:
    named = threads.filter(F.coalesce("conversation_id", F.lit("")) != "").withColumn("section", section)
    named = named.withColumn("_start", pack_order()[0]).withColumn("_bytes", F.octet_length("section"))
    packed = next_fit(named, "_bytes", ["_start", "conversation_id"], most, len(header.format("0000")))
    left, right = file.split("{}")
    return packed.withColumn("shard_file", F.concat(F.lit(left), F.format_string("%04d", "shard_no"), F.lit(right)))


def memory_shards(threads: DataFrame, most: int = DEFAULT_BYTES, key_points: bool = True, tags: bool = True) -> DataFrame:
    """Thread summaries with their section, shard number and shard file."""
    return _packed(threads, thread_section(key_points, tags), MEMORY_HEADER, MEMORY_FILE, most)


def sentiment_shards(threads: DataFrame, most: int = DEFAULT_BYTES) -> DataFrame:
    return _packed(threads, sentiment_section(), SENTIMENT_HEADER, SENTIMENT_FILE, most)


def shard_files(packed: DataFrame, header: str = MEMORY_HEADER) -> DataFrame:
    """(shard_file, content): a shard is bounded, so its sections are gathered by its number alone."""
    left, right = header.split("{}")
    body = F.transform(F.array_sort(F.collect_list(F.struct("_start", "conversation_id", "section"))), lambda x: x.section)
    return packed.groupBy("shard_file", "shard_no").agg(F.array_join(body, "").alias("_body")).select("shard_file", F.concat(F.lit(left), F.format_string("%04d", "shard_no"), F.lit(right), F.col("_body")).alias("content"))


def _text(c: str, most: int) -> Column:
    return truncate_bytes(c, most)


def memory_index(packed: DataFrame, summary_bytes: int = 400, tags: bool = True) -> DataFrame:
    """A row for each thread: its shard file, anchor and a short summary (cut once, at the smaller limit)."""
    most = min(400, summary_bytes) if summary_bytes > 0 else 400
    lists = [distinct_strings(c).alias(c) for c in ("tags", "terms")] if tags else []
    return packed.select("conversation_id", "thread_start_time", iso8601("thread_start_time").alias("thread_start_time_iso8601"), "title", "shard_file", anchor_of().alias("anchor"), _text("summary", most).alias("summary"), *lists)


def sentiment_index(packed: DataFrame, summary_bytes: int = 400) -> DataFrame:
    most = min(400, summary_bytes) if summary_bytes > 0 else 400
    lists = [distinct_strings(c).alias(c) for c in ("dominant_emotions", "remembered_emotions", "present_emotions", "emotional_tensions", "themes")]
    return packed.select(
        "conversation_id", "thread_start_time", iso8601("thread_start_time").alias("thread_start_time_iso8601"), "title", "shard_file", anchor_of().alias("anchor"),
        _text("emotional_summary", most).alias("emotional_summary"), *lists, trim("relational_shift").alias("relational_shift"), trim("emotional_arc").alias("emotional_arc"),
    )


def fold_pack(sizes: Iterator[int], most: int, header: int) -> list[int]:
    """Next-fit in one pass over sizes, for tests and small lists."""
    state = number = 0
    out = []
    for s in sizes:
        if not number or state + s > most:
            number, state = number + 1, header
        state += s
        out.append(number)
    return out


def shard_sizes(packed: DataFrame, header: int) -> DataFrame:
    """Sections and bytes of each shard, its header included."""
    return packed.groupBy("shard_no").agg(F.count(F.lit(1)).alias("n_sections"), (F.sum("_bytes") + header).alias("n_bytes"))


def position(rows: DataFrame) -> DataFrame:
    """pos of each row in the pack order, over all rows."""
    return numbered(rows, pack_order(), "pos")


def with_shards(index: DataFrame, shards: DataFrame) -> DataFrame:
    """Index rows beside the text of their own section: joined by their shard file, found there by their anchor."""
    tag = F.concat(F.lit('<a id="'), "anchor", F.lit('"></a>'))
    rest = F.substring("content", F.instr("content", tag), F.length("content"))
    stop = F.instr(rest, F.lit(END + '<a id="'))
    return index.join(shards, "shard_file").withColumn("section", F.when(stop > 0, F.substring(rest, F.lit(1), stop + len(END) - 1)).otherwise(rest)).drop("content")
