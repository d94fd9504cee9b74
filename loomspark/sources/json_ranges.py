"""Elements of one large JSON document, cut by many tasks.

The document is read as the pieces between its closing braces, so a file of any size splits into byte
ranges at braces. Whether a range begins inside a string, and how deep, isn't known where it is read. A first
pass lexes every range for both cases at once: whether its quotes turn inside into outside is the same for
either, as an escape stands in strings only; how much depth it adds is not. These tables, a row for each
range, compose in the order of the ranges, which gives each its true entry. The second pass cuts: whole
elements are rows at once, and what an edge cuts is put together by its number, a few pieces a range.

Elements are the objects and arrays of the array; other values in it aren't conversations and are left out.
What stands behind the document's end is never looked at.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..shared import stored

#: Rows of range tables up to which they are sent to all tasks; beyond, ranges are shuffled to theirs.
SENT_RANGES = 100_000
#: Bytes before a container that its name is looked for in.
NAME_BYTES = 1 << 16

_ESCAPE = re.compile(rb"\\.", re.S)
_BLANK = b" \t\r\n"
TABLE = "file string, block bigint, first string, flips int, plain bigint, quoted bigint"
CUT = "file string, block bigint, kind string, top int, container int, element int, name string, begins boolean, ends boolean, text binary"


def _lexed(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes without escapes, where an odd number of quotes has been seen, and each byte's step in depth."""
    plain = np.frombuffer(_ESCAPE.sub(b"__", data), np.uint8)
    odd = (np.cumsum(plain == 34) & 1).astype(bool)
    step = ((plain == 123) | (plain == 91)).astype(np.int8) - ((plain == 125) | (plain == 93)).astype(np.int8)
    return plain, odd, step


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bool, bytes]]:
    """(file, block and entry), whether it begins here, and its next bytes."""
    last = None
    for batch in batches:
        keys = list(zip(*(batch.column(k).to_pylist() for k in range(batch.num_columns) if k != 2), strict=True))
        values, begin = batch.column(2).to_pylist(), 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i][:2] != keys[begin][:2]:
                yield keys[begin], keys[begin][:2] != last, b"}".join([*values[begin:i], b""])
                last, begin = keys[begin][:2], i


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each range's first sign, whether its quotes flip, and the depth that it adds from outside and from inside a string."""
    rows: list[list] = []
    for key, new, data in _ranges(batches):
        if new:
            rows.append([*key[:2], "", 0, 0, 0])
        row = rows[-1]
        row[2] = row[2] or data.lstrip(b"\xef\xbb\xbf" + _BLANK)[:1].decode("latin-1")
        _, odd, step = _lexed(data)
        inside = odd ^ bool(row[3])
        row[4] += int(step[~inside].sum())
        row[5] += int(step[inside].sum())
        row[3] ^= int(odd[-1]) if len(odd) else 0
    columns = zip(*rows, strict=True) if rows else [[]] * 6
    types = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["file", "block", "first", "flips", "plain", "quoted"])


def _name(before: bytes) -> str | None:
    """The name of the field whose value follows, or null if there is none."""
    held = before.rstrip(_BLANK)
    if not held.endswith(b":"):
        return None
    held = held[:-1].rstrip(_BLANK)
    begin = _ESCAPE.sub(b"__", held)[:-1].rfind(b'"')
    try:
        return json.loads(held[begin:]) if begin >= 0 else None
    except ValueError:
        return None


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements and containers of ranges, numbered within them; the element and container that a range begins in have number 0."""
    rows: list[tuple] = []
    size = 0

    def out() -> pa.RecordBatch:
        nonlocal size
        types = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.bool_(), pa.binary()]
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 10, types, strict=True)], names=[f.split()[0] for f in CUT.split(", ")])
        rows.clear()
        size = 0
        return batch

    key, held, open_, begins = None, [], False, False

    def end_of_range() -> None:
        if key is not None:
            if open_ and (begins or held):
                rows.append((*key[:2], "element", top, container, element, None, begins, False, b"".join(held)))
            rows.append((*key[:2], "range", top, container, element, None, None, None, None))

    for now, new, data in _ranges(batches):
        if new:
            end_of_range()
            key, quoted, depth, level = now, *now[2:]
            held, top, container, element, open_, begins, tail = [], 0, 0, 0, depth > level, False, b""
        plain, odd, step = _lexed(data)
        step = np.where(odd ^ bool(quoted), 0, step)
        after = depth + np.cumsum(step)
        before = after - step
        openers = np.flatnonzero((step > 0) & (before <= level))
        closers = np.flatnonzero((step < 0) & (after == level))
        events = sorted([(int(i), True) for i in openers] + [(int(i), False) for i in closers])
        start = 0
        for at, opens in events:
            if not opens:
                if open_:
                    held.append(data[start : at + 1])
                    rows.append((*key[:2], "element", top, container, element, None, begins, True, b"".join(held)))
                    size += len(rows[-1][-1])
                    held, open_ = [], False
            elif before[at] == level:
                element, start, held, open_, begins = element + 1, at, [], True, True
            elif before[at] == 0:
                top += 1
            if opens and before[at] == level - 1:
                container += 1
                name = _name((tail + data[:at])[-NAME_BYTES:]) if level > 1 else None
                rows.append((*key[:2], "container", top, container, element, name, plain[at] == 91, None, None))
        if open_:
            held.append(data[start:])
        tail = (tail + data)[-NAME_BYTES:]
        quoted ^= bool(odd[-1]) if len(odd) else False
        depth = int(after[-1]) if len(after) else depth
        if size > 1 << 23:
            yield out()
    end_of_range()
    yield out()


@contextmanager
def _ranges_of(spark: SparkSession, size: int | None):
    """Files cut into ranges of so many bytes, while a scan is planned and run."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    try:
        if size:
            for n in names:
                spark.conf.set(n, str(size))
        yield
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def elements(spark: SparkSession, path: str, field: str | None = None, range_bytes: int | None = None) -> DataFrame:
    """(file, place, value): the elements of each file's array as JSON text, with their number in it.

    The array is the document itself, or of an object the field that is named, else the first that is an
    array; an object without one is an error. range_bytes: of a range, else what the session's files are cut to.
    """
    with _ranges_of(spark, range_bytes):
        pieces = spark.read.option("lineSep", "}").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("piece"))
        tables = stored(pieces.mapInArrow(_tables, TABLE), "json-ranges")
        earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
        entered = tables.withColumn("inside", F.coalesce(F.sum("flips").over(earlier), F.lit(0)) % 2 == 1).withColumn("adds", F.when(F.col("inside"), F.col("quoted")).otherwise(F.col("plain")))
        entered = entered.withColumn("depth", F.coalesce(F.sum("adds").over(earlier), F.lit(0).cast("bigint")))
        sign = F.first(F.nullif("first", F.lit("")), ignorenulls=True).over(W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
        entry = stored(entered.select("file", "block", "inside", "depth", F.when(sign == "[", 1).otherwise(2).alias("level")), "json-entries")
        if entry.count() <= SENT_RANGES:
            known = pieces.join(F.broadcast(entry), ["file", "block"])
        else:
            placed = pieces.withColumn("at", F.monotonically_increasing_id())
            known = placed.join(entry, ["file", "block"]).repartition("file", "block").sortWithinPartitions("file", "block", "at")
        cut = stored(known.select("file", "block", "piece", "inside", "depth", "level").mapInArrow(_cut, CUT), "json-elements")
    ranges = cut.filter("kind = 'range'")
    sums = [F.coalesce(F.sum(c).over(earlier), F.lit(0).cast("bigint")).alias(f"{c}s") for c in ("top", "container", "element")]
    before = stored(ranges.select("file", "block", *sums).join(entry.select("file", "block", "level"), ["file", "block"]), "json-places")
    numbered = cut.filter("kind != 'range'").join(before, ["file", "block"])
    numbered = numbered.withColumns({c: F.col(f"{c}s") + F.col(c) for c in ("top", "container", "element")}).filter("top = 1")
    arrays = numbered.filter("kind = 'container' AND begins")
    if field:
        arrays = arrays.filter((F.col("level") == 1) | (F.col("name") == field))
    chosen = arrays.groupBy("file").agg(F.min("container").alias("container"))
    lacking = before.select("file").distinct().join(chosen, "file", "left_anti").first()
    if lacking is not None:
        raise ValueError(f"{lacking.file} has no array of conversations")
    own = numbered.filter("kind = 'element'").join(chosen, ["file", "container"])
    parts = own.filter("NOT (begins AND ends)").groupBy("file", "element").agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("parts"))
    whole = parts.select("file", "element", F.aggregate("parts.text", F.lit(b""), lambda a, b: F.concat(a, b)).alias("text"))
    both = own.filter("begins AND ends").select("file", "element", "text").unionByName(whole)
    return both.select("file", F.col("element").alias("place"), F.col("text").cast("string").alias("value"))
