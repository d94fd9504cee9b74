"""Helpers that the training-data operators share."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Space and U+0009 to U+000D: what separates words in the byte-level rules.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; where its files are too few for the cores, its rows are dealt out over them."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df if name == "benchmark" or len(df.inputFiles()) >= cores else df.repartition(cores)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only where the session names none and all tasks run in the driver's own process, as in tests, a local
    one is set; on a cluster it would be another folder on each machine.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="loomspark-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


#: Folders that fresh_path has named and nobody has released yet.
_named: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _named.append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: cuts lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Remove what stored() wrote for these frames, once nothing reads them any more."""
    for df in frames:
        path = getattr(df, "_stored_at", None)
        if path in _named:
            _named.remove(path)
            drop_path(df.sparkSession, path)


def mark() -> int:
    """A point in time, for stored_since."""
    return len(_named)


def stored_since(point: int) -> list[str]:
    """Folders named since a point and not removed yet."""
    return _named[point:]


def release(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Remove folders that fresh_path has named, all of them if none are given. Frames that read them are void then."""
    for path in list(_named) if paths is None else paths:
        if path in _named:
            _named.remove(path)
            drop_path(spark, path)


def _path(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder, on whatever store it lies."""
    where, store = _path(spark, path)
    store.delete(where, True)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was written there to its end."""
    where, store = _path(spark, path + "/_SUCCESS")
    return store.exists(where)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each value; null is empty."""
    if not pa.types.is_binary(column.type):
        column = column.cast(pa.binary())
    return [x or b"" for x in column.to_pylist()]


#: Bytes of rows that Spark hands to a Python worker at a time, where bounded_batches was called.
BATCH_BYTES = 4_000_000
_BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Rows go to Python workers in batches of BATCH_BYTES, unless the session sets a bound itself.

    By Spark's own, 10,000 rows or 64 MB, a task holds tens of MB of documents several times over: as columns
    that double while they grow, in the worker, and as what comes back. The executor keeps much of that.
    """
    if spark.conf.get(_BATCHES, None) is None:
        spark.conf.set(_BATCHES, str(BATCH_BYTES))


#: What empties the caches that a Python worker keeps from task to task, by the operator that they belong to.
caches: dict[str, Callable[[], None]] = {}


def lean(run: Callable[[Iterator], Iterator], owner: str = "") -> Callable[[Iterator], Iterator]:
    """run, for a Python worker that serves many operators in turn.

    Other operators' caches are emptied before, and freed memory goes back to the system behind.
    """

    def task(batches: Iterator) -> Iterator:
        for name, empty in caches.items():
            if name != owner:
                empty()
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):
                ctypes.CDLL(None).malloc_trim(0)

    return task
