"""Tables between stages: written to the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Only where none is set and all tasks run in the driver's process, as in tests, a local one is made."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="loomspark-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written and read back: its lineage ends there, and lost executors don't bring it back."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mark() -> int:
    """A point in time, for release."""
    return len(_written)


def release(spark: SparkSession, since: int = 0) -> None:
    """Remove all that was stored since a point in time; results that still read it are void then."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in _written[since:]:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
    del _written[since:]


def spread(df: DataFrame) -> DataFrame:
    """df over all cores, where its files are too few for them; tables of many files are read as they lie."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df._jdf.queryExecution().toRdd().getNumPartitions() >= cores else df.repartition(cores)
