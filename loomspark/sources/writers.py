"""Sinks: JSON rows, index lines, documents by name (a file each, or bundled), the glossary. All go through Spark's commit protocol."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shared import mark, release
from .readers import GLOSSARY_END, GLOSSARY_HEAD, exists

#: Bytes of a glossary that one file holds, about; and those of an entry beside its term and definition, about.
PART_BYTES, ENTRY_BYTES = 16 << 20, 96


def mode(overwrite: bool) -> str:
    return "overwrite" if overwrite else "errorifexists"


def without_empty(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Empty strings and arrays as null, so that JSON leaves their fields out; those named stay."""
    def of(f: T.StructField):
        c = F.col(f.name)
        if f.name in keep:
            return c
        if isinstance(f.dataType, T.StringType):
            return F.nullif(c, F.lit("")).alias(f.name)
        if isinstance(f.dataType, T.ArrayType):
            return F.when(F.size(c) > 0, c).alias(f.name)
        return c

    return df.select(*(of(f) for f in df.schema))


def json_rows(df: DataFrame, path: str, overwrite: bool = False, ignore_nulls: bool = True) -> None:
    df.write.mode(mode(overwrite)).option("ignoreNullFields", ignore_nulls).json(path)


def index_lines(df: DataFrame, path: str, order: str, overwrite: bool = True, ignore_nulls: bool = True) -> None:
    """JSON lines in the order of a path column, range-sorted, so no task writes them all."""
    df.repartitionByRange(F.col(order)).sortWithinPartitions(order).write.mode(mode(overwrite)).option("ignoreNullFields", ignore_nulls).json(path)


def documents(df: DataFrame, path: str, name: str, content: str, overwrite: bool = False) -> None:
    """One text file for each row, called by its name; a slash in it begins a folder below the path.

    Rows are written by the executors under the commit protocol, into a folder beside; the driver then
    only renames. Without overwrite a file that is there already is an error, and nothing is moved. A file
    that is replaced is put aside first; if a move fails, all that were made are taken back.
    """
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    df.select(F.col(content).cast("string").alias("value"), F.col(name).alias("name")).repartition("name").write.option("lineSep", "\n").option("maxRecordsPerFile", 1).partitionBy("name").text(staging)
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path
    store = at(path).getFileSystem(conf)
    try:
        moves = []
        for found in store.globStatus(at(staging + "/name=*/part-*")) or ():
            own = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(found.getPath().getParent().getName().removeprefix("name="))
            moves.append((found.getPath(), at(f"{path.rstrip('/')}/{own}")))
        targets = [str(to) for _, to in moves]
        if len(set(targets)) < len(targets):
            raise ValueError("two rows have one file name")
        if not overwrite and (there := [t for _, t in moves if store.exists(t)]):
            raise FileExistsError(str(there[0]))
        store.mkdirs(at(path))
        for folder in {str(to.getParent()) for _, to in moves}:
            store.mkdirs(at(folder))
        store.mkdirs(at(f"{staging}/before"))
        made: list[tuple] = []
        try:
            with ThreadPoolExecutor(16) as pool:
                list(pool.map(lambda i: _move(store, *moves[i], at(f"{staging}/before/{i}"), made), range(len(moves))))
        except Exception:
            for target, aside in made:
                store.delete(target, False)
                if store.exists(aside):
                    store.rename(aside, target)
            raise
    finally:
        store.delete(at(staging), True)


def bundle(df: DataFrame, path: str, name: str, content: str, overwrite: bool = False) -> None:
    """Documents by name as rows of a table: as many as there are, in as many files as there are tasks.

    For documents too many for a file, a folder and a rename each. They appear all at once: written beside,
    then checked for names that occur twice, then moved as one folder. Only their names are shuffled.
    """
    own = path.rstrip("/")
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    target, staging, aside = (jvm.org.apache.hadoop.fs.Path(x) for x in (own, f"{own}.staging-{uuid.uuid4().hex}", f"{own}.before-{uuid.uuid4().hex}"))
    store = target.getFileSystem(conf)
    if not overwrite and store.exists(target):
        raise FileExistsError(own)
    try:
        df.select(F.col(name).cast("string").alias("name"), F.col(content).cast("string").alias("content")).write.option("compression", "zstd").parquet(str(staging))
        written = df.sparkSession.read.schema("name string, content string").parquet(str(staging))
        if not written.groupBy("name").count().filter("count > 1").isEmpty():
            raise ValueError("two rows have one file name")
        replaced = store.exists(target) and store.rename(target, aside)
        if not store.rename(staging, target):
            if replaced:
                store.rename(aside, target)
            raise OSError(f"{staging} could not be moved to {own}")
        store.delete(aside, True)
    finally:
        store.delete(staging, True)


def _move(store, source, target, aside, made: list[tuple]) -> None:
    if store.exists(target) and not store.rename(target, aside):
        raise OSError(f"{target} could not be put aside")
    made.append((target, aside))
    if not store.rename(source, target):
        raise OSError(f"{source} could not be moved to {target}")


def pretty_json(df: DataFrame, columns: list[str], pretty: bool = False):
    """Column of a row as JSON text."""
    return F.to_json(F.struct(*columns), {"pretty": "true"} if pretty else {})


def glossary(entries: DataFrame, path: str) -> None:
    """The glossary as one JSON document with its version, an entry a line, in order.

    A document of more than PART_BYTES is cut at ends of lines into several files, which give it when they
    are joined in the order of their names; no task sorts or writes it all.
    """
    from ..operators.order import numbered

    spark, point = entries.sparkSession, mark()
    own = F.to_json(F.struct("term", "definition", "count", "first_seen_at", "last_seen_at"))
    ranked = numbered(entries, [-F.col("count"), F.lower("term"), F.col("term")], "pos", "bigint")
    about = F.coalesce(F.octet_length("term"), F.lit(0)) + F.coalesce(F.octet_length("definition"), F.lit(0)) + ENTRY_BYTES
    n, size = ranked.agg(F.count("*"), F.coalesce(F.sum(about.cast("bigint")), F.lit(0))).first()
    parts = max(1, -(-size // PART_BYTES))
    part = F.floor((F.col("pos") - 1) * parts / max(n, 1)).cast("int")
    lines = ranked.select("pos", F.least(part, F.lit(parts - 1)).alias("part"), F.concat(F.when(F.col("pos") > 1, F.lit(",")).otherwise(F.lit("")), own).alias("value"))
    ends = spark.createDataFrame([(0, 0, GLOSSARY_HEAD), (n + 1, parts - 1, GLOSSARY_END)], "pos bigint, part int, value string")
    lines.unionByName(ends).repartitionById(parts, F.col("part")).sortWithinPartitions("pos").select("value").write.mode("overwrite").option("lineSep", "\n").text(path)
    release(spark, point)


def copy_if_exists(spark: SparkSession, source: str, target: str, overwrite: bool = False) -> bool:
    """Copy a file or folder; nothing happens if it is missing, or the target is there and not to be overwritten."""
    if not exists(spark, source) or exists(spark, target) and not overwrite:
        return False
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    to = b.getFileSystem(conf)
    if overwrite:
        to.delete(b, True)
    return jvm.org.apache.hadoop.fs.FileUtil.copy(a.getFileSystem(conf), a, to, b, False, conf)
