"""A corpus from raw documents to packed sequences: five stages, each one operator of loomspark.llm.

Defined results of all stages: an empty table gives an empty result. Columns other than those of documents
are left out, whatever they are called. Rows are told apart by their own id and text, so repeated and null
ids lose nothing by sharing one: quality and benchmark overlap judge every row by its own text; of
near-duplicates the row with the least id stays, rows with a null id all stay; passages go from rows whose
id is larger than that of another row that has them, and a null id neither gives nor takes. A null text is
empty: it fails the first rule of quality. Ties go to the least id; of rows alike in id and text one stays.
Texts are worked on whole, however long they are.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.llm import decontamination, order_minhash, packing, quality_ledger, suffix_index
from loomspark.llm.common import bounded_batches, fresh_path, mark, release, stored_since, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: What the stage before has stored on the way to its result.
_left: list[str] = []


def stage(run: Stage) -> Stage:
    """A stage that first removes what the one before has stored: its result is written by then, as run() does.

    Stages share executors, whose memory keeps what the largest took, so all read bounded batches.
    """

    @wraps(run)
    def begin(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, _left)
        bounded_batches(spark)
        point = mark()
        out = run(spark, docs, sf_dir)
        _left[:] = stored_since(point)
        return out

    return begin


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps. Rows are judged one by one; null and short texts go."""
    return quality_ledger.keep(docs).select(*COLUMNS)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that with the least id; texts without words and null ids stay."""
    return order_minhash.keep(docs).select(*COLUMNS)


@stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document with a smaller id holds; texts that are nothing else go, empty ones stay."""
    return suffix_index.remove(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


@stage
def benchmark_overlap(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark doesn't contaminate, each row by its own text; without a benchmark all stay."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two lengths of every row; an empty text is its end token."""
    return packing.pieces(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_overlap", benchmark_overlap),
    ("pack", pack),
]

#: Near-duplicate classes and suffix arrays are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again by the next.

    Once a stage is written, its input and what it stored on the way are removed.
    """
    docs, before = table(spark, sf_dir, "documents"), []
    for name, one in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        one(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        release(spark, [*before, *_left])
        before = [path]
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {}
