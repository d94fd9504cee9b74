"""The glossary as a keyed aggregate over term additions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.text import blank, key, trim
from .order import numbered

#: Bytes of texts whose words one task takes out and sorts.
TASK_BYTES = 16 << 20
ENTRY = ["term", "definition", "count", "first_seen_at", "last_seen_at"]


def merge(additions: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """Glossary after all additions(seq, seen_at, pos, term, definition), merged in the order of seq.

    In each merge a key counts once and its first addition wins. The term keeps its first spelling, the
    definition is the longest in bytes (the earliest of equally long ones), first_seen_at the first time
    that is known, last_seen_at that of the last merge, even if unknown. prior enters as an earlier merge
    with its counts; of its entries with one key the last is the one that is updated.

    Rows that lie dealt out by seq, as those of dealt_by_seq, aren't shuffled themselves: a task drops what
    repeats within a merge and combines what is left by key, and only that moves on.
    """
    each = additions.filter(~blank("term")).select(
        F.col("seq").cast("bigint").alias("seq"), F.col("pos").cast("bigint").alias("pos"), key("term").alias("k"), trim("term").alias("term"),
        F.coalesce(trim("definition"), F.lit("")).alias("definition"), F.lit(1).cast("bigint").alias("n"), F.col("seen_at").cast("double").alias("first_at"), F.col("seen_at").cast("double").alias("last_at"),
    )
    once = each.withColumn("_r", F.row_number().over(W.partitionBy("k", "seq").orderBy("pos"))).filter("_r = 1").drop("_r", "pos")
    by = ["k"]
    if prior is not None:
        old = prior.withColumn("_at", F.monotonically_increasing_id()).select(
            F.lit(None).cast("bigint").alias("seq"), key("term").alias("k"), trim("term").alias("term"), F.coalesce("definition", F.lit("")).alias("definition"),
            F.col("count").cast("bigint").alias("n"), F.col("first_seen_at").alias("first_at"), F.col("last_seen_at").alias("last_at"), "_at",
        )
        ranked = old.withColumn("_r", F.row_number().over(W.partitionBy("k").orderBy(F.desc("_at"))))
        # entries before the last of their key are groups of their own, and come out as they are
        by = ["k", "_own"]
        once = once.withColumn("_own", F.lit(None).cast("bigint")).unionByName(ranked.withColumn("_own", F.when(F.col("_r") > 1, F.col("_at"))).drop("_r", "_at"))
    at = F.coalesce("seq", F.lit(-(1 << 62)))
    merged = once.groupBy(*by).agg(
        F.min_by("term", at).alias("term"),
        F.coalesce(F.max_by(F.when(F.col("definition") != "", F.col("definition")), F.when(F.col("definition") != "", F.struct(F.octet_length("definition"), -at))), F.lit("")).alias("definition"),
        F.sum("n").cast("int").alias("count"), F.min_by("first_at", F.when(F.col("first_at").isNotNull(), at)).alias("first_seen_at"), F.max_by("last_at", at).alias("last_seen_at"),
    )
    return merged.select(*ENTRY)


def dealt_by_seq(rows: DataFrame, seq: str, size: Column | None = None) -> DataFrame:
    """Rows before their additions are taken out: whole merges lie in one task then (see merge).

    size: bytes of a row's additions, so that each task's additions can be sorted in memory.
    """
    if size is None:
        return rows.repartition(seq)
    total = rows.agg(F.sum(size.cast("bigint"))).first()[0] or 0
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES)), seq)


def combine(states: list[DataFrame]) -> DataFrame:
    """The glossary after several, each made by merge from later additions than the one before.

    The same rows as one merge of all additions: every rule of merge holds for parts as well. A key that the
    first one has more than once stays so; its last entry is the one that goes on.
    """
    if len(states) == 1:
        return states[0]
    rows = [s.select(*ENTRY, F.monotonically_increasing_id().alias("_at")).withColumn("_of", F.lit(i)) for i, s in enumerate(states)]
    ranked = rows[0].withColumn("_r", F.row_number().over(W.partitionBy(key("term")).orderBy(F.desc("_at")))).drop("_at")
    first, later = ranked.filter("_r = 1").drop("_r"), [r.drop("_at") for r in rows[1:]]
    every = first
    for r in later:
        every = every.unionByName(r)
    given = F.coalesce("definition", F.lit("")) != ""
    merged = every.groupBy(key("term").alias("k")).agg(
        F.min_by("term", "_of").alias("term"), F.coalesce(F.max_by(F.when(given, F.col("definition")), F.when(given, F.struct(F.octet_length("definition"), -F.col("_of")))), F.lit("")).alias("definition"),
        F.sum("count").cast("int").alias("count"), F.min_by("first_seen_at", F.when(F.col("first_seen_at").isNotNull(), F.col("_of"))).alias("first_seen_at"), F.max_by("last_seen_at", "_of").alias("last_seen_at"),
    )
    return merged.select(*ENTRY).unionByName(ranked.filter("_r > 1").select(*ENTRY))


def additions_of(summaries: DataFrame, seq: str = "seq", seen_at: str = "thread_start_time") -> DataFrame:
    """A summary's glossary additions, then each of its terms without a definition."""
    given = F.coalesce(F.col("glossary_additions"), F.array().cast("array<struct<term:string,definition:string>>"))
    terms = F.transform(F.coalesce(F.col("terms"), F.array().cast("array<string>")), lambda t: F.struct(t.alias("term"), F.lit("").alias("definition")))
    slim = dealt_by_seq(summaries.select(F.col(seq).alias("seq"), F.col(seen_at).alias("seen_at"), F.concat(given, terms).alias("all")), "seq")
    return slim.select("seq", "seen_at", F.posexplode("all").alias("pos", "a")).select("seq", "seen_at", "pos", "a.term", "a.definition")


def cull(glossary: DataFrame, least: int) -> DataFrame:
    """Entries counted at least so often; all if least is 1 or less."""
    return glossary if least <= 1 else glossary.filter(F.col("count") >= least)


def placed(glossary: DataFrame, name: str = "pos") -> DataFrame:
    """The whole glossary with each entry's place in its order."""
    return numbered(glossary, [-F.col("count"), F.lower("term"), F.col("term")], name)


def ordered(glossary: DataFrame) -> DataFrame:
    return glossary.orderBy(F.desc("count"), F.lower("term"), "term")


def excerpt(glossary: DataFrame, k: int) -> DataFrame:
    """One row, one text: the first k entries, of these those with a term and a definition."""
    if k <= 0:
        return glossary.sparkSession.createDataFrame([("",)], "excerpt string")
    top = ordered(glossary).limit(k).filter(~blank("term") & ~blank("definition"))
    line = F.concat(F.lit("- "), trim("term"), F.lit(": "), trim("definition"), F.lit("\n"))
    rank = F.struct((-F.col("count")).alias("c"), F.lower("term").alias("l"), F.col("term").alias("t"), line.alias("s"))
    return top.agg(F.coalesce(F.array_join(F.transform(F.array_sort(F.collect_list(rank)), lambda x: x.s), ""), F.lit("")).alias("excerpt"))
