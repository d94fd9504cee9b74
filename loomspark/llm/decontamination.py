"""Benchmark decontamination by a distributed positional inverted index, in DataFrame operations only.

Training documents are tokenised into postings (document, term, position). Every benchmark window names
its two rarest terms, counted over all training documents. Only the postings of such terms are stored;
the list of the rarest one, moved back by the term's place in the window, is intersected with the moved
list of the second, and only where both agree on a start is the document's text compared with the window.

A document is known by a digest of its id and text, so rows that share an id, and rows without one, are
judged each by its own text. Tables that go to every task are measured in bytes first and are joined by a
shuffle where they are larger than BROADCAST_BYTES; either way the rows are the same.

Defined results: null and empty texts have no words and appear with zeros. Every row has a row in the
result, also where ids are null or repeat. Repeated items and items with equal texts all count. Items
without words have no window; a null item_id counts for the hits and isn't among the items. Empty tables
give no hits. Of the documents only doc_id and text are read, and ``clean`` passes all columns through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, stored

WINDOW = 13
#: Bytes of a table that may be sent to every task.
BROADCAST_BYTES = 16_000_000

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text: A-Z lower-cased, split at every ASCII character but digits and letters."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(low, _SEPARATORS), "")


def _key(some: Column) -> Column:
    """A digest of some words in order."""
    return F.unhex(F.md5(F.array_join(some, " ").cast("binary")))


def _few(df: DataFrame, row_bytes: Column | int) -> DataFrame:
    """df, sent to every task if its bytes are few enough for that."""
    held = df.agg(F.sum(F.lit(40) + row_bytes)).first()[0] or 0
    return F.broadcast(df) if held <= BROADCAST_BYTES else df


def rows_of(docs: DataFrame, row: Column) -> DataFrame:
    """(row, doc, text) of each row of docs: row is passed on, doc is the digest of its id and text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc = F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("\n"), text).cast("binary")))
    return docs.select(row.alias("row"), doc.alias("doc"), text.alias("text"))


def windows(benchmark: DataFrame, length: int = WINDOW) -> DataFrame:
    """(win, size, words, item_id): the windows of each item; win is a digest of the words."""
    items = benchmark.select(F.col("item_id"), words(F.col("text").cast("string")).alias("w")).filter("size(w) > 0")
    size = F.least(F.size("w"), F.lit(length))
    starts = items.select("item_id", "w", size.alias("size"), F.explode(F.sequence(F.lit(1), F.size("w") - size + 1)).alias("s"))
    return starts.select("item_id", "size", F.slice("w", F.col("s"), F.col("size")).alias("words")).select(_key(F.col("words")).alias("win"), "size", "words", "item_id").dropDuplicates(["win", "item_id"])


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n): occurrences in all training documents of each of the given terms that occurs."""
    tokens = docs.select(F.explode(words(F.col("text"))).alias("term"))
    return tokens.join(_few(terms, F.octet_length("term")), "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def anchors(wins: DataFrame, counts: DataFrame) -> DataFrame:
    """(win, size, term, off, term2, off2): each window's two rarest terms and their places; of a window of one word they are the same.

    Windows with a term that no document has are left out.
    """
    terms = wins.dropDuplicates(["win"]).select("win", "size", F.posexplode("words").alias("off", "term"))
    ranked = terms.join(counts, "term").groupBy("win", "size").agg(F.array_sort(F.collect_list(F.struct("n", "term", "off"))).alias("r")).filter("size(r) = size")
    second = F.col("r")[F.when(F.col("size") > 1, 1).otherwise(0)]
    return ranked.select("win", "size", F.col("r")[0].term.alias("term"), F.col("r")[0].off.alias("off"), second.term.alias("term2"), second.off.alias("off2"))


def postings(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """The index: (doc, term, pos) for each occurrence of one of the terms in rows(doc, text)."""
    tokens = rows.select("doc", F.posexplode(words(F.col("text"))).alias("pos", "term"))
    return tokens.join(_few(terms, F.octet_length("term")), "term").select("doc", "term", "pos")


def index_of(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The stored index of docs(doc_id, text) for a benchmark(item_id, text), its anchored windows, and its windows."""
    rows = rows_of(docs, F.lit(None).cast("int"))
    wins = stored(windows(benchmark), "windows")
    counts = stored(term_counts(rows, wins.select(F.explode("words").alias("term")).distinct()), "term-counts")
    anchored = stored(anchors(wins, counts), "anchors")
    index = postings(rows, anchored.select(F.explode(F.array("term", "term2")).alias("term")).distinct())
    index = stored(index.distinct(), "postings")  # rows that are alike are one document
    discard(counts)
    return index, anchored, wins


def _anchored_bytes() -> Column:
    return F.octet_length("term") + F.octet_length("term2") + 60


def phrase_candidates(index: DataFrame, anchored: DataFrame) -> DataFrame:
    """(doc, start, size, win): where the lists of a window's two rarest terms, each moved by its place, meet."""
    first = index.join(_few(anchored, _anchored_bytes()), "term").select("doc", (F.col("pos") - F.col("off")).alias("start"), "size", "win", "term2", "off2").filter("start >= 0")
    second = index.select("doc", F.col("term").alias("term2"), F.col("pos").alias("pos2"))
    return first.withColumn("pos2", F.col("start") + F.col("off2")).join(second, ["doc", "term2", "pos2"]).select("doc", "start", "size", "win")


def proximity_candidates(index: DataFrame, anchored: DataFrame, slop: int) -> DataFrame:
    """(doc, pos, win): where the second rarest term of a window stands within slop words of the rarest."""
    first = index.join(_few(anchored, _anchored_bytes()), "term").select("doc", "pos", "win", "term2", F.explode(F.array(*(F.floor(F.col("pos") / (slop + 1)) + i for i in (-1, 0, 1)))).alias("part"))
    second = index.select("doc", F.col("term").alias("term2"), F.col("pos").alias("pos2"), F.floor(F.col("pos") / (slop + 1)).alias("part")).distinct()
    return first.join(second, ["doc", "term2", "part"]).filter(F.abs(F.col("pos") - F.col("pos2")) <= slop).select("doc", "pos", "win").distinct()


def phrase_matches(rows: DataFrame, index: DataFrame, anchored: DataFrame) -> DataFrame:
    """(row, n_words, doc, hits) of each of rows(row, doc, text); hits are (start, size, win) of the windows that occur."""
    at = phrase_candidates(index, anchored).groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("start", "size", "win"))).alias("at"))
    at = stored(at, "candidates")
    split = rows.join(_few(at, F.size("at") * 48 + 16), "doc", "left").select("row", "doc", words(F.col("text")).alias("w"), "at")
    same = lambda c: (c.start + c.size <= F.size("w")) & (_key(F.slice("w", c.start + 1, c.size)) == c.win)
    return split.select("row", "doc", F.size("w").alias("n_words"), F.coalesce(F.filter("at", same), F.array().cast(at.schema["at"].dataType)).alias("hits"))


def proximity_matches(docs: DataFrame, benchmark: DataFrame, slop: int = WINDOW - 1) -> DataFrame:
    """(doc_id, pos, items): places of docs where all terms of a window stand within slop words of its rarest."""
    index, anchored, wins = index_of(docs, benchmark)
    rows = rows_of(docs, F.col("doc_id"))
    found = proximity_candidates(index, anchored, slop).join(wins.dropDuplicates(["win"]).select("win", "words"), "win")
    split = rows.join(found, "doc").select(F.col("row").alias("doc_id"), "pos", "win", "words", words(F.col("text")).alias("w"))
    lo = F.greatest(F.col("pos") - slop, F.lit(0))
    near = split.filter(F.size(F.array_except("words", F.slice("w", lo + 1, F.col("pos") - lo + slop + 1))) == 0).select("doc_id", "pos", "win")
    return near.join(wins.select("win", "item_id"), "win").groupBy("doc_id", "pos").agg(F.array_sort(F.collect_set("item_id")).alias("items"))


def _covered(hits: Column) -> Column:
    """Words in any of the hits, which are in order of their starts."""
    step = lambda acc, h: F.struct(F.greatest(acc.stop, h.start + h.size).alias("stop"), (acc.n + F.greatest(F.lit(0), h.start + h.size - F.greatest(acc.stop, h.start))).alias("n"))
    return F.aggregate(hits, F.struct(F.lit(0).alias("stop"), F.lit(0).alias("n")), step).n


def _verdict(found: DataFrame) -> DataFrame:
    """n_hit and contaminated beside phrase_matches."""
    return found.withColumn("n_hit", _covered(F.col("hits"))).withColumn("contaminated", F.expr("n_hit > 0 AND 20L * n_hit >= n_words"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """n_words, hit words, items and the verdict of every document."""
    index, anchored, wins = index_of(docs, benchmark)
    matched = _verdict(phrase_matches(rows_of(docs, F.col("doc_id")), index, anchored)).withColumn("wins", F.array_distinct(F.transform("hits", lambda h: h.win)))
    found = stored(matched.select(F.col("row").alias("doc_id"), "doc", "n_words", "n_hit", "contaminated", "wins"), "matched")
    discard(index, anchored)
    hits = found.filter("n_hit > 0").select("doc", F.explode("wins").alias("win")).distinct()
    named = wins.select("win", F.col("item_id").cast("string").alias("item"))
    items = hits.join(_few(named, F.coalesce(F.octet_length("item"), F.lit(0)) + 16), "win").groupBy("doc").agg(F.array_sort(F.collect_set("item")).alias("item_ids"))
    items = stored(items, "items")
    discard(wins)
    all_ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    joined = found.join(_few(items, F.aggregate("item_ids", F.lit(16), lambda n, x: n + F.octet_length(x) + 16)), "doc", "left").withColumn("item_ids", all_ids)
    return joined.select(
        "doc_id", F.col("n_words").cast("bigint").alias("n_words"), F.col("n_hit").cast("bigint").alias("n_hit"), "item_ids",
        F.size("item_ids").cast("bigint").alias("n_items"), F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of docs that aren't contaminated."""
    index, anchored, wins = index_of(docs, benchmark)
    found = _verdict(phrase_matches(rows_of(docs, F.struct("*")), index, anchored))
    discard(index, anchored, wins)  # the places to compare are stored by now
    return found.filter("NOT contaminated").select("row.*")
