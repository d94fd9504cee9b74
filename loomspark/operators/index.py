"""Index rows: summaries joined to their chunks, cut and deduplicated for retrieval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import distinct_strings, first_n, trim, truncate_bytes

SUMMARY_BYTES, TAGS_MAX, TERMS_MAX = 600, 5, 15
CHUNK_KEYS = ["conversation_id", "thread_start_time", "chunk_number", "turn_start", "turn_end"]
EMOTIONS = ["dominant_emotions", "remembered_emotions", "present_emotions", "emotional_tensions"]


def _short(c: str, n: int) -> Column:
    return first_n(distinct_strings(c), n).alias(c)


def chunk_index(chunks: DataFrame, summaries: DataFrame, summary_bytes: int = SUMMARY_BYTES, tags: int = TAGS_MAX, terms: int = TERMS_MAX) -> DataFrame:
    """Inner join on rel_path; keys are the chunk's, summaries without a chunk are left out."""
    own = summaries.select("rel_path", "summary_path", "summary", "tags", "terms")
    return chunks.select("rel_path", "chunk_path", *CHUNK_KEYS).join(own, "rel_path").select(*CHUNK_KEYS, "chunk_path", "summary_path", truncate_bytes("summary", summary_bytes).alias("summary"), _short("tags", tags), _short("terms", terms))


def chunk_sentiment_index(chunks: DataFrame, sentiments: DataFrame, summary_bytes: int = SUMMARY_BYTES, tags: int = TAGS_MAX) -> DataFrame:
    """As chunk_index; lists aren't deduplicated, and only dominant_emotions and themes are cut."""
    cut = {"dominant_emotions", "themes"}
    lists = [first_n(c, tags).alias(c) if c in cut else F.col(c) for c in [*EMOTIONS, "themes", "symbols_or_metaphors", "tone_markers"]]
    texts = [trim(c).alias(c) for c in ("emotional_arc", "relational_shift", "resonance_notes")]
    own = sentiments.drop(*CHUNK_KEYS)
    return chunks.select("rel_path", "chunk_path", *CHUNK_KEYS).join(own, "rel_path").select(*CHUNK_KEYS, "chunk_path", "sentiment_summary_path", truncate_bytes("emotional_summary", summary_bytes).alias("emotional_summary"), *lists, *texts)


def thread_index(threads: DataFrame, summary_bytes: int = SUMMARY_BYTES, tags: int = TAGS_MAX, terms: int = TERMS_MAX) -> DataFrame:
    named = threads.filter(F.coalesce("conversation_id", F.lit("")) != "")
    return named.select("conversation_id", "thread_start_time", "title", "thread_summary_path", truncate_bytes("summary", summary_bytes).alias("summary"), _short("tags", tags), _short("terms", terms))


def thread_sentiment_index(threads: DataFrame, summary_bytes: int = SUMMARY_BYTES, tags: int = TAGS_MAX, terms: int = TERMS_MAX) -> DataFrame:
    named = threads.filter(F.coalesce("conversation_id", F.lit("")) != "")
    return named.select(
        "conversation_id", "thread_start_time", "title", "thread_sentiment_summary_path", truncate_bytes("emotional_summary", summary_bytes).alias("emotional_summary"),
        *(_short(c, terms) for c in EMOTIONS), _short("themes", tags), trim("relational_shift").alias("relational_shift"), trim("emotional_arc").alias("emotional_arc"),
    )


def sorted_rows(index: DataFrame, path: str) -> DataFrame:
    """Index rows in the order of their paths, bytewise."""
    return index.orderBy(path)
