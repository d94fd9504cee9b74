"""Markdown sections of threads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import anchor, blank, distinct_strings, escape_newlines, fixed3, iso8601, markdown_inline, trim

END = "\n---\n\n"
#: Lists of a sentiment section in their order.
SENTIMENT_LISTS = ("dominant_emotions", "remembered_emotions", "present_emotions", "emotional_tensions", "themes")


def anchor_of(conversation_id: Column | str = "conversation_id") -> Column:
    return F.concat(F.lit("thread-"), anchor(conversation_id))


def _head() -> Column:
    conv, start, iso = F.col("conversation_id"), F.col("thread_start_time"), iso8601("thread_start_time")
    title = F.when(blank("title"), conv).otherwise(trim("title"))
    when = F.when(iso != "", F.concat(F.lit(" (`"), iso, F.lit("`)"))).otherwise(F.lit(""))
    time = F.when(start.isNotNull(), F.concat(F.lit("- thread_start_time: `"), fixed3(start), F.lit("`"), when, F.lit("\n"))).otherwise(F.lit(""))
    return F.concat(F.lit('<a id="'), anchor_of(), F.lit('"></a>\n## '), markdown_inline(title), F.lit("\n\n- conversation_id: `"), conv, F.lit("`\n"), time, F.lit("\n"))


def _paragraph(s: str) -> Column:
    return F.when(blank(s), F.lit("")).otherwise(F.concat(trim(s), F.lit("\n\n")))


def _labelled(label: str, shown: Column, there: Column) -> Column:
    return F.when(there, F.concat(F.lit(f"**{label}**: "), markdown_inline(shown), F.lit("\n\n"))).otherwise(F.lit(""))


def _joined(c: str) -> Column:
    return F.array_join(F.coalesce(distinct_strings(c), F.array().cast("array<string>")), ", ")


def thread_section(key_points: bool = True, tags: bool = True) -> Column:
    """The section of a row of schemas.THREAD_SUMMARY."""
    parts = [_head(), _paragraph("summary")]
    if key_points:
        points = F.filter(F.transform("key_points", trim), lambda x: F.coalesce(x, F.lit("")) != "")
        bullets = F.array_join(F.transform(points, lambda x: F.concat(F.lit("- "), escape_newlines(x), F.lit("\n"))), "")
        parts.append(F.when(F.size("key_points") > 0, F.concat(F.lit("### Key points\n"), bullets, F.lit("\n"))).otherwise(F.lit("")))
    if tags:
        parts += [_labelled(c, _joined(c), F.size(c) > 0) for c in ("tags", "terms")]
    return F.concat(*parts, F.lit(END))


def sentiment_section() -> Column:
    """The section of a row of schemas.THREAD_SENTIMENT."""
    lists = [_labelled(c, _joined(c), _joined(c) != "") for c in SENTIMENT_LISTS]
    lines = [_labelled(c, trim(c), ~blank(c)) for c in ("relational_shift", "emotional_arc")]
    return F.concat(_head(), _paragraph("emotional_summary"), *lists, *lines, F.lit(END))
