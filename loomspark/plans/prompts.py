"""Model inputs as text columns, each under its byte budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank, escape_newlines, fixed3, trim, truncate_bytes
from ..operators.budget import prefix_text

#: Byte budgets and caps (fixed values).
CHUNK_BYTES, CHUNK_RETRY_BYTES, ROLLUP_BYTES, MERGE_BYTES, LINE_BYTES = 80_000, 40_000, 80_000, 60_000, 2000
WHOLE = 1 << 62  # no budget
REQUEST_BYTES, REQUEST_TURNS, USER_BYTES, ASSISTANT_BYTES = 250_000, 250, 400, 600

ROLLUP_CAPS = {"summary": 1200, "key_points": 1800, "tags": 600, "terms": 600}
MERGE_CAPS = {"summary": 2500, "key_points": 2500, "tags": 1200, "terms": 800}
SENTIMENT_CAPS = {
    "emotional_summary": 1200, "dominant_emotions": 600, "remembered_emotions": 600, "present_emotions": 600, "emotional_tensions": 600,
    "relational_shift": 600, "emotional_arc": 600, "themes": 800, "symbols_or_metaphors": 800,
}
SENTIMENT_MERGE_CAPS = {
    "emotional_summary": 2500, "dominant_emotions": 1200, "remembered_emotions": 1200, "present_emotions": 1200, "emotional_tensions": 1200,
    "relational_shift": 600, "emotional_arc": 1000, "themes": 1500, "symbols_or_metaphors": 1500,
}

SENTIMENT_HEADER = "Describe how the conversation feels: moods, shifts between the speakers, and what stays with them."
SENTIMENT_TAIL = "Answer with one JSON object that fits the schema, and with nothing else."


def _of(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def transcript_line(tool_text: bool = True, most: int = LINE_BYTES) -> Column:
    """'- role[:name]: text' of a message row, cut at most bytes (0: whole); without tool_text, tool messages shrink to a reference."""
    role = F.coalesce(F.nullif("role", F.lit("")), F.lit("unknown"))
    name = F.when(_of("name") != "", F.concat(F.lit(":"), F.col("name"))).otherwise(F.lit(""))
    said = (
        F.when(~blank("text"), F.col("text"))
        .when((_of("url") != "") | (_of("title") != ""), trim(F.concat(_of("title"), F.lit(" "), _of("url"))))
        .otherwise(F.concat(F.lit("["), trim(_of("content_type")), F.lit("]")))
    )
    if not tool_text:
        kind = F.when(blank("content_type"), F.lit("tool")).otherwise(trim("content_type"))
        said = F.when(role == "tool", trim(F.concat_ws(" ", F.lit("[tool"), _of("name"), kind, _of("title"), _of("url")))).otherwise(said)
    return F.concat(F.lit("- "), role, name, F.lit(": "), escape_newlines(truncate_bytes(said, most)), F.lit("\n"))


def _glossary(excerpt: str) -> str:
    return f"glossary:\n{excerpt}\n" if excerpt else ""


def chunk_prompts(chunks: DataFrame, excerpt: str = "", most: int = CHUNK_BYTES, tool_text: bool = True, more: tuple[str, ...] = (), line_bytes: int = LINE_BYTES) -> DataFrame:
    """(conversation_id, chunk_number, turn_start, turn_end, prompt) of chunk rows; more: further key columns.

    Whole texts, however long: most=WHOLE, line_bytes=0.
    """
    own = ["conversation_id", "chunk_number", "turn_start", "turn_end"]
    keys = [*own, *more]
    rows = chunks.select(*keys, F.posexplode_outer("messages").alias("i", "m")).select(*keys, "i", "m.*")
    lines = prefix_text(rows.filter("i IS NOT NULL"), keys, ["i"], transcript_line(tool_text, line_bytes), most or CHUNK_BYTES, "... [transcript truncated]\n", "_lines")
    head = F.format_string("chunk_metadata:\nconversation_id=%s\nchunk_number=%d\nturn_range=%d..%d\n\n", *own)
    empty = chunks.select(*keys)
    full = empty.join(lines.select(*keys, "_lines"), keys, "left")
    return full.select(*keys, F.concat(head, F.lit(_glossary(excerpt) + "transcript:\n"), F.coalesce("_lines", F.lit(""))).alias("prompt"))


def _cap(c: str, kind: str, most: int) -> Column:
    joined = F.array_join(F.coalesce(F.col(c), F.array().cast("array<string>")), "; " if c == "key_points" else ", ") if kind.startswith("array") else _of(c)
    return F.concat(F.lit(f"  {c}="), truncate_bytes(joined, most), F.lit("\n"))


def _rows_prompt(rows: DataFrame, order: list[str], head: Column, first: str, section: str, caps: dict[str, int], excerpt: str, most: int) -> DataFrame:
    kinds = dict(rows.dtypes)
    line = F.concat(head, *(_cap(c, kinds[c], n) for c, n in caps.items()))
    text = prefix_text(rows, ["conversation_id"], order, line, most, f"... [{section} truncated]\n", "_lines")
    start = F.concat(F.lit("conversation_id="), F.col("conversation_id"), F.lit(f"\n{first}="), F.col("n_lines").cast("string"), F.lit("\n\n" + _glossary(excerpt) + f"{section}:\n"))
    return text.select("conversation_id", F.concat(start, F.col("_lines")).alias("prompt"))


def _chunk_head() -> Column:
    return F.format_string("- chunk=%d turn_range=%d..%d\n", "chunk_number", "turn_start", "turn_end")


def _part_head() -> Column:
    start = F.coalesce(fixed3("thread_start_time"), F.lit(""))
    return F.concat(F.lit("- part="), F.col("part").cast("string"), F.lit(" title="), truncate_bytes(_of("title"), 80), F.lit(" thread_start_time="), start, F.lit("\n"))


def rollup_prompts(summaries: DataFrame, excerpt: str = "") -> DataFrame:
    """(conversation_id, prompt) of chunk summary rows."""
    return _rows_prompt(summaries, ["chunk_number", "turn_start"], _chunk_head(), "chunks", "chunk_summaries", ROLLUP_CAPS, excerpt, ROLLUP_BYTES)


def merge_prompts(parts: DataFrame, excerpt: str = "") -> DataFrame:
    """(conversation_id, prompt) of partial thread summaries with their part numbers."""
    return _rows_prompt(parts, ["part"], _part_head(), "partial_rollups", "partial_thread_summaries", MERGE_CAPS, excerpt, MERGE_BYTES)


def sentiment_rollup_prompts(sentiments: DataFrame, excerpt: str = "") -> DataFrame:
    return _rows_prompt(sentiments, ["chunk_number", "turn_start"], _chunk_head(), "chunks", "chunk_sentiment_summaries", SENTIMENT_CAPS, excerpt, ROLLUP_BYTES)


def sentiment_merge_prompts(parts: DataFrame, excerpt: str = "") -> DataFrame:
    return _rows_prompt(parts, ["part"], _part_head(), "partial_rollups", "partial_thread_sentiment_summaries", SENTIMENT_MERGE_CAPS, excerpt, MERGE_BYTES)


def breakpoint_requests(turn_rows: DataFrame, threads: DataFrame, target: int, conv: str = "conversation_id") -> DataFrame:
    """(conv, request): the turns as JSON, with short texts unless that makes the request too large."""

    def request(texts: bool) -> Column:
        own = [F.col("turn_index").alias("turn"), F.col("start_time")]
        if texts:
            own += [F.nullif(truncate_bytes("user_text", USER_BYTES), F.lit("")).alias("user"), F.nullif(truncate_bytes("assistant_text", ASSISTANT_BYTES), F.lit("")).alias("assistant")]
        return F.array_sort(F.collect_list(F.struct(*own)))

    both = turn_rows.groupBy(conv).agg(F.count(F.lit(1)).alias("n"), request(True).alias("full"), request(False).alias("slim"))
    named = both.join(threads.select(conv, F.nullif("title", F.lit("")).alias("title")), conv)

    def json(turns: str) -> Column:
        return F.to_json(F.struct(F.col(conv).cast("string").alias("conversation_id"), F.col("title"), F.lit(target).alias("target_turns_per_chunk"), F.col("n").alias("total_turns"), F.col(turns).alias("turns")))

    large = (F.octet_length(json("full")) > REQUEST_BYTES) | (F.col("n") > REQUEST_TURNS)
    return named.select(conv, F.when(large, json("slim")).otherwise(json("full")).alias("request"))


def sentiment_instructions(header: str = "") -> str:
    return (header.strip() or SENTIMENT_HEADER) + "\n\n" + SENTIMENT_TAIL
