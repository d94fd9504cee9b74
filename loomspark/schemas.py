"""Row types of the engine, as DDL. Field names are those of the exchanged JSON."""

from __future__ import annotations

from pyspark.sql import types as T

MESSAGE = "role string, name string, create_time double, content_type string, text string, domain string, title string, url string"
RAW_CONVERSATION = (
    "conversation_id string, id string, title string, create_time double, update_time double, current_node string, "
    "mapping map<string, struct<id:string, message:struct<author:struct<role:string,name:string>, create_time:double, "
    "content:string, metadata:string>, parent:string, children:array<string>>>"
)
THREAD = f"conversation_id string, title string, create_time double, update_time double, messages array<struct<{MESSAGE.replace(' string', ':string').replace(' double', ':double')}>>"
CHUNK = f"conversation_id string, title string, thread_start_time double, chunk_number int, turn_start int, turn_end int, messages array<struct<{MESSAGE.replace(' string', ':string').replace(' double', ':double')}>>"
CHUNK_KEYS = "conversation_id string, thread_start_time double, chunk_number int, turn_start int, turn_end int"
SUMMARY_PAYLOAD = "summary string, key_points array<string>, tags array<string>, terms array<string>"
SENTIMENT_PAYLOAD = (
    "emotional_summary string, dominant_emotions array<string>, remembered_emotions array<string>, present_emotions array<string>, "
    "emotional_tensions array<string>, relational_shift string, emotional_arc string, themes array<string>, "
    "symbols_or_metaphors array<string>, resonance_notes string, tone_markers array<string>"
)
CHUNK_SUMMARY = f"{CHUNK_KEYS}, {SUMMARY_PAYLOAD}"
CHUNK_SENTIMENT = f"{CHUNK_KEYS}, {SENTIMENT_PAYLOAD}"
THREAD_KEYS = "conversation_id string, title string, thread_start_time double"
THREAD_SUMMARY = f"{THREAD_KEYS}, {SUMMARY_PAYLOAD}"
THREAD_SENTIMENT = f"{THREAD_KEYS}, {SENTIMENT_PAYLOAD}"
GLOSSARY_ENTRY = "term string, definition string, count int, first_seen_at double, last_seen_at double"
GLOSSARY_ADDITION = "seq bigint, seen_at double, pos int, term string, definition string"


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def names(ddl: str) -> list[str]:
    return struct(ddl).fieldNames()


def response_schema(ddl: str) -> dict:
    """JSON Schema for a model's structured response: closed objects, every property required."""

    def of(kind: dict | str) -> dict:
        if isinstance(kind, dict) and kind["type"] == "struct":
            props = {f["name"]: of(f["type"]) for f in kind["fields"]}
            return {"type": "object", "properties": props, "required": list(props), "additionalProperties": False}
        if isinstance(kind, dict) and kind["type"] == "array":
            return {"type": "array", "items": of(kind["elementType"])}
        return {"type": {"string": "string", "double": "number", "integer": "integer", "long": "integer", "boolean": "boolean"}[kind]}

    return of(struct(ddl).jsonValue())
