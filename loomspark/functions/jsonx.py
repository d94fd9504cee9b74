"""Guarded access to JSON whose fields may have any type, and lenient decoding of model responses."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import trim

_TEXT_FIELDS = ("content_type", "text", "domain", "title", "url")
HIDDEN = "is_visually_hidden_from_conversation"


def _field(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "variant")


def _kind(v: Column) -> Column:
    """Type of a variant, 'VOID' for a missing field or JSON null."""
    return F.coalesce(F.schema_of_variant(v), F.lit("VOID"))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once: inside lambdas Spark doesn't share equal expressions."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def content(raw: Column) -> Column:
    """struct(content_type, text, domain, title, url) of a message's raw content.

    String elements of parts joined by line breaks, else text. A field of a wrong type empties all.
    """
    none = F.lit("").cast("string")

    def fields(v: Column) -> Column:
        fine = _kind(v).startswith("OBJECT")
        for name in _TEXT_FIELDS:
            fine &= _kind(_field(v, name)).isin("STRING", "VOID")
        fine &= once(_kind(_field(v, "parts")), lambda kind: (kind == "VOID") | kind.startswith("ARRAY"))
        elements = F.coalesce(F.try_variant_get(v, "$.parts", "array<variant>"), F.array().cast("array<variant>"))
        strings = F.transform(F.filter(elements, lambda x: _kind(x) == "STRING"), lambda x: F.variant_get(x, "$", "string"))

        def of(name: str) -> Column:
            return F.coalesce(F.try_variant_get(v, f"$.{name}", "string"), none)

        text = once(strings, lambda x: F.when(F.size(x) > 0, F.array_join(x, "\n")).otherwise(of("text")))
        own = F.struct(trim(of("content_type")).alias("content_type"), text.alias("text"), *(trim(of(k)).alias(k) for k in ("domain", "title", "url")))
        return F.when(fine, own).otherwise(F.struct(*(none.alias(k) for k in _TEXT_FIELDS)))

    return once(F.try_parse_json(raw), fields)


def hidden(metadata: Column) -> Column:
    """Whether the metadata hold the hidden flag as the JSON value true."""
    flag = once(_field(F.try_parse_json(metadata), HIDDEN), lambda f: (_kind(f) == "BOOLEAN") & F.coalesce(F.try_variant_get(f, "$", "boolean"), F.lit(False)))
    return F.coalesce(flag, F.lit(False))


def image_like(content_type: Column) -> Column:
    return F.contains(F.lower(trim(content_type)), F.lit("image"))


def _slice_between(s: Column, first: str, last: str) -> Column:
    """From the first opening to the last closing sign, null if there is no such stretch."""
    return F.nullif(F.regexp_extract(s, rf"(?s)\{first}.*\{last}", 0), F.lit(""))


def _json_of(s: Column, whole: str) -> Column:
    return F.when(F.try_parse_json(s).isNotNull() & F.rtrim(F.coalesce(s, F.lit(""))).rlike(whole), s)


def lenient_object(s: Column) -> Column:
    """The JSON object in a model's answer, as text: the whole, else from the first { to the last }."""
    t = trim(s)
    inner = _slice_between(t, "{", "}")
    return F.coalesce(_json_of(t, r"[}\]]$"), _json_of(inner, r"\}$"))


def lenient_array(s: Column) -> Column:
    """The JSON array in a model's answer, as text."""
    t = trim(s)
    return F.coalesce(_json_of(t, r"\]$"), _json_of(_slice_between(t, "[", "]"), r"\]$"))


def decode_status(s: Column) -> Column:
    """'ok', 'empty', 'truncated' (an object begins and doesn't end) or 'invalid'."""
    t = trim(F.coalesce(s, F.lit("")))
    return (
        F.when(t == "", F.lit("empty"))
        .when(lenient_object(t).isNotNull(), F.lit("ok"))
        .when(F.contains(t, F.lit("{")) & ~F.contains(t, F.lit("}")), F.lit("truncated"))
        .otherwise(F.lit("invalid"))
    )


def decode(s: Column, schema: T.StructType | T.ArrayType) -> Column:
    """A model's answer as a struct, or as an array where one is asked for; null if there is none in it."""
    find = lenient_array if isinstance(schema, T.ArrayType) else lenient_object
    return once(find(s), lambda found: F.when(found.isNotNull(), F.from_json(found, schema)))


#: What an error message says: the kind, and a pattern over its lower-cased text; the first that fits holds.
ERROR_KINDS = (
    ("rate_limit", r"\b429\b|rate.?limit|too many requests"),
    ("server", r"\b5\d\d\b|internal server|server_error|bad gateway|service unavailable"),
    ("truncated", r"truncat|unexpected e(nd|of)"),
)


def error_class(message: Column) -> Column:
    """'rate_limit', 'server', 'truncated' or 'other' by what an error message says."""
    m, found = F.lower(F.coalesce(message, F.lit(""))), F.lit("other")
    for kind, pattern in reversed(ERROR_KINDS):
        found = F.when(m.rlike(pattern), F.lit(kind)).otherwise(found)
    return found


def error_kind(message: str) -> str:
    """error_class of one message, where it is met."""
    return next((kind for kind, pattern in ERROR_KINDS if re.search(pattern, message.lower())), "other")
