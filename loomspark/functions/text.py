"""Scalar text functions as column expressions; nothing here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode White_Space (fixed values).
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
ELLIPSIS = "\u2026"


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def trim(s: Column | str) -> Column:
    """Without Unicode white space at both ends."""
    return F.btrim(_col(s), F.lit(WHITE_SPACE))


def blank(s: Column | str) -> Column:
    """Null, empty or white space alone."""
    return F.coalesce(trim(s), F.lit("")) == ""


def truncate_bytes(s: Column | str, most: int) -> Column:
    """Trimmed; beyond ``most`` UTF-8 bytes cut at the last whole code point, with an ellipsis. 0: no limit."""
    t = trim(s)
    if most <= 0:
        return t
    cut = F.substring(t.cast("binary"), 1, most).cast("string")
    valid = F.make_valid_utf8(cut)
    whole = F.when(F.is_valid_utf8(cut), cut).otherwise(F.regexp_replace(valid, "\ufffd$", ""))
    return F.when(F.octet_length(t) > most, F.concat(whole, F.lit(ELLIPSIS))).otherwise(t)


def escape_newlines(s: Column | str) -> Column:
    """Every kind of line break as a backslash and n."""
    one = F.replace(F.replace(_col(s), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return F.replace(one, F.lit("\n"), F.lit("\\n"))


def file_component(s: Column | str) -> Column:
    """A file name part: letters, digits, '-', '_' and '.', other characters as '_'; no '.', '_', '-' at its ends."""
    return F.btrim(F.regexp_replace(trim(s), r"[^\p{L}\p{Nd}._-]", "_"), F.lit("._-"))


def anchor(s: Column | str) -> Column:
    """Anchor of an id: lower case, other than a-z 0-9 _ - as '-', none of these at its ends; 'thread' if blank."""
    t = trim(F.lower(_col(s)))
    return F.when(t == "", F.lit("thread")).otherwise(F.btrim(F.regexp_replace(t, "[^a-z0-9_-]", "-"), F.lit("-")))


def markdown_inline(s: Column | str) -> Column:
    return trim(F.translate(_col(s), "\n\r", "  "))


def key(s: Column | str) -> Column:
    return F.lower(trim(s))


def iso8601(t: Column | str) -> Column:
    """UTC second of a unix time, '' for null or not positive."""
    t = _col(t)
    ns = F.round(t * 1e9).cast("bigint")
    second = ((ns - F.pmod(ns, F.lit(1_000_000_000))) / 1_000_000_000).cast("bigint")
    return F.when(t > 0, F.date_format(F.timestamp_seconds(second), "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(F.lit(""))


def unix_stamp(t: Column | str) -> Column:
    """Whole seconds as text, '' for null or not positive."""
    t = _col(t)
    return F.when(t > 0, F.floor(t).cast("bigint").cast("string")).otherwise(F.lit(""))


def fixed3(t: Column | str) -> Column:
    """A number with three decimals, rounded from its exact binary value."""
    t = _col(t)
    size = F.abs(t)
    whole = F.floor(size).cast("bigint")
    ms = F.rint((size - F.floor(size)) * 1000).cast("bigint")
    sign = F.when((t < 0) & ((whole > 0) | (ms > 0)), F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, F.format_string("%d.%03d", whole + (ms / 1000).cast("bigint"), ms % 1000))


def padded(n: Column | str, width: int) -> Column:
    return F.format_string(f"%0{width}d", _col(n))


def distinct_strings(a: Column | str) -> Column:
    """Trimmed, without blanks, each spelling of a string once and in its first form.

    Sorted by spelling and place, so that equal ones are neighbours: n log n steps for n strings.
    """
    there = F.filter(F.transform(_col(a), trim), lambda s: F.coalesce(s, F.lit("")) != "")
    ranked = F.array_sort(F.transform(there, lambda s, i: F.struct(F.lower(s).alias("k"), i.alias("i"), s.alias("s"))))
    # one array in an array, so that the lambda's variable stands for what was sorted once
    first = F.transform(F.array(ranked), lambda r: F.filter(r, lambda x, i: (i == 0) | (F.get(r, i - 1).k != x.k)))[0]
    return F.when(F.size(_col(a)) > 0, F.transform(F.array_sort(F.transform(first, lambda x: F.struct(x.i, x.s))), lambda x: x.s))


def first_n(a: Column | str, n: int) -> Column:
    """The first n elements; all if n isn't positive."""
    return _col(a) if n <= 0 else F.slice(_col(a), 1, n)


def relative_path(path: Column | str, root: str) -> Column:
    return F.regexp_replace(_col(path), "^(?:file:)?/*" + "".join(f"\\Q{p}\\E/+" for p in root.replace("file:", "").strip("/").split("/")), "")


def swap_suffix(path: Column | str, old: str, new: str) -> Column:
    """path with a suffix replaced, compared by case."""
    p = _col(path)
    return F.when(F.endswith(p, F.lit(old)), F.concat(F.substring(p, F.lit(1), F.length(p) - len(old)), F.lit(new)))
