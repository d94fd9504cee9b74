"""Quality rules: a ledger of rule bits and measurements, policies over it, ablations.

Every rule is evaluated once for each document. Its failure sets one bit of ``fail_bits``; the
measurements stand beside it, and the ledger is written to a table. A policy is a version and a mask of
the bits that reject, so a new policy, or the effect of leaving a rule out, needs no second look at the
texts: it reads the table.

Defined results: a null text has no words; an empty text fails ``few_words`` only. Repeated rows and
repeated ids are measured row by row, a null doc_id too. An empty table gives an empty ledger. Of the
input only ``doc_id`` and ``text`` are read, so further columns cannot clash; ``keep`` passes all through.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ASCII_SPACE, lean, stored

SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Bit of each rule, in the order of the ledger. The first two are the base rules.
RULES = ("few_words", "repeated_words", "symbols", "duplicate_lines", "word_length", "shouting")
BIT = {name: 1 << i for i, name in enumerate(RULES)}
BASE_MASK = BIT["few_words"] | BIT["repeated_words"]


@dataclass(frozen=True)
class Policy:
    version: int
    mask: int


POLICIES = {1: Policy(1, BASE_MASK), 2: Policy(2, sum(BIT.values()))}
CURRENT = 2

LEDGER = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
    ("n_lines", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("n_letters", pa.int64()),
    ("n_upper", pa.int64()), ("fail_bits", pa.int64()),
])
LEDGER_DDL = ", ".join(f"{f.name} bigint" for f in LEDGER)

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15 * (2 * i + 1) % (1 << 64) | 1 for i in range(WINDOW)], dtype=np.uint64)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside some window of ``window`` words that occurs twice or more, the first time included."""
    n = len(words)
    if n <= window:
        return 0
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.uint64, count=n)
    if len(ids) > n - window + 1 and n < 2 * window:
        return 0
    mixed = (codes + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0x94D049BB133111EB)
    mixed ^= mixed >> np.uint64(32)
    m = n - window + 1
    keys = np.zeros(m, dtype=np.uint64)
    for j in range(window):
        keys += mixed[j : j + m] * _MULTIPLIERS[j]
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(m, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(n + 1, dtype=np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def measure(text: str | None) -> tuple[int, ...]:
    """The ledger's columns after doc_id for one text."""
    text = text or ""
    words = text.encode("utf-8", "replace").split()
    n = len(words)
    chars = len(text) - sum(text.count(c) for c in ASCII_SPACE)
    symbols = sum(text.count(c) for c in SYMBOLS)
    seen: set[str] = set()
    lines = dup = 0
    for line in text.split("\n"):
        if line.strip(ASCII_SPACE):
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    repeat = repeated_words(words)
    raw = np.frombuffer(text.encode("ascii", "ignore"), dtype=np.uint8)
    upper = int(np.count_nonzero((raw >= 65) & (raw <= 90)))
    letters = upper + int(np.count_nonzero((raw >= 97) & (raw <= 122)))
    bits = 0
    if n < 20:
        bits |= BIT["few_words"]
    if 100 * repeat > 30 * n:
        bits |= BIT["repeated_words"]
    if 10 * symbols > 4 * n:
        bits |= BIT["symbols"]
    if lines and 100 * dup > 50 * lines:
        bits |= BIT["duplicate_lines"]
    if n and not 3 * n <= 2 * chars <= 60 * n:
        bits |= BIT["word_length"]
    if letters >= 20 and 10 * upper > 7 * letters:
        bits |= BIT["shouting"]
    return n, chars, symbols, lines, dup, repeat, letters, upper, bits


def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        rows = [measure(texts[i].as_py()) for i in range(batch.num_rows)]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * (len(LEDGER) - 1)
        yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), *(pa.array(c, pa.int64()) for c in columns)], schema=LEDGER)


def ledger(docs: DataFrame) -> DataFrame:
    """One row of measurements and failure bits for each row of docs(doc_id, text)."""
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(lean(_measure_batches), LEDGER_DDL)


def _measure_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (row, doc_id, text) as (row, ledger)."""
    for batch in batches:
        own = pa.RecordBatch.from_arrays([batch.column(1), batch.column(2)], names=["doc_id", "text"])
        for book in _measure_batches(iter([own])):
            yield pa.RecordBatch.from_arrays([batch.column(0), book.to_struct_array()], names=["row", "ledger"])


def annotate(docs: DataFrame) -> DataFrame:
    """(row, ledger): every row of docs as a struct beside its row of the ledger, so that no join brings them together."""
    slim = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = T.StructType([slim.schema["row"], T.StructField("ledger", T.StructType.fromDDL(LEDGER_DDL))])
    return slim.mapInArrow(lean(_measure_rows), schema)


def with_verdict(book: DataFrame, policy: Policy = POLICIES[CURRENT]) -> DataFrame:
    """base_failed, kept and the policy's version beside a ledger."""
    return book.withColumns({
        "base_failed": F.col("fail_bits").bitwiseAND(BASE_MASK) != 0,
        "kept": F.col("fail_bits").bitwiseAND(policy.mask | BASE_MASK) == 0,
        "policy_version": F.lit(policy.version),
    })


def ablation(book: DataFrame, policy: Policy = POLICIES[CURRENT]) -> DataFrame:
    """For each rule of a policy: documents that fail it, and those that only it rejects.

    One aggregation of the bits; the ledger is read once and nothing but counts is shuffled.
    """
    active = F.col("fail_bits").bitwiseAND(policy.mask)
    names = [r for r in RULES if policy.mask & BIT[r]]
    sums = [F.sum(F.when(active.bitwiseAND(BIT[r]) != 0, 1).otherwise(0)).alias(f"fail_{r}") for r in names]
    only = [F.sum(F.when(active == BIT[r], 1).otherwise(0)).alias(f"only_{r}") for r in names]
    total = book.agg(F.count(F.lit(1)).alias("n_docs"), F.bit_or("fail_bits").alias("any_bits"), *sums, *only)
    rows = F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).alias("bit"), F.coalesce(F.col(f"fail_{r}"), F.lit(0)).alias("n_failed"), F.coalesce(F.col(f"only_{r}"), F.lit(0)).alias("n_rejected_by_it_alone")) for r in names))
    return total.select("n_docs", F.explode(rows).alias("r")).select(F.lit(policy.version).alias("policy_version"), "n_docs", "r.*")


def keep(docs: DataFrame, policy: Policy = POLICIES[CURRENT]) -> DataFrame:
    """Rows of docs that the policy keeps, with their own columns only.

    The rules run once: rows and ledger are written together, and the policy reads the bits from there.
    """
    return apply_policy(stored(annotate(docs), "annotated"), policy)


def apply_policy(annotated: DataFrame, policy: Policy) -> DataFrame:
    """Rows that a policy keeps, of rows that stand beside their ledger."""
    return annotated.filter(F.col("ledger.fail_bits").bitwiseAND(policy.mask | BASE_MASK) == 0).select("row.*")


def compare(book: DataFrame, old: Policy, new: Policy) -> DataFrame:
    """Documents that two policies keep or reject alike or not, counted over the bits of a ledger."""
    verdict = lambda p: F.col("fail_bits").bitwiseAND(p.mask | BASE_MASK) == 0
    return book.groupBy(verdict(old).alias("old_kept"), verdict(new).alias("new_kept")).agg(F.count(F.lit(1)).alias("n_docs"))
