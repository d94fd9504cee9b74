"""Packing by power-of-two decomposition.

A document of L tokens is cut into the binary digits of L: full contexts first, then falling powers
of two. Each piece is a sequence of its own, so no sequence crosses documents and none is padded;
equal lengths form the buckets from which batches are drawn.

Defined results: a null text is empty and yields the end token alone (one piece of length 1). Repeated
rows are packed row by row. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import caches, lean

CONTEXT = 4096
END = 2
#: Distinct words whose ids a Python worker remembers; beyond, the older half goes.
WORDS_KEPT = 500_000

#: Punctuation at a word's end: its letters or digits before are other pre-tokens. No apostrophes, which may
#: begin a contraction, and no underscore before, which would be one pre-token with it.
_TRAILING = re.compile(r"(?<=[^\W_])([.,!?|;:%$#&*]+)(?!\S)")
#: What str.split takes for white space and the tokenizer doesn't, and what begins a special token.
_ODD = ("\x1c", "\x1d", "\x1e", "\x1f", "<|")

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, piece int"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordCoder:
    """Token ids of whole texts, a white-space-separated word at a time.

    The vocabulary's normaliser and pre-tokenizer never look across white space, so the ids of a text
    are those of its words in order; each distinct word is encoded once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _encode(self, text: str) -> bytes:
        return np.array(self.model.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, words: set[str]) -> None:
        """Put the words into the younger cache; what the older has isn't encoded again."""
        known, older = self.words, self.older
        fresh = []
        for w in words:
            if w in older:
                known[w] = older[w]
            elif w.isalpha():
                fresh.append(w)
            else:
                known[w] = self._encode(w)
        for i in range(0, len(fresh), 2000):
            some = fresh[i : i + 2000]
            found = self.model.encode(" ".join(some), add_special_tokens=False)
            of = found.word_ids
            if of[-1] == len(some) - 1:
                raw = np.array(found.ids, dtype="<u4").tobytes()
                at = (4 * np.searchsorted(np.array(of), np.arange(len(some) + 1))).tolist()
                for w, a, b in zip(some, at, at[1:], strict=False):
                    known[w] = raw[a:b]
            else:
                for w in some:
                    known[w] = self._encode(w)

    @staticmethod
    def _split(text: str) -> list[str]:
        """White-space-separated words, punctuation behind a letter or digit parted from it as the tokenizer does."""
        # a capital sigma is lower-cased by its place in the word here, but not there
        text = text.replace("\u03a3", "\u03c3").lower()
        return _TRAILING.sub(r" \1", text).split()

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text."""
        size = sum(map(len, texts))
        if size > 4_000_000 and len(texts) > 1:
            half = len(texts) // 2
            yield from self.encode(texts[:half])
            yield from self.encode(texts[half:])
            return
        if len(self.words) > WORDS_KEPT:
            self.words, self.older = {}, self.words
        odd = {i: self._encode(t) for i, t in enumerate(texts) if any(c in t for c in _ODD)}
        split = [[] if i in odd else self._split(t) for i, t in enumerate(texts)]
        unknown = set().union(*split).difference(self.words)
        if unknown:
            self._learn(unknown)
        for i, ws in enumerate(split):
            yield odd[i] if i in odd else b"".join(map(self.words.__getitem__, ws))


_coders: dict[str, WordCoder] = {}
caches["packing"] = _coders.clear


def coder(path: str) -> WordCoder:
    if path not in _coders:
        _coders[path] = WordCoder(path)
    return _coders[path]


def binary_pieces(tokens: int, context: int = CONTEXT) -> list[int]:
    """Lengths of the pieces of a document: full contexts, then falling powers of two."""
    if context < 1 or context & (context - 1):
        raise ValueError("context must be a power of two")
    whole, rest = divmod(tokens, context)
    return [context] * whole + [1 << b for b in range(context.bit_length() - 1, -1, -1) if rest >> b & 1]


def pieces(docs: DataFrame, tokenizer: str | None = None, context: int = CONTEXT, end: int = END, with_ids: bool = False) -> DataFrame:
    """Every piece of every row of docs(doc_id, text); with_ids adds the piece's ids as array<int>.

    A narrow transformation: nothing is shuffled. sequence_id is unique among the result's rows; bucket is
    the length's power of two.
    """
    path = tokenizer or default_tokenizer()
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("piece", pa.int32())] + [("ids", pa.list_(pa.int32()))] * with_ids)
    last = np.array([end], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows: list[tuple] = []
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc, raw in zip(part.column(0).to_pylist(), code.encode(texts), strict=True):
                    raw += last
                    total, start = len(raw) // 4, 0
                    for k, length in enumerate(binary_pieces(total, context)):
                        own = raw[4 * start : 4 * (start + length)]
                        rows.append((doc, start, length, zlib.crc32(own), total, k, *([np.frombuffer(own, dtype="<i4")] * with_ids)))
                        start += length
                columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    slim = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    found = slim.mapInArrow(lean(cut, "packing"), PIECES + ", ids array<int>" * with_ids)
    bucket = F.log2("length").cast("int").alias("bucket")
    return found.select(*(c for c in found.columns if c != "piece"), F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"), bucket)


def write_buckets(packed: DataFrame, path: str) -> None:
    """Pieces by their length, a folder for each power of two: a loader reads batches of equal length from one."""
    packed.write.partitionBy("length").parquet(path)


def buckets(packed: DataFrame) -> DataFrame:
    """How many sequences and tokens each length holds: what a loader draws its batches from."""
    return packed.groupBy("length").agg(F.count(F.lit(1)).alias("n_sequences"), F.sum("length").alias("n_tokens"))
