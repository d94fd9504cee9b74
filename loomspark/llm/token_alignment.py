"""Alignment of two tokenizers by a cogroup of postings.

Both tokenizers cut a text, a space put before it, at byte offsets; where both cut, a group ends, and all
tokens of one side link with all of the other's in the group. A pair of ids weighs as much as there are
documents that link it.

A text falls into units before both tokenizers see it: at a space or line feed behind a letter, digit or
ASCII sign. Neither tokenizer has a token across such a place, nor looks past it from the left, so a unit's
tokens are those that the text would give, also if other units stand beside it: unknown ones are encoded
many at a time, and a worker remembers those that it meets most. A unit that doesn't give its own bytes
back makes its text be encoded and compared whole.

A task packs some documents at a time and writes, beside their own numbers, the postings of each id of side
A: its pairs, and for each pair the documents with its multiplicity. The postings are shuffled by the id.
Those of an id with more than its share of all are dealt over several keys; how many is known from the sums
of the counts, one for each id of the vocabulary at most. With each key go, before its postings in
the sort, the corpus-wide counts of the id's pairs, at most as many as side B has ids. So a task reads a
sorted stream, which Spark spills as needed: first the counts, from which it takes the highest, then
the postings, which it turns into what they add to their documents, summed up by chunks of documents before the last shuffle.

Defined results: a null or empty text, and one whose tokens don't give its bytes back on both sides, has
zeros and an empty digest. Each row is a document of its own, also where ids repeat or are null. Texts of any
length are read a part at a time. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import caches, lean, mark, release, stored, stored_since

#: Units that a Python worker remembers; beyond, the half that it met more often stays.
UNITS_KEPT = 400_000
#: Code points up to which a unit is remembered.
UNIT_CHARS = 60
#: Units that are encoded together.
TOGETHER = 2000
#: Code points whose postings are packed together, and that are split into units together.
CHUNK_CHARS, PART_CHARS = 4_000_000, 500_000
#: Documents of a chunk; with those that are learned together, their numbers within it are 16-bit.
CHUNK_ROWS = 50_000
#: Entries that are summed up before they are passed on.
HELD = 1 << 20
#: Keys of an id in all partitions together, for one that had all postings: parts of this many to a partition.
PARTS = 4

_CUT = re.compile(r"(?=[ \n])(?:(?<=\w)|(?<=[!-/:-@\[-`{-~]))")

DOCUMENTS = "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
POSTINGS = "a int, b binary, held binary, docs binary, times binary"


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _byte_level() -> dict[str, int]:
    """The bytes that the characters of a byte-level vocabulary stand for: printable ones for themselves, the rest from U+0100 on in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Tokens, groups and linked pairs of units under both tokenizers."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        level = _byte_level()
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = token.encode() if token in special else bytes(level[c] for c in token)
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.b_space = self.b.piece_to_id("▁")
        self.a_size, self.b_size = (np.array([len(x) for x in side]) for side in (self.a_bytes, self.b_bytes))
        self.a_text, self.b_text = ([np.array([f"{i}{end}" for i in range(len(side))], object) for end in ends] for side, ends in ((self.a_bytes, ",|"), (self.b_bytes, ",;")))
        self.known: dict[str, int] = {}
        self.groups: list[str | None] = []  # of each unit, with a semicolon behind each; None where it doesn't give its bytes back
        # of each unit: tokens, groups and links, where its pairs end, how often it was met; of each pair: a << 15 | b and its links
        self.numbers, self.ends, self.met, self.pairs, self.times = np.zeros((0, 4), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._new: list[tuple] = []

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def tokens(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of a text that begins with a space or line feed."""
        a = self.a.encode(text, add_special_tokens=False).ids
        if text[0] == " ":
            return a, self.b.encode(text[1:]) if len(text) > 1 else [self.b_space]
        return a, self.b.encode(text)[1:]

    def aligned(self, units: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Of units that stand side by side: groups, numbers, ends of their pairs, pairs and times; None if their bytes don't come back."""
        text = "".join(units)
        a, b = self.tokens(text)
        data = text.encode("utf-8", "surrogatepass")
        if b"".join([self.a_bytes[i] for i in a]) != data or b"".join([self.b_bytes[i] for i in b]) != data:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        a_at, b_at = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        both = np.intersect1d(a_at, b_at, assume_unique=True)
        till = np.cumsum([len(u) for u in units] if len(data) == len(text) else [len(u.encode("utf-8", "surrogatepass")) for u in units])
        last = np.searchsorted(both, till)
        if not np.array_equal(both[np.minimum(last, len(both) - 1)], till):
            return None
        of_a, of_b = np.searchsorted(both, a_at), np.searchsorted(both, b_at)
        n_a, n_b = np.bincount(of_a, minlength=len(both)), np.bincount(of_b, minlength=len(both))
        a_end, b_end = np.cumsum(n_a), np.cumsum(n_b)
        unit = np.searchsorted(last, np.arange(len(both)))
        total = lambda x: np.add.reduceat(x, np.append(0, last[:-1] + 1))
        numbers = np.stack([total(n_a), total(n_b), np.diff(np.append(-1, last)), total(n_a * n_b)], axis=1)
        # all tokens of side B in its group for each of side A
        times = n_b[of_a]
        first = np.repeat(a, times)
        second = b[np.repeat((b_end - n_b)[of_a] - np.cumsum(times) + times, times) + np.arange(times.sum())]
        keys, count = np.unique(np.repeat(unit[of_a], times) << 31 | first << 15 | second, return_counts=True)
        # ids with what stands behind them, side A's of a group before side B's
        written = np.empty(len(a) + len(b), object)
        a_to, b_to = np.arange(len(a)) + (b_end - n_b)[of_a], np.arange(len(b)) + a_end[of_b]
        a_last, b_last = np.arange(1, len(a) + 1) == a_end[of_a], np.arange(1, len(b) + 1) == b_end[of_b]
        written[a_to], written[b_to] = np.where(a_last, self.a_text[1][a], self.a_text[0][a]), np.where(b_last, self.b_text[1][b], self.b_text[0][b])
        written = written.tolist()
        begin, groups = 0, []
        for end in (a_end + b_end)[last].tolist():
            groups.append("".join(written[begin:end]))
            begin = end
        return groups, numbers, np.searchsorted(keys >> 31, np.arange(len(units)), side="right"), keys & (1 << 31) - 1, count

    def _add(self, units: list[str]) -> None:
        found = self.aligned(units)
        if found is None and len(units) > 1:
            for u in units:
                self._add([u])
            return
        groups, *rest = found or ([None], np.zeros((1, 4), np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.known.update(zip(units, range(len(self.groups), len(self.groups) + len(units)), strict=True))
        self.groups += groups
        self._new.append(tuple(rest))

    def learn(self, units: list[str]) -> None:
        """Remember units that aren't known; those that could end anywhere in a text are encoded side by side."""
        inner = [u for u in units if _CUT.search(u + " ", len(u))]
        for u in set(units).difference(inner):
            self._add([u])
        inner.sort(key=lambda u: u[0] != " ")  # a space at the start of all
        for k in range(0, len(inner), TOGETHER):
            self._add(inner[k : k + TOGETHER])

    def settle(self) -> None:
        """Put what was learned lately behind the rest."""
        if self._new:
            numbers, ends, pairs, times = ([x[k] for x in self._new] for k in range(4))
            base = np.cumsum([0, *map(len, pairs)])[:-1] + len(self.pairs)
            self.ends = np.concatenate([self.ends, *(e + k for e, k in zip(ends, base, strict=True))])
            self.numbers, self.pairs, self.times = np.concatenate([self.numbers, *numbers]), np.concatenate([self.pairs, *pairs]), np.concatenate([self.times, *times])
            self.met = np.append(self.met, np.zeros(len(self.ends) - len(self.met), np.int64))
            self._new = []

    def forget(self) -> None:
        """Keep the half of the units that was met more often, if there are too many."""
        if len(self.groups) <= UNITS_KEPT:
            return
        stay = np.sort(np.argsort(-self.met, kind="stable")[: UNITS_KEPT // 2])
        at, size = self.of(stay)
        number = np.full(len(self.ends), -1)
        number[stay] = np.arange(len(stay))
        number = number.tolist()
        self.known = {u: number[k] for u, k in self.known.items() if number[k] >= 0}
        self.groups = [self.groups[k] for k in stay.tolist()]
        self.numbers, self.pairs, self.times, self.ends, self.met = self.numbers[stay], self.pairs[at], self.times[at], np.cumsum(size), self.met[stay] // 2

    def of(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the pairs of units, and their number for each."""
        begin = np.append(0, self.ends[:-1])[units]
        size = self.ends[units] - begin
        return np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum()), size

    def numbered(self, texts: list[str]) -> list[list[int]]:
        """Numbers of the units of texts, which are learned together; long units are encoded but not looked up again."""
        units = [_CUT.split(t) for t in texts]
        fresh = set().union(*units).difference(self.known)
        if fresh:
            self.learn(sorted(fresh))
        found = [list(map(self.known.__getitem__, u)) for u in units]
        for u in fresh:
            if len(u) > UNIT_CHARS:
                del self.known[u]
        return found

    def parts(self, text: str) -> Iterator[list[int]]:
        """Numbers of a long text's units, a part of the text at a time."""
        begin = 0
        while begin < len(text):
            found = None if begin + PART_CHARS >= len(text) else _CUT.search(text, begin + PART_CHARS)
            end = found.start() if found else len(text)
            yield from self.numbered([text[begin:end]])
            begin = end


_aligners: dict[tuple[str, str], Aligner] = {}
caches["token_alignment"] = _aligners.clear


def _aligner(paths: tuple[str, str]) -> Aligner:
    if paths not in _aligners:
        _aligners[paths] = Aligner(*paths)
    return _aligners[paths]


def _summed(keys: np.ndarray, *sums: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and the sums of what belongs to each."""
    if not len(keys):
        return keys, *sums
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[head], *(np.add.reduceat(x[order], head) for x in sums)


def _packed(pairs: np.ndarray, times: np.ndarray, row: int) -> pa.RecordBatch:
    """Postings of a chunk: for each id of side A its ids of side B, how many documents hold each, which, and how often."""
    pair, doc = pairs >> 16, (pairs & 0xFFFF).astype("<u2")
    heads = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, np.int64)
    a, b, held = (pair[heads] >> 15).astype(np.int32), (pair[heads] & 0x7FFF).astype("<u2"), np.diff(np.append(heads, len(pair))).astype("<u4")
    firsts = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.zeros(0, np.int64)
    ends, marks = np.append(firsts, len(a))[1:], np.append(heads, len(pair))

    def cut(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.Array:
        data, w = x.tobytes(), x.itemsize
        return pa.array([data[i:j] for i, j in zip((lo * w).tolist(), (hi * w).tolist(), strict=True)], pa.binary())

    void = [pa.nulls(len(firsts), pa.int64())] * 5 + [pa.nulls(len(firsts), pa.string())]
    columns = [pa.array(np.full(len(firsts), row)), *void, pa.array(a[firsts]), cut(b, firsts, ends), cut(held, firsts, ends), cut(doc, marks[firsts], marks[ends]), cut(times.astype("<u4"), marks[firsts], marks[ends])]
    return pa.RecordBatch.from_arrays(columns, names=_NAMES)


_NAMES = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "held", "docs", "times"]


class _Chunk:
    """Documents that a task packs together, in the order in which they come."""

    def __init__(self, code: Aligner, row: int):
        self.code, self.row, self.size = code, row, 0
        self.ids: list[int | None] = []
        self.digests: list[str] = []
        self.units: list[np.ndarray] = []  # document << 32 | unit
        self.whole: list[tuple] = []  # document, numbers, pairs and times of texts that were encoded whole

    def add(self, docs: list[tuple[int | None, str | None]]) -> None:
        """Some documents, together of bounded length unless it is one."""
        code = self.code
        texts = [" " + t for _, t in docs if t]
        found = iter(code.parts(t) for t in texts) if len(texts) == 1 else iter([u] for u in code.numbered(texts))
        for doc, text in docs:
            self._add(doc, text, next(found) if text else ())
            self.size += len(text or "")

    def _add(self, doc: int | None, text: str | None, parts: Iterable[list[int]]) -> None:
        k, code, digest, sha = len(self.ids), self.code, "", hashlib.sha256()
        units: list[np.ndarray] | None = []
        for numbers in parts:
            groups = [code.groups[u] for u in numbers]
            if None in groups:
                units = None
                break
            sha.update(((";" if units else "") + "".join(groups)[:-1]).encode())
            units.append(np.array(numbers, np.int64) | k << 32)
        if units:
            self.units += units
            digest = sha.hexdigest()
        elif text and (aligned := code.aligned([" " + text])):
            self.whole.append((k, aligned[1][0], aligned[3], aligned[4]))
            digest = hashlib.sha256(aligned[0][0][:-1].encode()).hexdigest()
        self.ids.append(doc)
        self.digests.append(digest)

    def out(self) -> Iterator[pa.RecordBatch]:
        code, n = self.code, len(self.ids)
        code.settle()
        keys, met = np.unique(np.concatenate([np.zeros(0, np.int64), *self.units]), return_counts=True)
        doc, unit = keys >> 32, keys & (1 << 32) - 1
        np.add.at(code.met, unit, met)
        numbers = np.zeros((n, 4), np.int64)
        np.add.at(numbers, doc, code.numbers[unit] * met[:, None])
        at, size = code.of(unit)
        pairs, times = [code.pairs[at] << 16 | np.repeat(doc, size)], [code.times[at] * np.repeat(met, size)]
        for k, own, found, count in self.whole:
            numbers[k] = own
            pairs.append(found << 16 | k)
            times.append(count)
        pairs, times = _summed(np.concatenate(pairs), np.concatenate(times))
        void = [pa.nulls(n, pa.int32())] + [pa.nulls(n, pa.binary())] * 4
        yield pa.RecordBatch.from_arrays([pa.array(self.row + np.arange(n)), pa.array(self.ids, pa.int64()), *(pa.array(x) for x in numbers.T.copy()), pa.array(self.digests), *void], names=_NAMES)
        out = _packed(pairs, times, self.row)
        yield from (out.slice(i, 5000) for i in range(0, out.num_rows, 5000))
        code.forget()


def _encode(batches: Iterator[pa.RecordBatch], paths: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    """Rows of documents, and of the postings of each chunk of them by their id of side A."""
    code = _aligner(paths)
    code.settle()
    code.forget()
    base = TaskContext.get().partitionId() << 40
    chunk, some, size = _Chunk(code, base), [], 0
    for batch in batches:
        for doc, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = value.as_py()
            if some and size + len(text or "") > PART_CHARS:
                chunk.add(some)
                some, size = [], 0
                if chunk.size >= CHUNK_CHARS or len(chunk.ids) >= CHUNK_ROWS:
                    yield from chunk.out()
                    chunk = _Chunk(code, chunk.row + (1 << 16))
            some.append((doc, text))
            size += len(text or "") + 100
    if some:
        chunk.add(some)
        yield from chunk.out()


def _flat(column: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents hold each pair, summed up over some of a task's postings (a, b, held)."""
    waiting, size = [], 0

    def out() -> pa.RecordBatch:
        keys, n = _summed(np.concatenate([w[0] for w in waiting]), np.concatenate([w[1] for w in waiting]))
        return pa.RecordBatch.from_arrays([pa.array((keys >> 15).astype(np.int32)), pa.array((keys & 0x7FFF).astype(np.int32)), pa.array(n)], names=["a", "b", "n"])

    for batch in batches:
        b = _flat(batch.column(1), "<u2").astype(np.int64)
        a = np.repeat(batch.column(0).to_numpy().astype(np.int64), [len(x) // 2 for x in batch.column(1).to_pylist()])
        waiting.append((a << 15 | b, _flat(batch.column(2), "<u4").astype(np.int64)))
        size += len(b)
        if size >= HELD:
            yield out()
            waiting, size = [], 0
    if waiting:
        yield out()


def _by_chunk(rows: np.ndarray, best: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
    """Sums of documents, a row for each chunk of them."""
    rows, best, total = _summed(rows, best, total)
    chunk = rows >> 16
    head = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1]))
    cut = lambda x: pa.array([p.tobytes() for p in np.split(x, head[1:])], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(chunk[head] << 16), cut((rows & 0xFFFF).astype("<u2")), cut(best.astype("<i8")), cut(total.astype("<i8"))], names=["row", "docs", "best", "total"])


def _cogroup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each document gets from the links of the ids of this task; rows: an id's counts, then its postings."""
    waiting, size, b, n = [], 0, None, None
    for batch in batches:
        counted, begin = batch.column(1).is_valid().to_pylist(), 0
        while begin < len(counted):
            if counted[begin]:
                b, n = batch.column(1)[begin].values.to_numpy(), batch.column(2)[begin].values.to_numpy()
                begin += 1
                continue
            end = begin
            while end < len(counted) and not counted[end]:
                end += 1
            part = batch.slice(begin, end - begin)
            docs = [len(x) // 2 for x in part.column(6).to_pylist()]
            held, pairs = _flat(part.column(5), "<u4"), _flat(part.column(4), "<u2")
            count = n[np.searchsorted(b, pairs)]
            count, best = np.repeat(count, held), np.repeat(count == n.max(), held)
            rows = np.repeat(part.column(3).to_numpy(), docs) + _flat(part.column(6), "<u2")
            times = _flat(part.column(7), "<u4").astype(np.int64)
            waiting.append((rows, times * best, times * count))
            size, begin = size + len(rows), end
            if size >= HELD:
                yield _by_chunk(*(np.concatenate([w[k] for w in waiting]) for k in range(3)))
                waiting, size = [], 0
    if waiting:
        yield _by_chunk(*(np.concatenate([w[k] for w in waiting]) for k in range(3)))


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of each document; a chunk's rows come one after the other."""

    def out() -> pa.RecordBatch:
        found = np.flatnonzero(seen)
        return pa.RecordBatch.from_arrays([pa.array(last + found), pa.array(best[found]), pa.array(total[found])], names=["row", "n_best", "count_sum"])

    last, seen, best, total = None, np.zeros(1 << 16, bool), np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
    for batch in batches:
        for row, docs, b, t in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            if row != last:
                if last is not None:
                    yield out()
                last = row
                for x in (seen, best, total):
                    x[:] = 0
            at = np.frombuffer(docs, "<u2")
            seen[at] = True
            best[at] += np.frombuffer(b, "<i8")
            total[at] += np.frombuffer(t, "<i8")
    if last is not None:
        yield out()


def align(docs: DataFrame, tokenizers: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row of docs(doc_id, text)."""
    spark, paths, point = docs.sparkSession, tokenizers or default_tokenizers(), mark()
    slim = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    encoded = stored(slim.mapInArrow(lean(lambda x: _encode(x, paths), "token_alignment"), f"{DOCUMENTS}, {POSTINGS}"), "postings")
    own, postings = encoded.filter("a IS NULL"), encoded.filter("a IS NOT NULL")

    counts = postings.select("a", "b", "held").mapInArrow(lean(_counts), "a int, b int, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))
    by_id = stored(counts.groupBy("a").agg(F.array_sort(F.collect_list(F.struct("b", "n"))).alias("pairs"), F.sum("n").alias("size")), "counts")
    total = by_id.agg(F.sum("size")).first()[0] or 0
    share = max(1, total // (PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    # one row an id of side A's vocabulary at most
    keys = F.broadcast(by_id.select("a", F.ceil(F.col("size") / share).cast("int").alias("keys")).filter("keys > 1"))

    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("row", "bigint"), ("b", "binary"), ("held", "binary"), ("docs", "binary"), ("times", "binary"))]
    first = by_id.select("a", F.explode(F.sequence(F.lit(0), F.ceil(F.col("size") / share).cast("int") - 1)).alias("key"), F.col("pairs.b").alias("bs"), F.col("pairs.n").alias("ns"), *nothing)
    rest = postings.join(keys, "a", "left").select(
        "a", F.pmod(F.xxhash64("row"), F.coalesce("keys", F.lit(1))).cast("int").alias("key"), F.lit(None).cast("array<int>").alias("bs"), F.lit(None).cast("array<bigint>").alias("ns"), "row", "b", "held", "docs", "times"
    )
    both = first.unionByName(rest).repartition("a", "key").sortWithinPartitions("a", "key", F.col("bs").isNull())
    added = both.select("a", "bs", "ns", "row", "b", "held", "docs", "times").mapInArrow(lean(_cogroup), "row bigint, docs binary, best binary, total binary")
    sums = added.repartition("row").sortWithinPartitions("row").mapInArrow(lean(_added), "row bigint, n_best bigint, count_sum bigint")
    zero = F.lit(0).cast("bigint")
    out = own.join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
    done = stored(out, "aligned")
    release(spark, [p for p in stored_since(point) if p != done._stored_at])
    return done
