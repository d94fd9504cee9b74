"""Exact substring removal with a logarithmic family of suffix arrays.

A byte goes if some ``LENGTH``-byte string over it also starts in a document with a smaller id.

Suffixes are sampled so that the sampling depends on content alone: in each window of LENGTH bytes the
position of the least hashed GRAM-byte gram (the leftmost one, if several) is its anchor. Neighbouring
windows with one anchor form a run, kept as the suffix at the run's start, cut behind its last window.
Equal windows have equal anchors, so everything that can match meets in the bucket of the anchor's hash.

In a bucket the suffixes come in batches of rising ids. A batch's suffix array (the sorted suffixes) is
merge-scanned against the levels built so far: whole suffixes found there are removed at once, the others
join the family as level 0, and levels of like size merge, so each suffix is merged O(log n) times.
Suffixes that share half a window's bytes with another one, so that a part of their windows may match,
have each window's start sorted into a second, dense array, which goes through a family of its own.

``SuffixIndex`` keeps such levels in a shared folder between batches of documents: a new batch is
scanned against them, written as level 0, and stored levels of like size merge.

An anchor gram that stands in very many different suffixes would fill a bucket. Such grams are counted
beforehand, and their suffixes are cut in two, by whether most of a window lies before or behind the
anchor, and dealt out by the bytes there that all windows of the part share.

Bytes are compared, not hashes; hashes only deal out the work. Copies within one map task are found
there, so a group of copies costs a row a task, however large it is.

Defined results: a null text is empty; nothing is removed from texts under LENGTH bytes. Repeated
strings within a document, and rows with equal ids, don't remove each other's bytes. A row with a null
doc_id neither loses bytes nor takes them from others. Empty tables give empty results. Further columns
are not read by ``spans``; ``remove`` keeps them.
"""

import hashlib
import struct
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, drop_path, lean, stored, table_exists

LENGTH = 50
GRAM = 8
#: Text that a bucket stands for. The number of buckets follows the input.
BUCKET_BYTES = 6_000_000
#: Text whose suffixes a map task deals out together, and text that it anchors at a time (of longer texts four times as much).
CHUNK_BYTES = 4_000_000
PART_BYTES = 250_000
#: Least share of all suffixes that makes a gram frequent; so at most this many are sent to all tasks.
LEAST_SHARE = 1e-5
#: Suffixes of a batch, and a quarter of its windows.
BATCH_ROWS = 1 << 13

_FRONT = LENGTH - GRAM  # bytes of a window before its last possible anchor
_RUN = _FRONT + 1  # most windows that share an anchor occurrence
_WIDE = _RUN + LENGTH - 1  # longest suffix
_KEY = (_WIDE + 8) // 8 * 8  # with a last byte for the length, so that no key ends in zeros
_HALF = _FRONT // 2
_PROBE = LENGTH - _HALF
_END = (1 << 24) - 1


# ---- anchors


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position as an integer; data has 8 bytes to spare."""
    return np.ndarray((len(data) - 8,), dtype="<u8", buffer=data, strides=(1,)).copy()


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(29)
    return x


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor in texts laid end to end.

    data: the bytes with 16 zero bytes behind; ends: where each text stops. Returns the text, first
    window, number of windows, anchor and anchor's hash of each run.
    """
    n = int(ends[-1]) if len(ends) else 0
    none = np.zeros(0, dtype=np.int64)
    if n < LENGTH:
        return none, none, none, none, none.astype(np.uint64)
    word = _words(data[: n + 16])
    grams = _mix(word[:n] * np.uint64(0x9E3779B97F4A7C15) + word[GRAM - 8 : n + GRAM - 8])
    # high bits decide, then the place: the leftmost of equal ones is least
    least = grams & ~np.uint64(_END) | np.arange(n, dtype=np.uint64)
    span = 1
    while span * 2 <= _RUN:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = _RUN - span
    least = np.minimum(least[: len(least) - rest], least[rest:])[: n - LENGTH + 1] if rest else least[: n - LENGTH + 1]
    at = (least & np.uint64(_END)).astype(np.int32)
    begins = np.append(0, ends[:-1])
    valid = np.ones(len(at), dtype=bool)
    for b, e in zip(np.maximum(ends - LENGTH + 1, begins), ends, strict=True):
        valid[b:e] = False
    fresh = np.empty(len(at), dtype=bool)
    fresh[0] = True
    np.not_equal(at[1:], at[:-1], out=fresh[1:])
    fresh[1:] |= valid[1:] != valid[:-1]
    inside = begins[(begins > 0) & (begins < len(at))]
    fresh[inside] = True
    first = np.flatnonzero(fresh)
    count = np.diff(np.append(first, len(at)))
    ok = valid[first]
    first, count = first[ok], count[ok]
    text = np.searchsorted(ends, first, side="right")
    return text, first, count, at[first].astype(np.int64), grams[at[first]]


def _take(data: np.ndarray, first: np.ndarray, width: int) -> np.ndarray:
    """width bytes from each place; data has as many to spare."""
    view = np.ndarray((len(data) - width + 1, width), dtype=np.uint8, buffer=data, strides=(1, 1))
    return view[first]


def suffix_keys(data: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Each run's suffix with zeros up to a common width, its length last."""
    out = np.zeros((len(first), _KEY), dtype=np.uint8)
    length = (count + LENGTH - 1).astype(np.uint8)
    out[:, :_WIDE] = _take(data, first, _WIDE)
    out[:, :_WIDE][np.arange(_WIDE, dtype=np.uint8) >= length[:, None]] = 0
    out[:, -1] = length
    return out.view(f"S{_KEY}").ravel()


def _digest(keys: np.ndarray) -> np.ndarray:
    """A hash of each fixed-width key."""
    words = keys.view("<u8").reshape(len(keys), -1)
    h = np.zeros(len(keys), dtype=np.uint64)
    for i in range(words.shape[1]):
        h = _mix(h + words[:, i] + np.uint64(i * 2 + 1))
    return h


def suffix_array(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys' order as bytes, equal ones by rising ids, and where each group of equals begins in it.

    Eight bytes at a time; later ones are only looked at where the earlier ones agree.
    """
    words = keys.view(">u8").reshape(len(keys), keys.dtype.itemsize // 8)
    order = np.argsort(docs, kind="stable")
    order = order[np.argsort(words[order, 0].astype(np.uint64), kind="stable")]
    ranked = words[order, 0]
    head = np.append(True, ranked[1:] != ranked[:-1])[: len(keys)]
    for k in range(1, words.shape[1]):
        alone = head & np.append(head[1:], True)
        at = np.flatnonzero(~alone)
        if not len(at):
            break
        group = np.cumsum(head[at])
        word = words[order[at], k].astype(np.uint64)
        rank = np.lexsort((word, group))
        order[at] = order[at][rank]
        word = word[rank]
        head[at[1:]] |= word[1:] != word[:-1]
    return order, np.flatnonzero(head)


# ---- blobs between tasks


_FAST = zstandard.ZstdCompressor(level=6)
_OPEN = zstandard.ZstdDecompressor()


def _pack(*arrays: np.ndarray) -> bytes:
    parts = [a.tobytes() for a in arrays]
    return _FAST.compress(struct.pack(f"<{len(parts)}q", *map(len, parts)) + b"".join(parts))


def _planes(x: np.ndarray) -> np.ndarray:
    """First bytes of all values, then second bytes, and so on: high bytes that are mostly alike compress away."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.dtype.itemsize).T)


def _whole(x: np.ndarray) -> np.ndarray:
    """What _planes has taken apart."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(x.dtype.itemsize, len(x)).T).view(x.dtype).ravel()


def _unpack(blob: bytes, kinds: str) -> list[np.ndarray]:
    raw = _OPEN.decompress(blob)
    kind = kinds.split()
    sizes = struct.unpack_from(f"<{len(kind)}q", raw)
    out, at = [], 8 * len(kind)
    for k, s in zip(kind, sizes, strict=True):
        out.append(np.frombuffer(raw, dtype=k, count=s // np.dtype(k).itemsize, offset=at))
        at += s
    return out


def _columns(parts: list[tuple[np.ndarray, ...]]) -> list[np.ndarray]:
    """Tuples of arrays joined kind by kind; parts is emptied, and what is joined is let go at once."""
    kinds = [list(x) for x in zip(*parts, strict=True)]
    parts.clear()
    out = []
    for own in kinds:
        out.append(own[0] if len(own) == 1 else np.concatenate(own))
        own.clear()
    return out


_SUFFIXES = "u1 u1 u1 <u2 <i8 <i8 <i4"  # bytes, windows, anchor - first, document's number (planes); the documents' ids (planes) and row hashes; start (planes)
_SPANS = "<i8 <i8 <i4 <i4"


def _span_blobs(rows: np.ndarray, docs: np.ndarray, start: np.ndarray, stop: np.ndarray, shards: int) -> Iterator[tuple[int, int, bytes]]:
    """Removed stretches by the shard of their row, overlapping ones joined."""
    if not len(rows):
        return
    order = np.lexsort((start, docs, rows))
    rows, docs, start, stop = rows[order], docs[order], start[order].astype(np.int64), stop[order].astype(np.int64)
    other = np.append(True, (rows[1:] != rows[:-1]) | (docs[1:] != docs[:-1]))
    lift = np.cumsum(other) * (np.int64(1) << 40)
    reach = np.maximum.accumulate(stop + lift)
    fresh = other | np.append(True, start[1:] + lift[1:] > reach[:-1])
    at = np.flatnonzero(fresh)
    last = np.append(at[1:], len(rows)) - 1
    rows, docs, start, stop = rows[at], docs[at], start[at], reach[last] - lift[last]
    shard = rows % np.int64(shards)
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.append(True, np.diff(shard[order]) != 0))
    for a, b in zip(cuts, np.append(cuts[1:], len(order)), strict=True):
        own = order[a:b]
        yield int(shard[own[0]]), 0, _pack(rows[own], docs[own], start[own].astype("<i4"), stop[own].astype("<i4"))


# ---- levels


class Levels:
    """A family of sorted arrays of keys with the least id of each; like-sized levels merge."""

    def __init__(self, kind: str):
        self.kind = kind
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def least(self, keys: np.ndarray) -> np.ndarray:
        """Least id that each of the sorted keys has in any level, or the largest integer."""
        best = np.full(len(keys), np.iinfo(np.int64).max)
        for own, ids in self.levels:
            at = np.searchsorted(own, keys)
            at[at == len(own)] = 0
            hit = own[at] == keys
            best[hit] = np.minimum(best[hit], ids[at[hit]])
        return best

    def add(self, keys: np.ndarray, ids: np.ndarray) -> None:
        """keys: sorted and different."""
        if not len(keys):
            return
        self.levels.append((keys, ids))
        while len(self.levels) > 1 and len(self.levels[-2][0]) <= 2 * len(self.levels[-1][0]):
            parts = self.levels[-2:]
            del self.levels[-2:], keys, ids
            keys, ids = _columns(parts)
            order = np.argsort(keys, kind="stable")
            keys, ids = keys[order], ids[order]
            at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            if len(at) < len(keys):
                keys, ids = keys[at], np.minimum.reduceat(ids, at)
            self.levels.append((keys, ids))


def _windows(keys: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every window of each suffix: its key, the suffix's number and the window's place there."""
    count = count.astype(np.int64)
    owner = np.repeat(np.arange(len(keys)), count)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    flat = np.append(np.frombuffer(keys.tobytes(), dtype=np.uint8), np.zeros(LENGTH, dtype=np.uint8))
    wide = (LENGTH + 8) // 8 * 8
    out = np.zeros((len(owner), wide), dtype=np.uint8)
    out[:, :LENGTH] = _take(flat, owner * _KEY + place, LENGTH)
    out[:, -1] = 1
    return out.view(f"S{wide}").ravel(), owner, place


def _may_share(keys: np.ndarray, some: np.ndarray, count: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Which of some suffixes have a window of which half the bytes, next to the anchor, stand in another one of them too."""
    out = np.zeros(len(some), dtype=bool)
    if not len(some):
        return out
    # these bytes lie within a key, so no copy with bytes to spare is needed
    flat, base = keys.view(np.uint8), some * _KEY
    before, count = before[some].astype(np.int64), count[some].astype(np.int64)
    near, far = before - count + 1, before  # bytes before the anchor in the last and the first window
    wide = -(-max(_PROBE, _HALF + GRAM) // 8) * 8
    for own, shift, width in ((np.flatnonzero(near <= _HALF), 0, _PROBE), (np.flatnonzero(far >= _HALF), _HALF, _HALF + GRAM)):
        probe = np.zeros((len(own), wide), dtype=np.uint8)
        probe[:, :width] = _take(flat, base[own] + before[own] - shift, width)
        h = _digest(probe.view(f"S{wide}").ravel()) if len(own) else np.zeros(0, dtype=np.uint64)
        order = np.argsort(h, kind="stable")
        same = h[order][1:] == h[order][:-1]
        twice = np.zeros(len(own), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        out[own[twice]] = True
    return out


def _batch_array(keys: np.ndarray, ids: np.ndarray, family: Levels) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A batch's suffix array, merge-scanned against a family and added to it.

    Returns its order, where equal keys begin in it, the least id that a level has for each of these, and
    the least id that each place of the order has in the family or the batch.
    """
    order, heads = suffix_array(keys, ids)
    ranked = keys[order[heads]]
    known = family.least(ranked)
    least = np.minimum(known, ids[order[heads]])
    family.add(ranked, least)
    return order, heads, known, np.repeat(least, np.diff(np.append(heads, len(order))))


def bucket_spans(keys: np.ndarray, count: np.ndarray, before: np.ndarray, docs: np.ndarray, batch_rows: int = BATCH_ROWS, stored: tuple[np.ndarray, ...] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What a bucket's suffixes lose: numbers of suffixes, and the first and last window lost of each stretch.

    stored: keys, windows and bytes before the anchor of suffixes that count as earlier than all others.
    """
    whole, lost, heads = Levels("suffix"), [], []
    twins: dict[int, list[int]] = {}
    old = 0
    if stored is not None:
        # earlier documents' suffixes stand in front, under an id below all others, and lose nothing
        old = len(stored[0])
        keys, count, before = (np.concatenate([a, b]) for a, b in zip(stored, (keys, count, before), strict=True))
        docs = np.concatenate([np.full(old, np.iinfo(np.int64).min), docs])
    rising = np.argsort(docs, kind="stable")
    for at in range(0, len(rising), batch_rows):
        own = rising[at : at + batch_rows]
        order, first, known, least = _batch_array(keys[own], docs[own], whole)
        ranked = own[order]
        gone = ranked[docs[ranked] > least]
        lost.append((gone, np.zeros(len(gone), dtype=np.int64), count[gone].astype(np.int64) - 1))
        fresh = np.zeros(len(order), dtype=bool)
        fresh[first] = known >= docs[ranked[first]]
        heads.append(ranked[fresh])
        # other places of a suffix in its least document share what its windows lose
        again = np.ones(len(order), dtype=bool)
        again[first] = False
        again &= docs[ranked] == least
        if again.any():
            of = ranked[np.repeat(first, np.diff(np.append(first, len(order))))]
            for h, i in zip(of[again], ranked[again], strict=True):
                twins.setdefault(int(h), []).append(int(i))
    whole.levels.clear()
    heads = np.concatenate(heads) if heads else np.zeros(0, dtype=np.int64)
    partly = heads[_may_share(keys, heads, count, before)]
    partly = partly[np.argsort(docs[partly], kind="stable")]
    dense, at = Levels("window"), 0
    while at < len(partly):
        own, total = partly[at : at + batch_rows], np.cumsum(count[partly[at : at + batch_rows]], dtype=np.int64)
        own = own[: max(1, int(np.searchsorted(total, 4 * batch_rows)))]
        at += len(own)
        window, owner, place = _windows(keys[own], count[own])
        ids = docs[own][owner]
        order, _, _, least = _batch_array(window, ids, dense)
        hit = np.sort(order[least < ids[order]])
        if len(hit):
            step = np.append(True, (owner[hit][1:] != owner[hit][:-1]) | (place[hit][1:] != place[hit][:-1] + 1))
            a = np.flatnonzero(step)
            b = np.append(a[1:], len(hit)) - 1
            some = own[owner[hit[a]]], place[hit[a]], place[hit[b]]
            lost.append(some)
            more = [(t, f, l) for h, f, l in zip(*some, strict=True) for t in twins.get(int(h), ())] if twins else []
            if more:
                lost.append(tuple(np.array(x, dtype=np.int64) for x in zip(*more, strict=True)))
    if not lost:
        return (np.zeros(0, dtype=np.int64),) * 3
    numbers, first, last = (np.concatenate(x).astype(np.int64) for x in zip(*lost, strict=True))
    return numbers - old, first, last


# ---- Spark


_BLOB = "bucket bigint, kind int, payload binary"
_BLOB_FIELDS = ["bucket", "kind", "payload"]


def _blob_batches(rows: Iterator[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def out() -> pa.RecordBatch:
        b, k, p = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(b, pa.int64()), pa.array(k, pa.int32()), pa.array(p, pa.binary())], names=_BLOB_FIELDS)

    for row in rows:
        held.append(row)
        size += len(row[2])
        if size > 4_000_000:
            yield out()
            held, size = [], 0
    if held:
        yield out()


def _sampled(rows: list[tuple[int, int, bytes, int]], base: int) -> tuple[np.ndarray, ...] | None:
    """Keys, text numbers from base on, starts, windows, bytes before the anchor and gram hashes of some texts' suffixes."""
    ends = np.cumsum([len(r[2]) for r in rows])
    data = np.frombuffer(b"".join(r[2] for r in rows) + b"\0" * (_KEY + 16), dtype=np.uint8)
    text, first, count, anchor, gram = anchors(data, ends)
    if not len(first):
        return None
    start = first - np.append(0, ends[:-1])[text] + np.array([r[3] for r in rows], dtype=np.int64)[text]
    return suffix_keys(data, first, count), text + base, start, count.astype(np.uint8), (anchor - first).astype(np.uint8), gram


def _frequent(buckets: int):
    """(gram, n) of the grams that are frequent in a chunk; a null gram has the number of the chunk's suffixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: list[np.ndarray]) -> pa.RecordBatch:
            grams, n = np.unique(np.concatenate(found), return_counts=True)
            often = n >= max(16, n.sum() * max(1 / buckets, 2 * LEAST_SHARE) / 4)
            names = [None, *grams[often].view(np.int64).tolist()]
            return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array([int(n.sum()), *n[often].tolist()], pa.int64())], names=["gram", "n"])

        held, found, size, total = [], [], 0, 0
        for batch in batches:
            for text in batch.column(0):
                for _, _, piece, _ in _pieces_of(0, 0, text.as_py()):
                    held.append(piece)
                    size += len(piece)
                    if size >= PART_BYTES:
                        found.append(_grams(held))
                        total, held, size = total + size, [], 0
                if total >= CHUNK_BYTES:
                    yield out(found)
                    found, total = [], 0
        if held:
            found.append(_grams(held))
        if found:
            yield out(found)

    return run


def _grams(texts: list[bytes]) -> np.ndarray:
    return anchors(np.frombuffer(b"".join(texts) + b"\0" * 16, dtype=np.uint8), np.cumsum([len(t) for t in texts]))[4]


def frequent_grams(rows: DataFrame, buckets: int) -> np.ndarray:
    """Hashes of the grams that would fill more than half a bucket, sorted: at most 1 / LEAST_SHARE."""
    counts = stored(rows.select("data").mapInArrow(lean(_frequent(buckets)), "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")), "frequent-grams")
    total = counts.filter("gram IS NULL").first()
    if total is None:
        return np.zeros(0, dtype=np.uint64)
    least = total.n * max(0.5 / buckets, LEAST_SHARE)
    found = counts.filter("gram IS NOT NULL").filter(F.col("n") >= least).select("gram").collect()
    discard(counts)
    return np.sort(np.array([r.gram for r in found], dtype=np.int64).view(np.uint64))


def _cut(keys: np.ndarray, width: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Parts of suffixes, as keys."""
    flat = np.append(np.frombuffer(keys.tobytes(), dtype=np.uint8), np.zeros(_KEY, dtype=np.uint8))
    out = np.zeros((len(keys), _KEY), dtype=np.uint8)
    out[:, :_WIDE] = _take(flat, np.arange(len(keys)) * _KEY + at, _WIDE)
    out[:, :_WIDE][np.arange(_WIDE) >= width[:, None]] = 0
    out[:, -1] = width
    return out.view(f"S{_KEY}").ravel()


def _halves(keys: np.ndarray, count: np.ndarray, before: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Numbers of the suffixes, keys, windows, bytes before the anchor, bytes left out in front, and a hash of
    the bytes that all windows share: first of the parts behind the anchor, then of those before it."""
    flat = np.append(np.frombuffer(keys.tobytes(), dtype=np.uint8), np.zeros(_KEY, dtype=np.uint8))
    count, before = count.astype(np.int64), before.astype(np.int64)
    skip = np.maximum(0, before - _HALF)
    for own, first, n, shift, width in (
        (np.flatnonzero(count > skip), skip, count - skip, 0, _PROBE),
        (np.flatnonzero(skip > 0), np.zeros_like(skip), np.minimum(count, skip), _HALF + 1, _HALF + 1 + GRAM),
    ):
        wide = -(-width // 8) * 8
        probe = np.zeros((len(own), wide), dtype=np.uint8)
        probe[:, :width] = _take(flat, own * _KEY + before[own] - shift, width)
        shared = _digest(probe.view(f"S{wide}").ravel()) if len(own) else np.zeros(0, dtype=np.uint64)
        yield own, _cut(keys[own], n[own] + LENGTH - 1, first[own]), n[own].astype(np.uint8), (before - first)[own].astype(np.uint8), first[own], shared


def _suffix_blobs(buckets: int, shards: int, frequent: np.ndarray):
    """Map side: kind 1 are suffixes by bucket, kind 0 stretches that copies within the chunk lose."""

    def chunk(rows: list[tuple[int, int, bytes, int]]) -> Iterator[tuple[int, int, bytes]]:
        ids = np.array([r[0] for r in rows], dtype=np.int64)
        hashes = np.array([r[1] for r in rows], dtype=np.int64)
        found, at = [], 0
        while at < len(rows):
            to, size = at, 0
            while to < len(rows) and (to == at or size + len(rows[to][2]) <= PART_BYTES):
                size += len(rows[to][2])
                to += 1
            found.append(_sampled(rows[at:to], at))
            at = to
        found = [x for x in found if x]
        if not found:
            return
        keys, text, start, count, before, gram = _columns(found)
        order, heads = suffix_array(keys, ids[text])
        head = np.repeat(order[heads], np.diff(np.append(heads, len(order))))
        copy = order[ids[text[order]] > ids[text[head]]]
        yield from _span_blobs(hashes[text[copy]], ids[text[copy]], start[copy], start[copy] + count[copy].astype(np.int64) + LENGTH - 1, shards)
        left = order[ids[text[order]] == ids[text[head]]]
        wide = np.isin(gram[left], frequent)
        split = [(left[~wide], keys[left[~wide]], count[left[~wide]], before[left[~wide]], start[left[~wide]], _mix(gram[left[~wide]]))]
        left = left[wide]
        for own, part, n, ahead, skipped, shared in _halves(keys[left], count[left], before[left]) if len(left) else ():
            split.append((left[own], part, n, ahead, start[left[own]] + skipped, _mix(shared)))
        del keys
        left, keys, count, before, start, dealt = _columns(split)
        text = text[left]
        bucket = (dealt % np.uint64(buckets)).astype(np.int64)
        left = np.argsort(bucket, kind="stable")
        bucket = bucket[left]
        cuts = np.flatnonzero(np.append(True, np.diff(bucket) != 0))
        flat = keys.view(np.uint8).reshape(-1, _KEY)
        wide = np.arange(_WIDE)
        for a, b in zip(cuts, np.append(cuts[1:], len(left)), strict=True):
            own = left[a:b]
            own = own[np.argsort(start[own] + text[own] * (np.int64(1) << 32))]
            texts, number = np.unique(text[own], return_inverse=True)
            packed = flat[own][:, :_WIDE][wide < flat[own][:, -1][:, None]]
            yield int(bucket[a]), 1, _pack(packed, count[own], before[own], _planes(number.astype("<u2")), _planes(ids[texts]), hashes[texts], _planes(start[own].astype("<i4")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple[int, int, bytes]]:
            held, size = [], 0
            for batch in batches:
                for i in range(batch.num_rows):
                    for piece in _pieces_of(*(batch.column(k)[i].as_py() for k in range(3))):
                        if held and (size + len(piece[2]) > CHUNK_BYTES or len(held) >= 60_000):
                            yield from chunk(held)
                            held, size = [], 0
                        held.append(piece)
                        size += len(piece[2])
            if held:
                yield from chunk(held)

        return _blob_batches(each())

    return run


def _pieces_of(doc: int, row: int, data: bytes) -> Iterator[tuple[int, int, bytes, int]]:
    """A text in pieces that fit a chunk's 24-bit places; every window lies in one of them."""
    for at in range(0, len(data), 4 * PART_BYTES):
        piece = data[at : at + 4 * PART_BYTES + LENGTH - 1]
        if len(piece) >= LENGTH:
            yield doc, row, piece, at


_LEVEL = "u1 u1 u1"  # bytes, windows, anchor - first


def _laid_out(data: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Keys of suffixes whose bytes lie end to end."""
    keys = np.zeros((len(count), _KEY), dtype=np.uint8)
    length = count + np.uint8(LENGTH - 1)
    keys[:, :_WIDE][np.arange(_WIDE, dtype=np.uint8) < length[:, None]] = data
    keys[:, -1] = length
    return keys.view(f"S{_KEY}").ravel()


def _end_to_end(keys: np.ndarray) -> np.ndarray:
    flat = keys.view(np.uint8).reshape(-1, _KEY)
    return flat[:, :_WIDE][np.arange(_WIDE) < flat[:, -1][:, None]]


def _level_of(blobs: list[bytes]) -> tuple[np.ndarray, ...] | None:
    """Keys, windows and bytes before the anchor of a bucket's stored suffixes, sorted and different."""
    if not blobs:
        return None
    data, count, before = (np.concatenate(x) for x in zip(*(_unpack(b, _LEVEL) for b in blobs), strict=True))
    keys = _laid_out(data, count)
    order, heads = suffix_array(keys, np.zeros(len(keys), dtype=np.int64))
    order = order[heads]
    return keys[order], count[order], before[order]


def _bucket_runs(shards: int, level: bool = False):
    """Reduce side: a bucket's suffixes in, stretches to remove out. level: stored suffixes come along (kind -1), and those that they lack go out (kind 3)."""

    def solve(bucket: int, blobs: list[bytes], old: list[bytes]) -> Iterator[tuple[int, int, bytes]]:
        parts = []
        for i, blob in enumerate(blobs):
            data, count, before, number, ids, hashes, start = _unpack(blob, _SUFFIXES)
            blobs[i], number = b"", _whole(number)
            parts.append((_laid_out(data, count), count.copy(), before.copy(), _whole(start), _whole(ids)[number], hashes[number]))
            del data, count, before, number, ids, hashes, start  # they hold the whole blob
        blobs.clear()
        keys, count, before, start, docs, rows = _columns(parts)
        known = _level_of(old)
        own, first, last = bucket_spans(keys, count, before, docs, BATCH_ROWS, known)
        yield from _span_blobs(rows[own], docs[own], start[own] + first, start[own] + last + LENGTH, shards)
        if level:
            order, heads = suffix_array(keys, docs)
            new = order[heads]
            if known is not None:
                new = new[~np.isin(keys[new], known[0])]
            if len(new):
                yield bucket, 3, _pack(_end_to_end(keys[new]), count[new], before[new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple[int, int, bytes]]:
            now, held, old = None, [], []
            for batch in batches:
                for b, kind, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                    if kind == 0:
                        yield b, 0, p.as_py()
                        continue
                    if b != now:
                        if held:
                            yield from solve(now, held, old)
                        now, held, old = b, [], []
                    (held if kind == 1 else old).append(p.as_py())
            if held:
                yield from solve(now, held, old)

        return _blob_batches(each())

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Levels' blobs of each bucket, merged into one."""

    def each() -> Iterator[tuple[int, int, bytes]]:
        now, held = None, []
        for batch in batches:
            for b, p in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                if b != now and held:
                    keys, count, before = _level_of(held)
                    yield now, 3, _pack(_end_to_end(keys), count, before)
                    held = []
                now = b
                held.append(p.as_py())
        if held:
            keys, count, before = _level_of(held)
            yield now, 3, _pack(_end_to_end(keys), count, before)

    return _blob_batches(each())


_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
_TEXTS = "u1 <i8 <i8 <i8 u1 u1"  # whether there is an id, ids, row hashes, lengths, the bytes end to end; what is carried along


def _text_blobs(shards: int):
    """Whole rows by shard, kind 2. What they carry along stays an Arrow column."""

    def chunk(rows: list[tuple[int | None, int, bytes]], carried: list[pa.Array]) -> Iterator[tuple[int, int, bytes]]:
        shard = np.array([r[1] for r in rows], dtype=np.int64) % shards
        order = np.argsort(shard, kind="stable")
        cuts = np.flatnonzero(np.append(True, np.diff(shard[order]) != 0))
        rest = pa.concat_arrays(carried)
        for a, b in zip(cuts, np.append(cuts[1:], len(order)), strict=True):
            own = [rows[i] for i in order[a:b]]
            numbers = (np.array([f(r) for r in own], dtype=np.int64) for f in (lambda r: r[0] or 0, lambda r: r[1], lambda r: len(r[2])))
            named = np.array([r[0] is not None for r in own], dtype=np.uint8)
            yield int(shard[order[a]]), 2, _pack(named, *numbers, np.frombuffer(b"".join(r[2] for r in own), dtype=np.uint8), _column_bytes(rest.take(pa.array(order[a:b]))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple[int, int, bytes]]:
            held, carried, size = [], [], 0
            for batch in batches:
                begun = 0
                for i in range(batch.num_rows):
                    held.append(tuple(batch.column(k)[i].as_py() for k in range(3)))
                    size += len(held[-1][2])
                    if size > CHUNK_BYTES or i == batch.num_rows - 1:
                        carried.append(batch.column(3).slice(begun, i + 1 - begun))
                        begun = i + 1
                    if size > CHUNK_BYTES:
                        yield from chunk(held, carried)
                        held, carried, size = [], [], 0
            if held:
                yield from chunk(held, carried)

        return _blob_batches(each())

    return run


def _column_bytes(column: pa.Array) -> np.ndarray:
    out = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([column], names=["rest"])
    with pa.ipc.new_stream(out, batch.schema) as stream:
        stream.write_batch(batch)
    return np.frombuffer(out.getvalue(), dtype=np.uint8)


def _column_of(raw: np.ndarray) -> pa.Array:
    with pa.ipc.open_stream(pa.py_buffer(raw.tobytes())) as stream:
        return stream.read_next_batch().column(0)


def _apply_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's stretches come first, then its rows."""
    now, blobs, lost = None, [], None
    for batch in batches:
        for b, kind, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            if b != now:
                now, blobs, lost = b, [], None
            if kind == 0:
                blobs.append(payload.as_py())
                continue
            if lost is None:
                parts = [_unpack(x, _SPANS) for x in blobs]
                table = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, dtype=np.int64) for i in range(4)]
                order = np.lexsort((table[2], table[1], table[0]))
                lost = [x[order] for x in table]
                blobs, parts, table = [], [], []
            named, ids, rows, sizes, data, rest = _unpack(payload.as_py(), _TEXTS)
            docs = [i if n else None for i, n in zip(ids.tolist(), named.tolist(), strict=True)]
            cut = [[{"start": a, "stop": b} for a, b in _stretches(lost, d, r)] for d, r in zip(docs, rows.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(_slices(data, sizes), pa.binary()), pa.array(cut, _SPAN), _column_of(rest)], names=["doc_id", "data", "spans", "rest"])


def _slices(data: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    raw, ends = data.tobytes(), np.cumsum(sizes)
    return [raw[e - n : e] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]


def _stretches(lost: list[np.ndarray], doc: int | None, row: int) -> list[tuple[int, int]]:
    """The maximal stretches that a row loses."""
    out: list[tuple[int, int]] = []
    for i in range(int(np.searchsorted(lost[0], row)), int(np.searchsorted(lost[0], row, side="right"))):
        if doc is not None and lost[1][i] == doc:
            a, b = int(lost[2][i]), int(lost[3][i])
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], max(out[-1][1], b))
            else:
                out.append((a, b))
    return out


SPANS = "doc_id bigint, data binary, spans array<struct<start:int,stop:int>>"


def _rows_of(docs: DataFrame, rest: Column) -> tuple[DataFrame, int]:
    """(doc_id, row_hash, data, rest) of every row of docs(doc_id, text), and the number of buckets."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("data"), rest.alias("rest"))
    rows = rows.select("doc_id", F.xxhash64("doc_id", "data").alias("row_hash"), "data", "rest")
    total = rows.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    return rows, max(12, total // BUCKET_BYTES)


def spans(docs: DataFrame, carry: list[str] | None = None, then: Callable[[Iterator], Iterator] | None = None, ddl: str = SPANS) -> DataFrame:
    """(doc_id, data, spans, rest) of every row of docs(doc_id, text): UTF-8 bytes, and stretches to remove.

    rest is a struct of the columns to carry, so that no join has to bring them back; without any it is a
    null. then: a function of the batches that goes on in the same Python worker, whose rows (ddl, and rest
    behind it where there are columns to carry) are returned instead.
    """
    rows, buckets = _rows_of(docs, F.struct(*carry) if carry else F.lit(None).cast("int"))
    named = rows.filter("doc_id IS NOT NULL").select("doc_id", "row_hash", "data")
    suffixes = named.mapInArrow(lean(_suffix_blobs(buckets, buckets, frequent_grams(named, buckets))), _BLOB)
    lost = suffixes.repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(lean(_bucket_runs(buckets)), _BLOB)
    texts = rows.mapInArrow(lean(_text_blobs(buckets)), _BLOB)
    both = lost.unionByName(texts).repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind")
    schema = T.StructType.fromDDL(ddl)
    if carry or then is None:
        schema = schema.add("rest", rows.schema["rest"].dataType)
    return both.mapInArrow(lean(_apply_spans if then is None else lambda batches: then(_apply_spans(batches))), schema)


def _kept(data: bytes, cut: list[dict]) -> bytes:
    out, at = [], 0
    for s in cut:
        out.append(data[at : s["start"]])
        at = s["stop"]
    return b"".join([*out, data[at:]])


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, data, cut in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                data = data.as_py()
                rows.append((doc, len(data), sum(s["stop"] - s["start"] for s in cut), len(cut), hashlib.sha256(_kept(data, cut)).hexdigest()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return spans(docs, None, run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def _texts_left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, rest) of batches of _apply_spans, without the rows that lose all their bytes."""
    for batch in batches:
        cut = batch.column(2).to_pylist()
        texts = [_kept(d.as_py(), s).decode("utf-8", "ignore") for d, s in zip(batch.column(1), cut, strict=True)]
        kept = [i for i, t in enumerate(texts) if t or not cut[i]]
        at = pa.array(kept, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array([texts[i] for i in kept], pa.string()), batch.column(3).take(at)], names=["doc_id", "text", "rest"])


def _texts_alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _texts_left(batches):
        yield batch.select(["doc_id", "text"])


def remove(docs: DataFrame) -> DataFrame:
    """docs with the text that is left of every row; bytes of split code points are left out.

    Rows that lose all their bytes go. A null text becomes an empty one, and doc_id a long.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    left = spans(docs, others, _texts_left if others else _texts_alone, "doc_id bigint, text string")
    return left.select(*(F.col(c) if c in ("doc_id", "text") else F.col("rest")[c].alias(c) for c in docs.columns))


class SuffixIndex:
    """A family of stored levels that batches of documents are scanned against and added to.

    Each level is a table of one sorted array of suffixes for each bucket. The buckets and the frequent
    grams are those of the first batch. Documents of earlier batches count as earlier than all of a later
    batch, whatever their ids; within a batch ids decide. A failed ``add`` leaves the index as it was.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.state = None
        if table_exists(spark, f"{self.path}/state"):
            self.state = spark.read.parquet(f"{self.path}/state").orderBy(F.desc("generation")).first().asDict()

    @property
    def level_rows(self) -> list[int]:
        """Suffixes of each level, the oldest first."""
        return list(self.state["n_suffixes"]) if self.state else []

    def add(self, docs: DataFrame) -> DataFrame:
        """docs without what the index or the batch holds already, as by ``remove``; the batch joins the index."""
        others = [c for c in docs.columns if c not in ("doc_id", "text")]
        rows, buckets = _rows_of(docs, F.struct(*others) if others else F.lit(None).cast("int"))
        named = rows.filter("doc_id IS NOT NULL").select("doc_id", "row_hash", "data")
        if self.state is None:
            self.state = {"generation": 0, "buckets": buckets, "grams": frequent_grams(named, buckets).view(np.int64).tolist(), "levels": [], "n_suffixes": []}
        state = dict(self.state)
        buckets, grams = state["buckets"], np.array(state["grams"], dtype=np.int64).view(np.uint64)
        blobs = named.mapInArrow(lean(_suffix_blobs(buckets, buckets, grams)), _BLOB)
        for level in state["levels"]:
            blobs = blobs.unionByName(self.spark.read.parquet(f"{self.path}/{level}").withColumn("kind", F.lit(-1)))
        found = stored(blobs.repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(lean(_bucket_runs(buckets, True)), _BLOB), "suffix-spans")
        levels, sizes = list(state["levels"]), list(state["n_suffixes"])
        levels, sizes = [*levels, name := self._write(found.filter("kind = 3"))], [*sizes, self._size(name)]
        while len(levels) > 1 and sizes[-2] <= 2 * sizes[-1]:
            both = self.spark.read.parquet(*(f"{self.path}/{x}" for x in levels[-2:]))
            name = self._write(both.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(lean(_merged), _BLOB))
            levels[-2:], sizes[-2:] = [name], [self._size(name)]
        state |= {"generation": state["generation"] + 1, "levels": levels, "n_suffixes": sizes}
        kind = "generation bigint, buckets bigint, grams array<bigint>, levels array<string>, n_suffixes array<bigint>"
        self.spark.createDataFrame([state], kind).coalesce(1).write.mode("append").parquet(f"{self.path}/state")
        for gone in set(self.state["levels"]) - set(levels):
            drop_path(self.spark, f"{self.path}/{gone}")
        self.state = state
        texts = rows.mapInArrow(lean(_text_blobs(buckets)), _BLOB)
        both = found.filter("kind = 0").unionByName(texts).repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind")
        schema = T.StructType.fromDDL("doc_id bigint, text string").add("rest", rows.schema["rest"].dataType)
        left = both.mapInArrow(lean(lambda batches: _texts_left(_apply_spans(batches))), schema)
        return left.select(*(F.col(c) if c in ("doc_id", "text") else F.col("rest")[c].alias(c) for c in docs.columns))

    def _write(self, blobs: DataFrame) -> str:
        name = f"level-{uuid.uuid4().hex}"
        blobs.write.parquet(f"{self.path}/{name}")
        return name

    def _size(self, level: str) -> int:
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([len(_unpack(p.as_py(), _LEVEL)[1]) for p in batch.column(0)], pa.int64())], names=["n"])

        return self.spark.read.parquet(f"{self.path}/{level}").select("payload").mapInArrow(count, "n bigint").agg(F.sum("n")).first()[0] or 0
