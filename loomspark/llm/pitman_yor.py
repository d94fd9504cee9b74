"""Hierarchical Pitman-Yor language model of word pairs, trained and applied as one dataflow.

Each word that occurs as a context is a restaurant whose customers are the words that follow it in
training texts; all of them share one parent, the restaurant of single words, which falls back to the
uniform distribution over the training vocabulary and one unknown word. A customer sits at a table of its
dish or opens one; opened tables are customers of the parent. With t tables for the c customers of a dish,

    P(w | u) = (c_uw - d t_uw) / (h + c_u) + (h + d t_u) / (h + c_u) * P(w)

Gibbs sweeps draw the seating of one dish after the other. All seatings with the same number of tables
predict the same, so a dish's tables are drawn at once from their exact conditional distribution: given the
weight f of a new table it is proportional to f^t S_d(c, t), with the generalised Stirling numbers S_d that
count the seatings. The restaurant's total enters f by a gamma variable, which makes its dishes
independent. The probability of a token is the average of its predictive probabilities under the seatings
of the sweeps after the burn-in.

The work is dealt out by the predicted word's hash, so a word's whole parent dish, its training count and
all its contexts lie in one bucket, and a frequent context's dishes are spread over all buckets. Words of
more than half a bucket's share of the tokens are spread over several buckets by their contexts. During
the sweeps a bucket estimates the other dishes' tables in a restaurant from its own part of them, which is
a hashed share, without the dish that is drawn; the totals that the probabilities use are summed over all
buckets for each sweep, so each P(. | u) sums to one. Each level has one discount and one strength.

Words are known by 64-bit hashes, as contexts by 48 bits of them. Everything that is gathered grows with
the corpus and stays on the executors; only the model's few totals and the spread words (at most
1 / LEAST_SHARE) are sent to all of them.

Defined results: a null text is empty: it has the end token alone. A null doc_id hashes as the empty
string, so such rows train. Repeated rows are counted and scored row by row. Without training rows every
token has the probability 1 / (V + 1) = 1. An empty table gives an empty result. Further columns are not
read.
"""

import struct
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored

FOLDS, HELD_OUT = 7, 2
SWEEPS, BURN_IN = 7, 3
KEPT = SWEEPS - BURN_IN
#: Strength and discount of the contexts' restaurants and of the parent.
STRENGTH, PARENT_STRENGTH = 1.0, 1.0
DISCOUNT, PARENT_DISCOUNT = 0.75, 0.75
CHUNK_BYTES = 8_000_000
CHUNK_DOCS = 60_000
BUCKET_BYTES = 12_000_000
#: Customers up to which Stirling numbers are tabled; beyond, those of so many are scaled.
TABLED = 512
#: Numbers of tables that are weighed for a dish of many customers.
WINDOW = 48

END = 0x5851F42D4C957F2D
_U48 = (1 << 48) - 1
_ZIP = zstandard.ZstdCompressor(level=3)
_UNZIP = zstandard.ZstdDecompressor()

ROW = "bucket bigint, kind int, source bigint, payload binary"
_SCHEMA = pa.schema([("bucket", pa.int64()), ("kind", pa.int32()), ("source", pa.int64()), ("payload", pa.binary())])
_TOTALS = pa.schema([*((f"{name}{k}", pa.float64()) for name in ("customers", "tables") for k in range(KEPT)), ("tokens", pa.int64()), ("words", pa.int64())])
_TOTAL = f"<{2 * KEPT}dqq"
TOTALS = ", ".join(f"{f.name} {'double' if f.type == pa.float64() else 'bigint'}" for f in _TOTALS)
PAIRS, DOCS, ASKED, COUNTS, TOTAL, TOLD, SUMS, WORDS, TOLD_WORDS = range(9)
#: Least share of all tokens that spreads a word; so at most this many words' hashes are sent to all tasks.
LEAST_SHARE = 1e-5
#: Base scores are summed as whole multiples of this, exactly in any order.
UNIT = 2.0**-30


def _pack(*arrays: np.ndarray) -> bytes:
    parts = [np.ascontiguousarray(a).tobytes() for a in arrays]
    return _ZIP.compress(struct.pack(f"<{len(parts)}q", *map(len, parts)) + b"".join(parts))


def _unpack(blob: bytes, kinds: str) -> list[np.ndarray]:
    raw, kind, at, out = _UNZIP.decompress(blob), kinds.split(), 0, []
    sizes = struct.unpack_from(f"<{len(kind)}q", raw)
    at = 8 * len(kind)
    for k, s in zip(kind, sizes, strict=True):
        out.append(np.frombuffer(raw, dtype=k, count=s // np.dtype(k).itemsize, offset=at))
        at += s
    return out


def _rows(rows: Iterator[tuple], most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[3])
        if size > most:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(rows: list[tuple], schema: pa.Schema = _SCHEMA) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _by_bucket(batches: Iterator[pa.RecordBatch], columns: tuple[int, ...] = (1, 2, 3)) -> Iterator[tuple[int, list[tuple]]]:
    """The rows of each bucket; a partition's rows are sorted by it."""
    now, held = None, []
    for batch in batches:
        buckets = batch.column(0).to_pylist()
        own = [batch.column(i) for i in columns]
        for i, b in enumerate(buckets):
            if b != now and held:
                yield now, held
                held = []
            now = b
            held.append(tuple(c[i].as_py() for c in own))
    if held:
        yield now, held


def _bytes_apart(x: np.ndarray) -> np.ndarray:
    """First bytes of all values, then second bytes, and so on: high bytes that are mostly zero compress away."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T)


def _together(x: np.ndarray) -> np.ndarray:
    """What _bytes_apart has taken apart."""
    kind = x.dtype
    return np.ascontiguousarray(x.view(np.uint8).reshape(kind.itemsize, -1).T).view(kind).ravel()


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


def words(text: bytes) -> list[bytes]:
    """Words of UTF-8 text: A-Z lower-cased, split at ASCII white space."""
    return text.lower().split()


# ---- texts to word pairs

_PAIRS = "<u8 <u4 <u2 <u4 <u4 <u4 <u4 <u2 <u4"  # words; pairs of each; contexts' low and high bits; context, training count and texts of each pair; texts; times


def _frequent(buckets: int):
    """(hash, n) of the words of training texts that are frequent in a chunk; a null hash has the chunk's tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size, total = Counter(), 0, 0

        def out() -> pa.RecordBatch:
            least = max(16, total * max(1 / buckets, 2 * LEAST_SHARE) / 4)
            rows = [(None, total), *((_signed(xxhash.xxh3_64_intdigest(w) if w else END), n) for w, n in found.items() if n >= least)]
            return pa.RecordBatch.from_arrays([pa.array([h for h, _ in rows], pa.int64()), pa.array([n for _, n in rows], pa.int64())], names=["hash", "n"])

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                if held_out(doc.as_py()):
                    continue
                own = words(text.as_py())
                found.update(own)
                found[b""] += 1
                total += len(own) + 1
                size += len(text.as_py())
                if size > CHUNK_BYTES:
                    yield out()
                    found, size, total = Counter(), 0, 0
        if total:
            yield out()

    return run


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


class Spread:
    """Over how many buckets each frequent word's pairs are dealt out."""

    def __init__(self, buckets: int, shares: dict[int, float]):
        self.hashes = np.array(sorted(shares), dtype=np.uint64)
        self.parts = np.array([min(buckets, max(2, -int(-2 * shares[h] * buckets // 1))) for h in sorted(shares)], dtype=np.int64)
        self.buckets = buckets

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """Number of buckets of each word."""
        out = np.ones(len(hashes), dtype=np.int64)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            hit = self.hashes[at] == hashes
            out[hit] = self.parts[at[hit]]
        return out

    def bucket(self, word: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Bucket of each pair of word hashes."""
        home, parts = (word % np.uint64(self.buckets)).astype(np.int64), self.of(word)
        wide = parts > 1
        mixed = (context[wide] & np.uint64(_U48)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
        home[wide] = (home[wide] + (mixed % parts[wide].astype(np.uint64)).astype(np.int64)) % self.buckets
        return home


def spread_words(rows: DataFrame, buckets: int) -> Spread:
    """The words to spread: at most 1 / LEAST_SHARE of them."""
    counts = stored(rows.mapInArrow(_frequent(buckets), "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("n")), "frequent-words")
    total = counts.filter("hash IS NULL").first()
    if total is None:
        return Spread(buckets, {})
    least = total.n * max(0.5 / buckets, LEAST_SHARE)
    found = {r.hash % (1 << 64): r.n / total.n for r in counts.filter("hash IS NOT NULL").filter(F.col("n") >= least).collect()}
    discard(counts)
    return Spread(buckets, found)


def _pair_blobs(buckets: int, spread: Spread):
    """Each chunk's word pairs by their bucket, and its texts' ids."""

    def chunk(rows: list[tuple[int | None, bytes]], number: int) -> Iterator[tuple]:
        code: dict[bytes, int] = {}
        split = [words(t) for _, t in rows]
        for w in set().union(*split):
            code[w] = len(code)
        n = len(code)
        sizes = np.array([len(s) + 1 for s in split], dtype=np.int64)
        tokens = np.empty(int(sizes.sum()), dtype=np.int64)
        at = 0
        for s in split:
            tokens[at : at + len(s)] = np.fromiter(map(code.__getitem__, s), dtype=np.int64, count=len(s))
            tokens[at + len(s)] = n
            at += len(s) + 1
        del split
        hashes = np.array([*map(xxhash.xxh3_64_intdigest, code), END], dtype=np.uint64)
        ranked = np.argsort(hashes)
        rank = np.empty(n + 1, dtype=np.uint64)
        rank[ranked] = np.arange(n + 1, dtype=np.uint64)
        hashes = hashes[ranked]
        doc = np.repeat(np.arange(len(rows), dtype=np.uint64), sizes)
        second = rank[tokens]
        first = np.empty_like(second)
        first[1:] = second[:-1]
        first[np.cumsum(sizes) - sizes] = rank[n]
        key = np.sort(second << np.uint64(40) | first << np.uint64(16) | doc)
        heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        times = np.diff(np.append(heads, len(key))).astype(np.uint32)
        key = key[heads]
        doc = (key & np.uint64(0xFFFF)).astype(np.int64)
        trains = np.array([not held_out(i) for i, _ in rows])
        pair = key >> np.uint64(16)
        at = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
        n_docs = np.diff(np.append(at, len(pair))).astype(np.uint32)
        trained = np.add.reduceat(times * trains[doc], at).astype(np.uint32)
        pair = pair[at]
        second, first = (pair >> np.uint64(24)).astype(np.int64), (pair & np.uint64(0xFFFFFF)).astype(np.int64)
        bucket = spread.bucket(hashes[second], hashes[first])
        order = np.argsort(bucket, kind="stable")
        bucket, second, first, trained = bucket[order], second[order], first[order], trained[order]
        n_docs = n_docs[order]
        many = n_docs.astype(np.int64)
        moved = np.repeat(at[order], many)
        at = np.cumsum(many) - many
        moved += np.arange(len(doc)) - np.repeat(at, many)
        doc, times = doc[moved], times[moved]
        cuts = np.flatnonzero(np.append(True, np.diff(bucket) != 0))
        for a, b in zip(cuts, np.append(cuts[1:], len(second)), strict=True):
            own, each = np.unique(second[a:b], return_counts=True)
            used, context = np.unique(first[a:b], return_inverse=True)
            used = hashes[used]
            lo, hi = int(at[a]), int(at[b]) if b < len(at) else len(doc)
            yield (
                int(bucket[a]), PAIRS, number,
                _pack(
                    hashes[own], each.astype("<u4"), (used & np.uint64(0xFFFF)).astype("<u2"), (used >> np.uint64(16) & np.uint64(0xFFFFFFFF)).astype("<u4"),
                    _bytes_apart(context.astype("<u4")), _bytes_apart(trained[a:b]), _bytes_apart(n_docs[a:b]), doc[lo:hi].astype("<u2"), _bytes_apart(times[lo:hi]),
                ),
            )
        ids = np.array([i or 0 for i, _ in rows], dtype=np.int64)
        yield number % buckets, DOCS, number, _pack(ids, np.array([i is not None for i, _ in rows], dtype=np.uint8), sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        def each() -> Iterator[tuple]:
            task = TaskContext.get()
            number, held, size = (task.partitionId() if task else 0) << 32, [], 0
            for batch in batches:
                for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                    held.append((doc.as_py(), text.as_py()))
                    size += len(held[-1][1])
                    if size > CHUNK_BYTES or len(held) >= CHUNK_DOCS:
                        yield from chunk(held, number)
                        number, held, size = number + 1, [], 0
            if held:
                yield from chunk(held, number)

        return _rows(each())

    return run


# ---- seating


@lru_cache(maxsize=4)
def _stirling(discount: float) -> tuple[np.ndarray, np.ndarray]:
    """Logarithms of S_d(c, t) up to TABLED customers, and of the last row's S_d(c, t) Gamma(t) d^t, from t = 0 on."""
    table = np.full((TABLED + 1, TABLED + 2), -np.inf)
    table[1, 1] = 0.0
    t = np.arange(TABLED + 2)
    for c in range(1, TABLED):
        some = t[1 : c + 2]
        stay = np.log(np.maximum(c - discount * some, 1e-300)) + table[c, 1 : c + 2]
        table[c + 1, 1 : c + 2] = np.logaddexp(table[c, : c + 1], stay)
    logs = np.log(np.maximum(t, 1))
    last = (table[TABLED] + np.cumsum(logs) - logs + t * np.log(discount))[1:-1]
    return table, np.append(2 * last[0] - last[1], last)  # carried on straight to 0 tables


def _log_ways(customers: np.ndarray, tables: np.ndarray, discount: float) -> np.ndarray:
    """log S_d(c, t) but for a constant of c; the arrays go together.

    S_d(c, t) = c! / (t! d^t) P(X_1 + .. + X_t = c) for Sibuya variables X, whose sums scale like stable
    ones: beyond TABLED customers P / t depends on t / c^d, and is read off the last row there.
    """
    table, last = _stirling(discount)
    c, t = np.broadcast_arrays(customers, tables)
    out = np.full(c.shape, -np.inf)
    ok = (t >= 1) & (t <= c)
    near = ok & (c <= TABLED)
    out[near] = table[c[near], t[near]]
    far = ok & (c > TABLED)
    if far.any():
        n = t[far].astype(np.float64)
        at = n * (TABLED / c[far]) ** discount
        out[far] = np.interp(at, np.arange(TABLED + 1), last, right=-np.inf) - gammaln(n) - n * np.log(discount)
    return out


def gammaln(x: np.ndarray) -> np.ndarray:
    """log Gamma for x >= 1, by Stirling's series behind a shift."""
    y = x + 7
    product = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6)
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) - np.log(product)


def draw_tables(customers: np.ndarray, fresh: np.ndarray, discount: float, rng: np.random.Generator, above: tuple[np.ndarray, np.ndarray, float] | None = None) -> np.ndarray:
    """Numbers of tables t of dishes with c customers, drawn with weights w_1 .. w_t S_d(c, t).

    fresh: w_1, the weight of the first table, and of all others unless above is given: a factor g, a mass a
    and a total n, by which the i-th table, a further customer of the dish in the parent, weighs
    g (a + i - 1) / (n + i - 1). Small dishes weigh every t, others those around the most likely one, in
    steps where that spread is wide.
    """
    customers = customers.astype(np.int64)
    out = np.minimum(customers, 1)
    first = np.log(np.maximum(fresh, 1e-300))
    later = first if above is None else np.log(np.maximum(above[0], 1e-300))

    def choose(logs: np.ndarray) -> np.ndarray:
        odds = np.cumsum(np.exp(logs - logs.max(axis=1, keepdims=True)), axis=1)
        return np.minimum((odds <= (rng.random(len(odds)) * odds[:, -1])[:, None]).sum(axis=1), logs.shape[1] - 1)

    def weights(of: np.ndarray, t: np.ndarray) -> np.ndarray:
        """log w_1 .. w_t."""
        of = of if t.ndim == 1 else of[:, None]
        total = first[of] + (t - 1) * later[of]
        if above is not None:
            a, n = above[1][of], above[2]
            total = total + gammaln(a + t) - gammaln(a + 1) - (t - 1) * (np.log(n + 1) + (t - 2) / (2 * (n + 1)))
        return total

    two = np.flatnonzero(customers == 2)
    second = np.exp(later[two]) * (1 if above is None else (above[1][two] + 1) / (above[2] + 1))
    out[two] += rng.random(len(two)) * (second + 1 - discount) < second
    few = np.flatnonzero((customers > 2) & (customers <= 8))
    if len(few):
        logs = np.repeat(later[few, None], 8, axis=1)
        logs[:, 0] = first[few]
        if above is not None:
            i = np.arange(1, 8)
            logs[:, 1:] += np.log((above[1][few, None] + i) / (above[2] + i))
        out[few] = 1 + choose(_stirling(discount)[0][customers[few], 1:9] + np.cumsum(logs, axis=1))
    rest = np.flatnonzero(customers > 8)
    for begin in range(0, len(rest), 10_000):
        many = rest[begin : begin + 10_000]
        c = customers[many]
        low, high = np.ones_like(c), c.copy()
        while (low < high).any():  # the weights rise to one peak
            middle = (low + high) // 2
            up = _log_ways(c, middle + 1, discount) + weights(many, middle + 1) > _log_ways(c, middle, discount) + weights(many, middle)
            low, high = np.where(up & (low < high), middle + 1, low), np.where(up, high, np.maximum(middle, low))
        step = np.maximum(1, np.ceil(12 * (np.sqrt(low) + 1) / WINDOW)).astype(np.int64)
        t = np.maximum(low - step * (WINDOW // 2), 1)[:, None] + step[:, None] * np.arange(WINDOW)
        chosen = choose(_log_ways(c[:, None], t, discount) + weights(many, t))
        drawn = t[np.arange(len(many)), chosen] + ((rng.random(len(many)) - 0.5) * (step - 1)).round().astype(np.int64)
        out[many] = np.clip(drawn, 1, c)
    return out


def sample(word: np.ndarray, context: np.ndarray, counts: np.ndarray, factor: np.ndarray, n_contexts: int, share: int, n_spread: int, seed: int) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """For each sweep kept: tables of each pair, and customers and tables of each word's dish in the parent.

    word, context, counts: of each pair with training customers. factor: the buckets over which each word
    is spread; share: the number of buckets, of which this one's dishes stand for all; n_spread: spread
    words of all buckets. Customers and tables of a word are this bucket's part.
    """
    n_words = len(factor)
    rng = np.random.default_rng(seed)
    d, d0 = DISCOUNT, PARENT_DISCOUNT
    tables = np.ones(len(counts), dtype=np.int64)
    several = np.flatnonzero(counts > 1)
    present = np.flatnonzero(np.bincount(word, minlength=n_words))
    vocabulary = share * np.count_nonzero(factor[present] == 1) + n_spread
    parent = np.zeros(n_words)
    parent[present] = 1
    kept: tuple[list, list, list] = ([], [], [])
    for sweep in range(SWEEPS):
        own = np.bincount(word, tables, n_words)
        whole = np.rint(own * factor).astype(np.int64)
        total, opened = own.sum() * share, (parent / factor).sum() * share
        base = (PARENT_STRENGTH + d0 * opened) / (vocabulary + 1)
        if len(present):
            fresh = d0 * rng.gamma(PARENT_STRENGTH / d0 + opened) / (vocabulary + 1)
            parent[present] = draw_tables(whole[present], np.full(len(present), fresh), d0, rng)
        # a dish is drawn given all others: its own tables count neither in its restaurant nor in the parent
        w, u, t = word[several], context[several], tables[several]
        others = whole[w] - t
        seated = np.minimum(parent[w], others)
        n = PARENT_STRENGTH + total
        p = (others - d0 * seated + base) / n
        elsewhere = (np.bincount(context, tables, n_contexts)[u] - t) * share
        scale = d * rng.gamma(STRENGTH / d + elsewhere + t)
        tables[several] = draw_tables(counts[several], scale * p, d, rng, (scale, others - d0 * np.maximum(seated, 1) + base, n))
        if sweep >= BURN_IN:
            for held, now in zip(kept, (tables.astype(np.uint32), np.bincount(word, tables, n_words), parent / factor), strict=True):
                held.append(now)
    return kept


_ASKED = "<u8" + " <u4" * KEPT
_TOLD = "<u8 <f4" + " <u4" * KEPT
_WORD_PARTS = "<u8 <i8" + " <f8 <f8" * KEPT  # words; their training counts; customers and discounted tables of each sweep


def _changes(sweeps: list[np.ndarray]) -> list[np.ndarray]:
    """Counts of each sweep as differences from the one before: most are the same."""
    return [_bytes_apart(x.astype("<u4")) for x in (sweeps[0], *(b.astype("<u4") - a.astype("<u4") for a, b in zip(sweeps, sweeps[1:], strict=False)))]


def _of_changes(parts: list[np.ndarray]) -> list[np.ndarray]:
    return list(np.cumsum([_together(x) for x in parts], axis=0, dtype=np.uint32))


class _Bucket:
    """A bucket's word pairs over all chunks, and their seating in each sweep kept.

    Made alike from the same blobs in any order, so it can be made once to ask and once to score.
    """

    def __init__(self, bucket: int, blobs: list[tuple[int, bytes]], spread: Spread, occurrences: bool):
        self.parts = sorted(blobs)
        w, u, c, self.sizes = [], [], [], []
        for _, payload in self.parts:
            x = _unpack(payload, _PAIRS)
            w.append(np.repeat(x[0], x[1]))
            context = x[2].astype(np.uint64) | x[3].astype(np.uint64) << np.uint64(16)
            u.append(context[_together(x[4])])
            c.append(_together(x[5]))
            self.sizes.append(len(c[-1]))
        del x
        self.words, word = np.unique(np.concatenate(w), return_inverse=True)
        w.clear()
        self.contexts, context = np.unique(np.concatenate(u), return_inverse=True)
        u.clear()
        key = word.astype(np.uint64) << np.uint64(32) | context.astype(np.uint64)
        del word, context
        count = np.concatenate(c)
        c.clear()
        if occurrences:
            pairs, number = np.unique(key, return_inverse=True)
            counts = np.bincount(number, count, len(pairs)).astype(np.int64)
            self.number = number.astype(np.uint32)
            del number
        else:
            order = np.argsort(key)
            key = key[order]
            at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            pairs, counts = key[at], np.add.reduceat(count[order].astype(np.int64), at)
        del key, count
        self.word, self.context = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
        self.trained = np.bincount(self.word, counts, len(self.words)).astype(np.int64)
        self.factor = spread.of(self.words)
        seen = np.flatnonzero(counts)
        tables, self.customers, parent = sample(self.word[seen], self.context[seen], counts[seen], self.factor, len(self.contexts), spread.buckets, len(spread.hashes), bucket)
        self.tables = [PARENT_DISCOUNT * x for x in parent]
        self.counts, self.seen, self.seated = counts, seen, tables
        self.opened = [np.bincount(self.context[seen], t, len(self.contexts)).astype(np.uint32) for t in tables]


def _by_home(hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places of the contexts that each bucket knows about."""
    if not len(hashes):
        return
    home = (hashes % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(home, kind="stable")
    cuts = np.flatnonzero(np.append(True, np.diff(home[order]) != 0))
    for a, b in zip(cuts, np.append(cuts[1:], len(order)), strict=True):
        yield int(home[order[a]]), order[a:b]


def _ask(buckets: int, spread: Spread):
    """What a bucket opened at each context, its words' counts (both by the contexts' bits), its part of spread words, and its totals."""

    def solve(bucket: int, rows: list[tuple]) -> Iterator[tuple]:
        blobs = [(source, payload) for kind, source, payload in rows if kind == PAIRS]
        if not blobs:
            return
        x = _Bucket(bucket, blobs, spread, False)
        yield bucket, TOTAL, bucket, struct.pack(_TOTAL, *(c.sum() for c in x.customers), *(t.sum() for t in x.tables), x.trained.sum(), np.count_nonzero((x.trained > 0) & (x.factor == 1)))
        wide = np.flatnonzero(x.factor > 1)
        for home, at in _by_home(x.words[wide], buckets):
            at = wide[at]
            yield home, WORDS, bucket, _pack(x.words[at], x.trained[at], *(v[k][at] for k in range(KEPT) for v in (x.customers, x.tables)))
        for home, at in _by_home(x.contexts, buckets):
            yield home, ASKED, bucket, _pack(x.contexts[at], *_changes([t[at] for t in x.opened]))
        known = np.flatnonzero(x.trained)
        short = x.words[known] & np.uint64(_U48)
        for home, at in _by_home(short, buckets):
            yield home, COUNTS, bucket, _pack(short[at], x.trained[known[at]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _rows(row for bucket, rows in _by_bucket(batches) for row in solve(bucket, rows))

    return run


def _total_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [struct.unpack(_TOTAL, p.as_py()) for k, p in zip(batch.column(1).to_pylist(), batch.column(3), strict=True) if k == TOTAL]
        if rows:
            yield _batch(rows, _TOTALS)


def _tell():
    """Totals of contexts, sent back to each bucket that asked."""

    def solve(bucket: int, rows: list[tuple]) -> Iterator[tuple]:
        parts = [(source, _unpack(p, _WORD_PARTS)) for k, source, p in sorted(rows, key=lambda r: r[1]) if k == WORDS]
        if parts:
            whole = np.unique(np.concatenate([x[0] for _, x in parts]))
            sums = [np.zeros(len(whole)) for _ in range(1 + 2 * KEPT)]
            for _, x in parts:
                at = np.searchsorted(whole, x[0])
                for total, part in zip(sums, x[1:], strict=True):
                    total[at] += part
            for source, x in parts:
                at = np.searchsorted(whole, x[0])
                yield source, TOLD_WORDS, bucket, _pack(x[0], sums[0][at].astype("<i8"), *(v[at] for v in sums[1:]))
        known = [_unpack(p, "<u8 <i8") for k, _, p in rows if k == COUNTS]
        asked = sorted((source, p) for k, source, p in rows if k == ASKED)
        if not asked:
            return
        asked = [(source, x[0], _of_changes(x[1:])) for source, x in ((s, _unpack(p, _ASKED)) for s, p in asked)]
        hashes = np.unique(np.concatenate([x[1] for x in asked]))
        opened, customers = np.zeros((KEPT, len(hashes)), dtype=np.uint32), np.zeros(len(hashes))
        for _, h, tables in asked:
            at = np.searchsorted(hashes, h)
            for k, t in enumerate(tables):
                opened[k, at] += t
        for h, c in known:
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            hit = hashes[at] == h
            np.add.at(customers, at[hit], c[hit])
        for source, h, _ in asked:
            at = np.searchsorted(hashes, h)
            yield source, TOLD, bucket, _pack(h, customers[at].astype("<f4"), *_changes(list(opened[:, at])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _rows(row for bucket, rows in _by_bucket(batches) for row in solve(bucket, rows))

    return run


def _apply(buckets: int, spread: Spread):
    """Each chunk's texts' sums over a bucket's tokens; the chunks' ids go through."""

    def solve(bucket: int, rows: list[tuple], told: list[tuple]) -> Iterator[tuple]:
        for kind, source, payload in rows:
            if kind == DOCS:
                yield bucket, DOCS, source, payload
        blobs = [(source, payload) for kind, source, payload in rows if kind == PAIRS]
        if not blobs:
            return
        x = _Bucket(bucket, blobs, spread, True)
        totals = told[0][2:]
        customers_all, tables_all, (n_tokens, n_words) = totals[:KEPT], totals[KEPT : 2 * KEPT], totals[2 * KEPT :]
        n_words += len(spread.hashes)  # which occur in training, and aren't among the buckets' words
        opened, seated = np.zeros((KEPT, len(x.contexts)), dtype=np.uint32), np.zeros(len(x.contexts))
        for kind, p, *_ in told:
            if kind == TOLD_WORDS:
                h, trained, *sums = _unpack(p, _WORD_PARTS)
                at = np.searchsorted(x.words, h)
                x.trained[at] = trained
                for k in range(KEPT):
                    x.customers[k][at], x.tables[k][at] = sums[2 * k : 2 * k + 2]
                continue
            h, c, *tables = _unpack(p, _TOLD)
            at = np.searchsorted(x.contexts, h)
            seated[at], opened[:, at] = c, _of_changes(tables)
        chance = np.zeros(len(x.counts))
        for k in range(KEPT):
            rest = (PARENT_STRENGTH + tables_all[k]) / (n_words + 1)
            p1 = (x.customers[k] - x.tables[k] + rest) / (PARENT_STRENGTH + customers_all[k])
            chance += ((STRENGTH + DISCOUNT * opened[k]) / (STRENGTH + seated))[x.context] * p1[x.word]
            chance[x.seen] += (x.counts[x.seen] - DISCOUNT * x.seated[k]) / (STRENGTH + seated[x.context[x.seen]])
        score = np.log10(chance / KEPT)
        del chance
        base = (np.log10(x.trained + 1.0) - np.log10(float(n_tokens + n_words + 1)))[x.word]
        known = (x.trained > 0)[x.word]
        at = 0
        for (source, payload), n in zip(x.parts, x.sizes, strict=True):
            b = _unpack(payload, _PAIRS)
            number, doc, w = np.repeat(x.number[at : at + n], _together(b[6])), b[7], _together(b[8]).astype(np.float64)
            at += n
            m = int(doc.max()) + 1
            sums = [np.bincount(doc, w * v[number], m) for v in (score, base, known)]
            yield source % buckets, SUMS, source, _pack(sums[0].astype("<f4"), _bytes_apart(np.rint(sums[1] / UNIT).astype("<i8")), sums[2].astype("<u4"))

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        rows = [tuple(r.values()) for r in left.select(["kind", "source", "payload"]).to_pylist()]
        told = [tuple(r.values()) for r in right.select(["kind", "payload", *_TOTALS.names]).to_pylist()]
        return pa.Table.from_batches(list(_rows(solve(key[0].as_py(), rows, told))), schema=_SCHEMA)

    return run


SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
_SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def _sum_up():
    def solve(rows: list[tuple]) -> pa.RecordBatch:
        n_tokens = rows[0][2]
        ids, named, sizes = _unpack(next(p for k, p, _ in rows if k == DOCS), "<i8 u1 <i8")
        n = len(ids)
        score, base, known = np.zeros(n), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        for k, p, _ in rows:
            if k == SUMS:
                s, b, m = _unpack(p, "<f4 <i8 <u4")
                b = _together(b)
                score[: len(s)] += s
                base[: len(b)] += b
                known[: len(m)] += m
        docs = [i if x else None for i, x in zip(ids.tolist(), named.tolist(), strict=True)]
        columns = (docs, [held_out(i) for i in docs], sizes, known, np.full(n, n_tokens, dtype=np.int64), base * UNIT, score)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCORES, strict=True)], schema=_SCORES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for source, kind, payload, n_tokens in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist(), strict=True):
                if source != now and held:
                    yield solve(held)
                    held = []
                now = source
                held.append((kind, payload.as_py(), n_tokens))
        if held:
            yield solve(held)

    return run


def score(docs: DataFrame) -> DataFrame:
    """Scores of every row of docs(doc_id, text) under the model of the rows that aren't held out."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("data"))
    total = rows.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    buckets = max(12, total // BUCKET_BYTES)
    spread = spread_words(rows, buckets)
    # the large exchange is written once and read twice; seatings are made twice rather than stored
    pairs = rows.mapInArrow(_pair_blobs(buckets, spread), ROW).repartition(buckets, "bucket")
    asked = pairs.sortWithinPartitions("bucket").mapInArrow(_ask(buckets, spread), ROW).repartition(buckets, "bucket")
    totals = F.broadcast(asked.mapInArrow(_total_rows, TOTALS).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _TOTALS.names)).withColumn("one", F.lit(1)))  # one row
    told = asked.sortWithinPartitions("bucket").mapInArrow(_tell(), ROW).withColumn("one", F.lit(1)).join(totals, "one").drop("one")
    parts = pairs.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(_apply(buckets, spread), ROW)
    dealt = parts.withColumn("one", F.lit(1)).join(totals.select("one", "tokens"), "one").select("source", "kind", "payload", "tokens")
    return dealt.repartition(buckets, "source").sortWithinPartitions("source").mapInArrow(_sum_up(), SCORES)


def perplexity(scored: DataFrame) -> DataFrame:
    """Perplexity by token of the held-out and of the training texts, under the model and the base."""
    each = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scored.groupBy("held_out").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), each("base_score").alias("base_perplexity"), each("score").alias("perplexity"))
