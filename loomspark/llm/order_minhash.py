"""Near-duplicates by Order MinHash.

For the sketch, a text's shingles of WORDS words are labelled with their occurrence number, so a repeated
shingle is several elements. Each of SAMPLES hash functions draws the PICKS least of them, which are kept in the
order in which they stand in the text: texts agree in a sample if they share the elements and their
order, so the chance falls with edits and moves alike. Texts that agree in any sample are candidates.

A candidate pair is verified by an alignment of its unlabelled shingle sequences, their longest common
subsequence: a repeated shingle may align with any of its places in the other text, so a lost or gained
repeat costs its own shingles and no others. Where a least similarity is given, the alignment keeps to a
band about the diagonal that is as wide as such a pair can need, so it loses nothing. The similarity is
aligned shingles over all shingles of either text, and links are pairs with THRESHOLD or more.

Equal token sequences are one text from the start. In each bucket every text is first aligned with
the bucket's hub, the text that meets most others in its buckets; where a bucket then still holds
several classes, the pairs across classes are aligned too, so no candidate link is lost: in small
buckets those that lengths and alignments with the hub allow, in large ones those that share one of
their rarest shingles, as all pairs of the least similarity do.

With 4 picks of 24 samples a pair of similarity s is a candidate with probability 1 - (1 - s^4)^24,
0.99999 at 0.8.

Very short texts, of which a sample holds nearly all shingles, also meet in keys of their shingles
without one each, so 4 shingles find the 5 that hold them.

A text is known by its digest, so rows that share an id are told apart by their texts.

Defined results: texts without words (null, empty, white space) link to nothing and are their own
class; texts of fewer than WORDS words have one shingle, the whole. A null doc_id has a null class and
links to nothing. Rows that repeat an id have the class of their own text, so an id may have several. The
class is the least id of its rows. Empty tables give empty results. ``keep`` passes all columns through
and keeps of rows that are alike in id and text one.
"""

import bisect
from collections.abc import Iterable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, lean, stored
from .graph import components

WORDS = 5
SAMPLES = 24
PICKS = 4
THRESHOLD = 0.8
#: Members of a bucket up to which its pairs are enumerated; larger ones are searched by their rarest shingles.
FEW = 16
#: Texts up to which a shingle is rare in that search.
RARE = 32

#: Matches of an alignment that are listed at a time, and bytes of bits that one keeps.
EXPANDED = 1 << 20
MASK_BYTES = 1 << 26

_rng = np.random.Generator(np.random.PCG64(20240607))
_SEEDS = _rng.integers(0, 1 << 63, SAMPLES, dtype=np.uint64)
_FACTORS = _rng.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _rng.integers(0, 1 << 63, max(WORDS, PICKS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: Rows of a hub that one task aligns with it at a time.
PART_ROWS = 128

SIGNED = "doc_id bigint, raw bigint, digest binary, n_shingles int, samples array<bigint>"


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):  # said of single numbers alone
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Shingler:
    """Shingle hashes of texts, plain or labelled; word hashes are remembered."""

    KEPT = 200_000

    def __init__(self):
        self.words: dict[str, int] = {}

    def tokens(self, text: str | None) -> list[str]:
        return (text or "").lower().split()

    def plain(self, tokens: list[str]) -> np.ndarray:
        n = len(tokens)
        if not n:
            return np.zeros(0, dtype=np.uint64)
        known = self.words
        if len(known) > self.KEPT:
            known.clear()
        for w in set(tokens).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "replace"))
        h = np.fromiter(map(known.__getitem__, tokens), dtype=np.uint64, count=n)
        k = min(WORDS, n)
        out = np.zeros(n - k + 1, dtype=np.uint64)
        for j in range(k):
            out += h[j : n - k + 1 + j] * _PLACES[j]
        return _mix(out + np.uint64(k))

    def labelled(self, tokens: list[str]) -> np.ndarray:
        out = self.plain(tokens)
        order = np.argsort(out, kind="stable")
        ranked = out[order]
        same = ranked[1:] == ranked[:-1]
        if same.any():
            head = np.flatnonzero(np.append(True, ~same))
            nth = np.arange(len(out)) - np.repeat(head, np.diff(np.append(head, len(out))))
            label = np.zeros(len(out), dtype=np.uint64)
            label[order] = nth.astype(np.uint64)
            out = np.where(label > 0, _mix(out + label * np.uint64(0x9E3779B97F4A7C15)), out)
        return out


def samples(labelled: np.ndarray) -> np.ndarray:
    """One key for each sample: its picked shingles in text order."""
    n = len(labelled)
    if not n:
        return np.zeros(0, dtype=np.int64)
    take = min(PICKS, n)
    step = max(1, min(SAMPLES, 4_000_000 // n))
    keys = np.empty(SAMPLES, dtype=np.uint64)
    for at in range(0, SAMPLES, step):
        drawn = (labelled[None, :] ^ _SEEDS[at : at + step, None]) * _FACTORS[at : at + step, None]
        drawn ^= drawn >> np.uint64(32)
        place = np.argpartition(drawn, take - 1, axis=1)[:, :take] if take < n else np.broadcast_to(np.arange(n), (len(drawn), n))
        chosen = labelled[np.sort(place, axis=1)]
        key = np.zeros(len(drawn), dtype=np.uint64)
        for j in range(take):
            key += _mix(chosen[:, j]) * _PLACES[j]
        keys[at : at + step] = _mix(key ^ _SEEDS[at : at + step])
    if PICKS <= n <= PICKS + 1:
        # all of them, or all but one each
        for out in range(n) if n > PICKS else (n,):
            rest = np.delete(labelled, out) if out < n else labelled
            keys = np.append(keys, _mix(np.add.reduce(_mix(rest) * _PLACES[:PICKS]) ^ _FACTORS[0]))
    return keys.view(np.int64)


def longest_rising(parts: Iterable[np.ndarray]) -> int:
    """Length of the longest strictly rising subsequence of values that come in parts."""
    tails: list[int] = []
    for values in parts:
        _lengthen(tails, values)
    return len(tails)


def _lengthen(tails: list[int], values: np.ndarray) -> None:
    """tails: the least end of a rising subsequence of each length so far."""
    if not tails and (values[1:] > values[:-1]).all():
        tails += values.tolist()
        return
    for v in values.tolist():
        i = bisect.bisect_left(tails, v)
        if i == len(tails):
            tails.append(v)
        else:
            tails[i] = v


def common_bits(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, a row of the table at a time as the bits of one integer.

    The bits of MASK_BYTES' worth of shingles are kept, of those with the most places; others are made when asked for.
    """
    where: dict[int, list[int]] = {}
    for i, x in enumerate(a.tolist()):
        where.setdefault(x, []).append(i)

    def bits(x: int) -> int:
        flags = np.zeros(len(a), dtype=np.uint8)
        flags[where[x]] = 1
        return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")

    kept = sorted(where, key=lambda x: -len(where[x]))[: 1 + MASK_BYTES * 8 // (len(a) + 1)]
    masks = {x: bits(x) for x in kept}
    full = (1 << len(a)) - 1
    row = full
    for x in b.tolist():
        mask = masks.get(x)
        hit = row & (mask if mask is not None else bits(x) if x in where else 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _ratio(threshold: float) -> tuple[int, int]:
    """A similarity as p / q: bounds are compared as whole numbers, so that a pair just on one isn't lost."""
    exact = Fraction(threshold).limit_denominator(10_000)
    return exact.numerator, exact.denominator


def aligned(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> int:
    """Shingles that a banded alignment of two sequences matches, repeated ones at any of their places; 0 if too few can."""
    n, m = len(a), len(b)
    p, q = _ratio(threshold)
    need = -(-(n + m) * p // (p + q))
    if min(n, m) < need:
        return 0
    # what both begin and end with is matched as it stands
    least = min(n, m)
    other = np.flatnonzero(a[:least] != b[:least])
    head = int(other[0]) if len(other) else least
    a, b, least = a[head:], b[head:], least - head
    other = np.flatnonzero(a[len(a) - least :] != b[len(b) - least :])
    tail = least - 1 - int(other[-1]) if len(other) else least
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    same = head + tail
    if not len(a) or not len(b):
        return same
    at = np.flatnonzero(np.isin(a, b))
    of = np.flatnonzero(np.isin(b, a))
    if same + min(len(at), len(of)) < need:
        return 0
    if not len(at):
        return same
    x, y = a[at], b[of]
    order = np.argsort(y, kind="stable")
    ranked = y[order]
    first = np.searchsorted(ranked, x, "left")
    times = np.searchsorted(ranked, x, "right") - first
    matches = int(times.sum())
    # all matches of many repeats cost more than the table's rows as bits
    if matches > 4 * len(x) + len(x) * len(y) // 10_000:
        return same + common_bits(x, y)
    # before a match and behind it, the unmatched of either text shift the diagonal at most so far
    band, ends = max(n, m) - need + 1, np.cumsum(times)

    def parts() -> Iterator[np.ndarray]:
        """Places in b of the matches, for some places of a at a time; of each backwards, so a rising run takes one of them at most."""
        lo = 0
        while lo < len(x):
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + EXPANDED)))
            n = times[lo:hi]
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            right = of[order[np.repeat(first[lo:hi] + n - 1, n) - nth]]
            yield right[np.abs(np.repeat(at[lo:hi], n) - right) <= band]
            lo = hi

    return same + longest_rising(parts())


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    m = aligned(a, b)
    return m / (len(a) + len(b) - m) if m else 0.0


def _keyed(docs: DataFrame, *more: Column) -> DataFrame:
    """(doc_id, text, raw) of docs: raw is a hash of the text as it stands."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("raw"), *more)


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, raw, digest, n_shingles, samples) of every row of docs(doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            digests, counts, keys = [], [], []
            for text in batch.column(1):
                tokens = shingler.tokens(text.as_py())
                labelled = shingler.labelled(tokens)
                digests.append(xxhash.xxh3_128_digest(" ".join(tokens).encode("utf-8", "replace")))
                counts.append(len(labelled))
                keys.append(samples(labelled))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(digests, pa.binary()), pa.array(counts, pa.int32()), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "raw", "digest", "n_shingles", "samples"])

    return _keyed(docs).mapInArrow(lean(run), SIGNED)


VERIFIED = "a bigint, b bigint, n_a int, n_b int, matched int"


def _with_text(rows: DataFrame, nodes: DataFrame, source: DataFrame) -> DataFrame:
    """rows(node, ..) with their text: only slim rows are dealt out before the texts are."""
    return rows.join(nodes.select("node", "doc_id", "raw"), "node").join(source, ["doc_id", "raw"]).drop("doc_id", "raw")


def verify(pairs: DataFrame, nodes: DataFrame, source: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """pairs(a, b) with their shingle counts and how many align; 0 where the band shows that too few do.

    nodes: (node, doc_id, raw); source: (doc_id, raw, text). The side that recurs (b) has its text sent once
    for each PART_ROWS of its pairs, in front of the texts of the other side, and no pair carries two.
    """
    pairs = stored(pairs, "pairs")
    parts = stored(pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).alias("parts")).filter("parts > 1"), "parts")
    dealt = stored(pairs.join(parts, "b", "left").select("a", "b", F.expr("coalesce(pmod(xxhash64(a), parts), 0)").alias("part")), "pairs")
    left = dealt.select(F.col("a").alias("node"), "b", "part", F.lit(1).alias("kind"))
    heads = dealt.select(F.col("b").alias("node"), "b", "part", F.lit(0).alias("kind")).distinct()
    rows = _with_text(heads.unionByName(left), nodes, source).repartition("b", "part").sortWithinPartitions("b", "part", "kind").select("b", "kind", F.col("node").alias("a"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, hub, y = Shingler(), None, None
        for batch in batches:
            found = []
            for b, kind, a, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
                if kind == 0:
                    if b != hub:
                        hub, y = b, shingler.plain(shingler.tokens(text.as_py()))
                    continue
                x = shingler.plain(shingler.tokens(text.as_py()))
                found.append((a, b, len(x), len(y), aligned(x, y, threshold)))
            columns = list(zip(*found, strict=True)) if found else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()), strict=True)], names=["a", "b", "n_a", "n_b", "matched"])

    return rows.mapInArrow(lean(run), VERIFIED)


def _similar(threshold: float):
    p, q = _ratio(threshold)
    return (F.col("matched") > 0) & (F.col("matched").cast("bigint") * q >= p * (F.col("n_a") + F.col("n_b") - F.col("matched")).cast("bigint"))


def prefix_pairs(members: DataFrame, nodes: DataFrame, source: DataFrame, threshold: float) -> DataFrame:
    """(a, b) of members(node, class) of different classes that may be similar, from all pairs that are.

    As many labelled shingles are shared as any alignment of the plain ones can match at most, so the
    bounds hold for it. Two texts of n and m shingles that share enough of them share one among the
    n - ceil(threshold n) + 1 and the m - ceil(threshold m) + 1 rarest; only these are joined, and of them
    those that occur in several classes. The rarest one that they share is among them. So if it is a common
    one (in more than RARE texts), all that they share is common: only texts that consist of common
    shingles by the threshold's share are looked up by one. A shingle's largest class isn't joined with
    itself, and texts only with those of like length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            found = [shingler.labelled(shingler.tokens(t.as_py())).view(np.int64) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))], names=["node", "class", "shingles"])

    own = _with_text(members, nodes, source).select("node", "class", "text")
    held = stored(own.mapInArrow(lean(run), "node bigint, class bigint, shingles array<bigint>"), "shingles")
    rows = held.select("node", "class", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    often = rows.groupBy("s").agg(F.count(F.lit(1)).alias("f"), F.min("class").alias("lo"), F.max("class").alias("hi")).filter("f > 1")
    often = stored(often.select("s", "f", (F.col("lo") != F.col("hi")).alias("mixed")), "shingle-counts")
    ranked = rows.join(often, "s", "left").withColumns({"f": F.coalesce("f", F.lit(1)), "mixed": F.coalesce("mixed", F.lit(False))}).groupBy("node", "class", "n").agg(F.sort_array(F.collect_list(F.struct("f", "s", "mixed"))).alias("r"))
    p, q = _ratio(threshold)
    rare = F.slice("r", F.lit(1), F.expr(f"CAST(n - (CAST(n AS BIGINT) * {p} + {q - 1}) DIV {q} + 1 AS INT)"))
    common = F.size(F.filter("r", lambda x: x.f > RARE)).alias("c")
    heads = ranked.select("node", "class", "n", common, F.explode(F.filter(rare, lambda x: x.mixed)).alias("x")).select("node", "class", "n", "c", (F.col("x.f") <= RARE).alias("rare"), F.col("x.s").alias("s"))
    # lengths of similar texts fall into one class of lengths or two neighbouring ones
    length = F.floor(F.log(F.col("n")) / F.log(F.lit(1 / threshold * 1.001)))
    heads = stored(heads.filter(F.col("rare") | (F.col("c").cast("bigint") * q >= F.col("n").cast("bigint") * p)).withColumn("length", length), "prefixes")
    largest = heads.groupBy("s", "class").count().groupBy("s").agg(F.max(F.struct("count", "class")).alias("l")).select("s", F.col("l.class").alias("largest"))
    largest = stored(largest, "largest-classes")
    near = F.explode(F.array(F.col("length") - 1, F.col("length"), F.col("length") + 1)).alias("length")
    a = heads.join(largest, "s").filter("class != largest").select("s", F.col("node").alias("x"), F.col("class").alias("class_x"), F.col("n").alias("n_x"), F.col("c").alias("c_x"), near)
    b = heads.select("s", F.col("node").alias("y"), F.col("class").alias("class_y"), F.col("n").alias("n_y"), F.col("c").alias("c_y"), "rare", "length")
    need = (F.col("n_x") + F.col("n_y")).cast("bigint") * p
    reaches = lambda n: n.cast("bigint") * (p + q) >= need
    fits = (F.col("class_x") != F.col("class_y")) & reaches(F.least("n_x", "n_y")) & (F.col("rare") | reaches(F.least("c_x", "c_y")))
    found = stored(a.join(b, ["s", "length"]).filter(fits).select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "prefix-pairs")
    discard(held, often, heads, largest)
    return found


def _grouped(docs: DataFrame, threshold: float) -> DataFrame:
    """(doc_id, raw, class_id, class_raw, n_verified_links) of every row; class_id and class_raw name the document that stands for the class."""
    signed = stored(signatures(docs), "signatures")
    ids = signed.filter("doc_id IS NOT NULL AND n_shingles > 0")
    by_text = ids.groupBy("digest").agg(F.min(F.struct("doc_id", "raw")).alias("rep"), F.first("samples").alias("samples"), F.first("n_shingles").alias("n"))
    nodes = stored(by_text.select(F.monotonically_increasing_id().alias("node"), "digest", F.col("rep.doc_id").alias("doc_id"), F.col("rep.raw").alias("raw"), "samples", "n"), "texts")
    source = _keyed(docs)
    if ids.groupBy("doc_id", "raw").count().filter("count > 1").limit(1).count():
        source = source.dropDuplicates(["doc_id", "raw"])
    drawn = nodes.select("node", "n", F.explode(F.array_distinct("samples")).alias("key"))
    shared = drawn.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    placed = stored(drawn.join(shared, "key").select("key", "node", "n", "size"), "buckets")
    # what copies were made from meets most of them: the text that shares most buckets with most others
    ranked = placed.join(placed.groupBy("node").agg(F.sum("size").alias("meets")), "node")
    hubs = ranked.groupBy("key").agg(F.max(F.struct("meets", (-F.col("node")).alias("least"))).alias("h")).select("key", (-F.col("h.least")).alias("hub"))
    members = stored(placed.join(hubs, "key").select("key", "hub", "node", "n"), "buckets")
    first = stored(verify(members.filter("node != hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct(), nodes, source, threshold), "aligned")
    # the distance to the hub, where the band was wide enough for it
    first = first.withColumn("indel", F.when(F.col("matched") > 0, F.col("n_a") + F.col("n_b") - 2 * F.col("matched")))
    links = first.filter(_similar(threshold)).select("a", "b")
    class_of = stored(components(links), "classes")
    # buckets that hold several classes: pairs across classes, as far as lengths and alignments allow
    known = members.join(class_of.withColumnsRenamed({"component": "class"}), "node", "left").withColumn("class", F.coalesce("class", "node"))
    mixed = stored(known.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi"), F.count(F.lit(1)).alias("size")).filter("lo != hi").select("key", "size"), "mixed")
    few = known.join(mixed.filter(F.col("size") <= FEW), "key").filter("node != hub").join(first.select(F.col("a").alias("node"), F.col("b").alias("hub"), "indel"), ["node", "hub"], "left")
    left = few.select("key", F.col("node").alias("a"), F.col("class").alias("class_a"), F.col("n").alias("n_a"), F.col("indel").alias("d_a"))
    right = few.select("key", F.col("node").alias("b"), F.col("class").alias("class_b"), F.col("n").alias("n_b"), F.col("indel").alias("d_b"))
    # similar texts differ by at most this share of their shingles together
    p, q = _ratio(threshold)
    far = (F.col("n_a") + F.col("n_b")).cast("bigint") * (q - p)
    within = lambda x: F.abs(x).cast("bigint") * (q + p) <= far
    near = within(F.col("n_a") - F.col("n_b")) & F.coalesce(within(F.col("d_a") - F.col("d_b")), F.lit(True))
    across = left.join(right, "key").filter((F.col("a") > F.col("b")) & (F.col("class_a") != F.col("class_b")) & near).select("a", "b")
    many = stored(known.join(mixed.filter(F.col("size") > FEW), "key").select("node", "class").distinct(), "searched")
    if many.limit(1).count():
        across = across.unionByName(prefix_pairs(many, nodes, source, threshold))
    pairs = stored(across.distinct().join(first.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
    more = pairs
    if pairs.limit(1).count():
        more = stored(verify(pairs, nodes, source, threshold), "aligned").filter(_similar(threshold)).select("a", "b")
    all_links = links.unionByName(more).distinct()
    final = class_of
    if more.limit(1).count():  # only the classes that the further links join are looked at again
        of = class_of.withColumnsRenamed({"component": "class"})
        ends = more.join(of.withColumnRenamed("node", "a"), "a", "left").withColumn("x", F.coalesce("class", "a")).drop("class").join(of.withColumnRenamed("node", "b"), "b", "left").withColumn("y", F.coalesce("class", "b"))
        joined = stored(components(ends.select("x", "y"), "x", "y").withColumnsRenamed({"node": "class", "component": "of"}), "joined")
        final = stored(of.unionByName(joined.select(F.col("class").alias("node"), "class")).distinct().join(joined, "class", "left").select("node", F.coalesce("of", "class").alias("component")), "classes")
    degree = all_links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    linked = nodes.select("node", "digest", "doc_id", "raw").join(final, "node", "left").join(degree, "node", "left")
    stands = linked.filter("component IS NOT NULL").groupBy("component").agg(F.min(F.struct("doc_id", "raw")).alias("c"))
    per_text = linked.join(stands, "component", "left").select("digest", F.coalesce("c", F.struct("doc_id", "raw")).alias("c"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    per_text = stored(per_text.select("digest", F.col("c.doc_id").alias("class_id"), F.col("c.raw").alias("class_raw"), "n_links"), "text-classes")
    discard(nodes, placed, members, mixed, many, pairs)
    named = signed.select("doc_id", "raw", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("digest")).alias("digest")).join(per_text, "digest", "left")
    return named.select("doc_id", "raw", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("class_raw", "raw").alias("class_raw"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_verified_links"))


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, n_verified_links) of every row: the least id of its class, and how many links of its text to other texts were verified."""
    return _grouped(docs, threshold).select("doc_id", "class_id", "n_verified_links")


def keep(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of docs for each class; rows with a null id stay."""
    found = stored(_grouped(docs, threshold), "near-duplicates")
    gone = found.filter("doc_id != class_id OR raw != class_raw").select("doc_id", "raw").distinct()
    rows = _keyed(docs, F.struct("*").alias("row")).drop("text")
    left = rows.join(gone, ["doc_id", "raw"], "left_anti")
    again = found.filter("doc_id IS NOT NULL").groupBy("doc_id", "raw").count().filter("count > 1").select("doc_id", "raw")
    if not again.limit(1).count():
        return left.select("row.*")
    once = left.join(again, ["doc_id", "raw"], "left_semi").dropDuplicates(["doc_id", "raw"])
    return left.join(again, ["doc_id", "raw"], "left_anti").unionByName(once).select("row.*")
