"""Near-duplicate vectors by randomised-rotation binary codes.

A unit vector is turned by random rotations; the signs of its turned components are its code, kept with one
correction factor a rotation: the inner product of the vector and its own code. The inner product of
another turned vector with the code, divided by the factor, is an unbiased estimate of the cosine of the two,
whose error is at most SIGMAS * sqrt(1 - cos^2) * sqrt((1 - f^2) / f^2) / sqrt(dims - 1) but for a chance of
about exp(-SIGMAS^2 / 2), and falls with the root of the number of rotations. A pair whose
estimate stays below the threshold by more than that bound isn't looked at again; all others have their
cosine computed in double precision, which alone decides.

Which pairs meet: bits of the code, BITS at a time, are the keys of bands; vectors that share a band's key
are a bucket. A pair of cosine 0.95 agrees in a bit with probability 0.899, so the number of bands is
chosen for a pair just on the threshold to meet with probability MEET; closer pairs meet all the surer. BITS
grows with the logarithm of the number of vectors, so buckets don't grow with the input.

Equal vectors are one from the start, with their number. A bucket's estimates are made some rows at a
time, and a bucket of more than BLOCK vectors is cut into blocks, whose pairs are groups of their own. A pair that meets in several bands counts in the first of them, which its two codes tell, so
pairs are never gathered to be made distinct: what leaves a bucket is one count for each vector and a spanning
forest of its links.

Defined results: vectors that are null, empty, all zeros or hold a null or non-finite component link to
nothing and are their own component; vectors of different lengths never link. Repeated rows are vectors
of their own, also where they share an id. A null id stands for nothing: components are named after their
least id that isn't null, and a null id is kept only where there is none. Empty tables give empty results.
Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import caches, discard, lean, mark, release, stored, stored_since
from .graph import components
from .vectors import finite_bytes

THRESHOLD = 0.95
#: Chance that a pair just on the threshold shares a band.
MEET = 0.9995
#: Standard errors that an estimate may be off.
SIGMAS = 4.5
#: Vectors that an even bucket holds about.
EVEN = 12
#: Vectors up to which a bucket is one task's work.
BLOCK = 2048
#: Vectors up to which a bucket's pairs are listed and not made as a matrix.
FEW = 64
#: Cells of a matrix of estimates.
CELLS = 1 << 20
#: Pairs that are looked at together.
PAIRS = 1 << 14

CODED = "rep bigint, many bigint, dims int, raw binary, code binary, factors binary"
_rotations: dict[tuple[int, int], np.ndarray] = {}
caches["rotation_codes"] = _rotations.clear


def rotations(dims: int, n: int) -> np.ndarray:
    """n random rotations of dims dimensions side by side; the same on every machine."""
    if (dims, n) not in _rotations:
        rng = np.random.Generator(np.random.PCG64([dims, 20240715]))
        parts = []
        for _ in range(n):
            q, r = np.linalg.qr(rng.standard_normal((dims, dims)))
            parts.append(q * np.sign(np.diag(r)))
        _rotations[dims, n] = np.concatenate(parts, axis=1)
    return _rotations[dims, n]


def units(raw: list[bytes], kind: str) -> np.ndarray:
    """Unit vectors in double precision; scaled by the largest component first, so no square is lost."""
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def bands(n: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Bits of a band and number of bands for n vectors."""
    bits = max(4, round(math.log2(max(n, 1) / EVEN + 1)))
    alike = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - MEET) / math.log1p(-alike))


def encode(u: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of n rotations, a bit for each turned component, and the correction factor of each rotation."""
    turned = u @ rotations(u.shape[1], n)
    return np.packbits(turned > 0, axis=1), np.abs(turned).reshape(len(u), n, -1).sum(2) / math.sqrt(u.shape[1])


def turned(u: np.ndarray, n: int) -> np.ndarray:
    return u.astype(np.float32) @ rotations(u.shape[1], n).astype(np.float32)


def corrected(code: np.ndarray, factors: np.ndarray, dims: int) -> np.ndarray:
    """Codes as signs over their factors: the inner product with another turned vector estimates the cosine, averaged over the rotations."""
    signs = np.unpackbits(code, axis=1, count=dims * factors.shape[1]).astype(np.float32) * 2 - 1
    return signs * np.repeat(1 / (math.sqrt(dims) * factors.shape[1] * factors), dims, axis=1).astype(np.float32)


def allowance(factors: np.ndarray, dims: int, threshold: float = THRESHOLD) -> np.ndarray:
    """How far below the threshold the estimate of a pair on it or above may be, for each coded vector."""
    if dims == 1:
        return np.full(len(factors), 2.0)
    spread = ((1 - factors**2).clip(0) / factors**2).sum(1) / factors.shape[1] ** 2
    return SIGMAS * math.sqrt(1 - threshold**2) * np.sqrt(spread / (dims - 1)) + 1e-5


def band_keys(code: np.ndarray, bits: int, n: int) -> np.ndarray:
    """The key of each vector in each band: its code's bits in turn."""
    flags = np.unpackbits(code, axis=1, count=bits * n).reshape(len(code), n, bits).astype(np.int64)
    return flags @ (1 << np.arange(bits, dtype=np.int64))


def likely(u: np.ndarray, code: np.ndarray, factors: np.ndarray, ends: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places within buckets that their estimates don't rule out, some at a time; ends: the ends of the buckets, one after the other."""
    dims, n = u.shape[1], factors.shape[1]
    full, signs, least = turned(u, n), corrected(code, factors, dims), threshold - allowance(factors, dims, threshold)
    begins = np.concatenate([[0], ends[:-1]])
    small = ends - begins <= FEW
    limit = np.repeat(np.where(small, ends, begins), ends - begins)
    at = np.arange(len(u))
    for d in range(1, FEW):
        at = at[at + d < limit[at]]
        for a in range(0, len(at), PAIRS):
            i = at[a : a + PAIRS]
            fit = np.einsum("ij,ij->i", full[i], signs[i + d]) >= least[i + d]
            yield i[fit], i[fit] + d
    for lo, hi in zip(begins[~small], ends[~small], strict=True):
        step = max(1, CELLS // (hi - lo))
        for a in range(lo, hi, step):
            i, j = np.nonzero(full[a : min(a + step, hi)] @ signs[lo:hi].T >= least[None, lo:hi])
            i, j = i + a, j + lo
            yield i[i < j], j[i < j]


def linked(u: np.ndarray, code: np.ndarray, factors: np.ndarray, ends: np.ndarray, band: np.ndarray, keys: np.ndarray, side: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links within buckets that no earlier band has, by their exact cosine; side tells two blocks apart: 0 and 1 are compared across, 2 all with all."""
    for i, j in likely(u, code, factors, ends, threshold):
        for a in range(0, len(i), PAIRS):
            p, q = i[a : a + PAIRS], j[a : a + PAIRS]
            fit = (side[p] != side[q]) | (side[p] == 2)
            p, q = p[fit], q[fit]
            new = (keys[p] == keys[q]).argmax(1) == band[p]
            p, q = p[new], q[new]
            sure = np.einsum("ij,ij->i", u[p], u[q]) >= threshold
            if sure.any():
                yield p[sure], q[sure]


def _lower(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Lower labels until both ends of all links have the same: the least place that they reach."""
    while (label[i] != label[j]).any():
        low = np.minimum(label[i], label[j])
        for ends in (label[i], label[j], i, j):
            np.minimum.at(label, ends, low)
        label[:] = label[label]


def _code(batches: Iterator[pa.RecordBatch], n_bits: int, kind: str) -> Iterator[pa.RecordBatch]:
    """Codes and factors of raw vectors (rep, many, raw), by their length."""
    width = np.dtype(kind).itemsize
    for batch in batches:
        raw = batch.column(2).to_pylist()
        code, factors = [b""] * len(raw), [b""] * len(raw)
        by_dims: dict[int, list[int]] = {}
        for i, x in enumerate(raw):
            by_dims.setdefault(len(x) // width, []).append(i)
        for dims, places in by_dims.items():
            for a in range(0, len(places), 4096):
                some = places[a : a + 4096]
                c, f = encode(units([raw[i] for i in some], kind), math.ceil(n_bits / dims))
                for k, i in enumerate(some):
                    code[i], factors[i] = c[k].tobytes(), f[k].tobytes()
        dims = pa.array([len(x) // width for x in raw], pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), dims, batch.column(2), pa.array(code, pa.binary()), pa.array(factors, pa.binary())], names=["rep", "many", "dims", "raw", "code", "factors"])


def _spread(batches: Iterator[pa.RecordBatch], bits: int, n: int) -> Iterator[pa.RecordBatch]:
    """A row for each coded vector and band, with the key; the vector's columns as they are."""
    for batch in batches:
        for at in range(0, batch.num_rows, 400):
            part = batch.slice(at, 400)
            heads = np.frombuffer(b"".join(c[: (bits * n + 7) // 8] for c in part.column("code").to_pylist()), np.uint8)
            keys = band_keys(heads.reshape(part.num_rows, -1), bits, n)
            order, band = pa.array(np.tile(np.arange(part.num_rows), n)), pa.array(np.repeat(np.arange(n), part.num_rows), pa.int32())
            yield pa.RecordBatch.from_arrays([band, pa.array(keys.T.ravel()), *(c.take(order) for c in part.columns)], names=["band", "key", *part.schema.names])


def _search(batches: Iterator[pa.RecordBatch], bits: int, n: int, threshold: float, kind: str) -> Iterator[pa.RecordBatch]:
    """Counts and spanning links of buckets, whose rows come one after the other."""

    def solve(t: pa.Table, ends: np.ndarray) -> pa.RecordBatch:
        size = t.num_rows
        code = np.frombuffer(b"".join(t["code"].to_pylist()), np.uint8).reshape(size, -1)
        factors = np.frombuffer(b"".join(t["factors"].to_pylist()), "<f8").reshape(size, -1)
        many, rep, side, band = (t[c].to_numpy() for c in ("many", "rep", "side", "band"))
        count, label = np.zeros(size, np.int64), np.arange(size)
        for i, j in linked(units(t["raw"].to_pylist(), kind), code, factors, ends, band, band_keys(code, bits, n), side, threshold):
            np.add.at(count, i, many[j])
            np.add.at(count, j, many[i])
            _lower(label, i, j)
        found = np.flatnonzero(count)
        return pa.RecordBatch.from_arrays([pa.array(rep[found]), pa.array(count[found]), pa.array(rep[label[found]])], names=["rep", "links", "to"])

    held: pa.Table | None = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        held = now if held is None else pa.concat_tables([held, now])
        ends = _ends(held)
        if len(ends) > 1:  # the last bucket may go on in the next batch
            whole, held = held.slice(0, ends[-2]), held.slice(ends[-2])
            yield from (solve(*part) for part in _alike(whole.combine_chunks(), ends[:-1]))
    if held is not None and held.num_rows:
        yield from (solve(*part) for part in _alike(held.combine_chunks(), _ends(held)))


def _ends(t: pa.Table) -> np.ndarray:
    """Ends of the buckets, or of their pairs of blocks."""
    differ = np.zeros(max(0, t.num_rows - 1), bool)
    for name in ("dims", "band", "key", "pair"):
        x = t[name].to_numpy()
        differ |= x[1:] != x[:-1]
    return np.append(np.flatnonzero(differ) + 1, t.num_rows) if t.num_rows else np.zeros(0, np.int64)


def _alike(t: pa.Table, ends: np.ndarray) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows of vectors of the same length, with the ends of their buckets."""
    dims = t["dims"].to_numpy()
    cuts = [0, *(np.flatnonzero(dims[1:] != dims[:-1]) + 1), t.num_rows]
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        own = ends[(ends > lo) & (ends <= hi)] - lo
        if hi - lo > len(own):  # else no bucket holds two
            yield t.slice(lo, hi - lo), own


def _by_blocks(rows: DataFrame, large: DataFrame) -> DataFrame:
    """rows with the columns pair and side; rows of large buckets once for each pair of blocks that theirs is in."""
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = rows.join(large, ["dims", "band", "key"], "left").withColumn("own", own)
    others = F.when(F.col("own").isNull(), F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    each = dealt.withColumn("other", F.explode(others))
    pair = F.least("own", "other").cast("bigint") * F.col("blocks") + F.greatest("own", "other")
    side = F.when(F.col("own") < F.col("other"), 0).when(F.col("own") > F.col("other"), 1).otherwise(2)
    return each.withColumn("pair", F.coalesce(F.when(F.col("own").isNotNull(), pair), F.lit(-1).cast("bigint"))).withColumn("side", side).drop("blocks", "own", "other")


def links(reps: DataFrame, kind: str = "<f8", threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """(rep, links, to) of distinct vectors reps(rep, many, raw): a vector's links in a bucket, weighted with many, and what its forest hangs it to."""
    bits, n = bands(reps.count(), threshold)
    coded = stored(reps.select("rep", "many", "raw").mapInArrow(lean(lambda b: _code(b, bits * n, kind), "rotation_codes"), CODED), "codes")
    spread = lambda df: df.mapInArrow(lean(lambda b: _spread(b, bits, n)), ", ".join(["band int", "key bigint", *(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)]))
    bucket = ["dims", "band", "key"]
    sizes = spread(coded.select("dims", "code")).groupBy(*bucket).agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > block)
    large = stored(sizes.select(*bucket, F.ceil(F.col("size") / max(1, block // 2)).cast("int").alias("blocks")), "large")
    rows = spread(coded)
    rows = rows.withColumn("pair", F.lit(-1).cast("bigint")).withColumn("side", F.lit(2)) if large.isEmpty() else _by_blocks(rows, large)
    dealt = rows.repartition(*bucket, "pair").sortWithinPartitions(*bucket, "pair")
    found = stored(dealt.mapInArrow(lean(lambda b: _search(b, bits, n, threshold, kind), "rotation_codes"), "rep bigint, links bigint, to bigint"), "links")
    discard(coded, large)
    return found


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of vectors(vec_id, embedding)."""
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    kind, point = "<f4" if single else "<f8", mark()
    slim = vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<float>" if single else "array<double>"))
    rows = slim.mapInArrow(lean(lambda b: finite_bytes(b, kind)), "vec_id bigint, raw binary")
    distinct = rows.filter("raw IS NOT NULL").groupBy("raw").agg(F.count(F.lit(1)).alias("many"), F.min("vec_id").alias("least"))
    reps = stored(distinct.withColumn("rep", F.monotonically_increasing_id()), "vectors")
    found = links(reps, kind, threshold, block)
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = components(found, "rep", "to").withColumnsRenamed({"node": "rep", "component": "group"})
    member = reps.select("rep", "least").join(groups, "rep", "left").withColumn("group", F.coalesce("group", "rep"))
    named = member.join(member.groupBy("group").agg(F.min("least").alias("component_id")), "group").select("rep", "component_id")
    whole = stored(reps.join(counts, "rep", "left").join(named, "rep").select("raw", (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links"), "component_id", F.lit(True).alias("_valid")), "classes")
    out = rows.join(whole, "raw", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), F.when(F.col("_valid"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id")
    )
    release(vectors.sparkSession, [p for p in stored_since(point) if p != whole._stored_at])
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
