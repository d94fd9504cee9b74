"""Centroid clustering: Lloyd's rounds over cover trees of vectors and of centroids.

Vectors become integers, floor(SCALE * x), so sums, means and distances are exact and don't depend on the
order of tasks. They are cut into blocks in the order of their partitions, without a shuffle; each block
gets a cover tree and is stored once as a row: a node covers a range of the block's vectors within a radius
of its centre, its children halve the radius, and their centres are further apart than that.

A round sends the centroids (k times their components, whatever the input's size) to all tasks, which build
a cover tree over them, too. Both trees are walked together, from the roots: a pair of nodes goes when the
least distance that the radii allow is more than the greatest that some other pair allows; what is left of a
pair of inner nodes is split, the centroids' side first. A node of vectors that has a single centroid left is
assigned whole, as the sum of its range; what comes to the leaves is compared exactly, and ties go to the
smaller number. Each task sums up its blocks before anything is shuffled: k rows of it.

Bounds are compared with a margin beyond double precision's error, so a pair that ties is never pruned.

Defined results: vectors that are null, have other than the asked number of components, a null or non-finite
one, or one of 2**19 or more (whose squares would overflow a long) are left out. Of equal hashes (repeated
ids) the smaller vector begins first; a null id has no hash and begins last. With fewer vectors than
centroids there are as many centroids as vectors. Repeated rows count as often as they are there. Empty
tables give an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, mark, release, stored, stored_since
from .vectors import dense

DIMS = 64
CLUSTERS = 40
ROUNDS = 5
SCALE = 256
SEED = 2
#: Components of integer vectors stay below, so a squared distance fits in a long.
LARGEST = 1 << 27
#: Vectors of a block; a block is a row of about a quarter of a megabyte.
BLOCK = 1024
#: Members up to which a node isn't split.
LEAF = 8

BLOCKS = "ids array<bigint>, vectors binary, nodes binary"
ASSIGNED = "vec_id bigint, cluster int, distance bigint"
SUMS = "cluster int, n bigint, total array<bigint>"
#: A node: its range of the block's vectors (the first is its centre), its children's range among the nodes, its radius.
NODE = np.dtype([("lo", "<i4"), ("hi", "<i4"), ("first", "<i4"), ("last", "<i4"), ("radius", "<f8")])


def square_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of x to all rows of y, both of 64-bit integers."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(y).max(initial=0)))
    if 4 * top * top * x.shape[1] < 1 << 53:
        a, b = x.astype(np.float64), y.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(1) for row in y], axis=1) if len(y) else np.zeros((len(x), 0), np.int64)


def cover_tree(x: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """The order of x's rows and the nodes, parents before children, over rows in that order."""
    order = np.arange(len(x))
    far = np.sqrt(square_distances(x, x[:1])[:, 0])
    nodes, at = [[0, len(x), 0, 0, float(far.max(initial=0))]], 0
    while at < len(nodes):
        lo, hi, _, _, radius = nodes[at]
        if hi - lo > leaf and radius > 0:
            rest, parts, first, begin = order[lo:hi], [], len(nodes), lo
            while len(rest):
                d = np.sqrt(square_distances(x[rest], x[rest[:1]])[:, 0])
                near = d <= radius / 2
                parts.append(rest[near])
                nodes.append([begin, begin + len(parts[-1]), 0, 0, float(d[near].max())])
                rest, begin = rest[~near], nodes[-1][1]
            order[lo:hi] = np.concatenate(parts)
            nodes[at][2:4] = first, len(nodes)
        at += 1
    return order, np.array([tuple(n) for n in nodes], dtype=NODE)


def _blocks(batches: Iterator[pa.RecordBatch], dims: int, scale: int) -> Iterator[pa.RecordBatch]:
    """Trees over the vectors of a partition, BLOCK at a time."""

    def full(ids: list, x: np.ndarray) -> pa.RecordBatch:
        order, nodes = cover_tree(x)
        return pa.RecordBatch.from_pydict({
            "ids": pa.array([[ids[i] for i in order]], pa.list_(pa.int64())), "vectors": pa.array([x[order].astype("<i4").tobytes()], pa.binary()), "nodes": pa.array([nodes.tobytes()], pa.binary())
        })

    ids, waiting = [], np.zeros((0, dims), np.int64)
    for batch in batches:
        kept, x = dense(batch.column(1), dims)
        x = np.floor(scale * x)
        fine = (np.abs(x) < LARGEST).all(1)
        ids += batch.column(0).take(pa.array(kept[fine])).to_pylist()
        waiting = np.concatenate([waiting, x[fine].astype(np.int64)])
        while len(ids) >= BLOCK:
            yield full(ids[:BLOCK], waiting[:BLOCK])
            ids, waiting = ids[BLOCK:], waiting[BLOCK:]
    if ids:
        yield full(ids, waiting)


def nearest(x: np.ndarray, nodes: np.ndarray, centroids: np.ndarray, tree: tuple[np.ndarray, np.ndarray], settled: list | None = None) -> np.ndarray:
    """The nearest centroid of each vector of a block, by walking both trees; ties go to the smaller number.

    settled gets (lo, hi, centroid) of the nodes that were assigned whole.
    """
    order, inner = tree
    out = np.full(len(x), -1, np.int32)
    front, alive = np.zeros(1, np.int64), np.ones((1, 1), bool)  # alive: of each node in front, the centroids' nodes at hand
    side = np.zeros(1, np.int64)
    while len(front):
        own = nodes[front]
        d = np.sqrt(square_distances(x[own["lo"]], centroids[order[inner["lo"][side]]]))
        reach = own["radius"][:, None] + inner["radius"][side][None, :]
        margin = 1e-9 * (1 + d + reach)
        best = np.where(alive, d + reach + margin, np.inf).min(1)
        alive &= d - reach - margin <= best[:, None]
        if (inner["hi"][side] - inner["lo"][side] > 1).any():
            # centroids' nodes that some node still has are split; single ones stay
            wide = (inner["first"][side] < inner["last"][side]) & alive.any(0)
            spread = [np.arange(inner["first"][s], inner["last"][s]) if w else np.array([s]) for s, w in zip(side, wide, strict=True) if w or inner["hi"][s] - inner["lo"][s] == 1]
            kept = [i for i, (s, w) in enumerate(zip(side, wide, strict=True)) if w or inner["hi"][s] - inner["lo"][s] == 1]
            alive = np.concatenate([np.repeat(alive[:, i : i + 1], len(s), axis=1) for i, s in zip(kept, spread, strict=True)], axis=1)
            side = np.concatenate(spread)
            continue
        number = order[inner["lo"][side]]
        single = alive.sum(1) == 1
        for f, c in zip(front[single], number[alive[single].argmax(1)], strict=True):
            lo, hi = nodes["lo"][f], nodes["hi"][f]
            out[lo:hi] = c
            if settled is not None:
                settled.append((int(lo), int(hi), int(c)))
        front, alive, own = front[~single], alive[~single], own[~single]
        ends = own["first"] == own["last"]
        if ends.any():
            size = (own["hi"] - own["lo"])[ends]
            rows = np.repeat(own["lo"][ends] - np.cumsum(size) + size, size) + np.arange(size.sum())
            by = np.argsort(number)
            exact = np.where(np.repeat(alive[ends], size, axis=0)[:, by], square_distances(x[rows], centroids[number[by]]), np.iinfo(np.int64).max)
            out[rows] = number[by][exact.argmin(1)]
        front, alive, own = front[~ends], alive[~ends], own[~ends]
        size = own["last"] - own["first"]
        front = np.repeat(own["first"] - np.cumsum(size) + size, size).astype(np.int64) + np.arange(size.sum())
        alive = np.repeat(alive, size, axis=0)
    return out


def centroid_tree(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A cover tree whose leaves are single centroids; equal ones are children of a node of radius 0."""
    order, nodes = cover_tree(centroids, 1)
    more, found = [], nodes.copy()
    for i in np.flatnonzero((nodes["first"] == nodes["last"]) & (nodes["hi"] - nodes["lo"] > 1)):
        found["first"][i] = len(nodes) + len(more)
        more += [(k, k + 1, 0, 0, 0.0) for k in range(nodes["lo"][i], nodes["hi"][i])]
        found["last"][i] = len(nodes) + len(more)
    return order, np.concatenate([found, np.array(more, dtype=NODE)])


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    for batch in batches:
        for i in range(batch.num_rows):
            nodes = np.frombuffer(batch.column(2)[i].as_py(), NODE)
            ids = batch.column(0)[i].values
            yield ids, np.frombuffer(batch.column(1)[i].as_py(), "<i4").reshape(len(ids), -1).astype(np.int64), nodes


def _sums(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Members and sum of each centroid over the blocks of a task."""
    tree = centroid_tree(centroids)
    n, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
    for _, x, nodes in _each(batches):
        settled: list = []
        got = nearest(x, nodes, centroids, tree, settled)
        n += np.bincount(got, minlength=len(centroids))
        for lo, hi, c in settled:
            total[c] += x[lo:hi].sum(0)
            got[lo:hi] = -1
        single = got >= 0
        np.add.at(total, got[single], x[single])
    found = np.flatnonzero(n)
    yield pa.RecordBatch.from_pydict({"cluster": pa.array(found, pa.int32()), "n": pa.array(n[found]), "total": pa.array(list(total[found]), pa.list_(pa.int64()))})


def _assign(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    tree = centroid_tree(centroids)
    for ids, x, nodes in _each(batches):
        got = nearest(x, nodes, centroids, tree)
        away = ((x - centroids[got]) ** 2).sum(1)
        yield pa.RecordBatch.from_arrays([ids, pa.array(got, pa.int32()), pa.array(away, pa.int64())], names=["vec_id", "cluster", "distance"])


def trees(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """The blocks of vectors(vec_id, embedding) with their trees."""
    slim = vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>"))
    return slim.mapInArrow(lean(lambda b: _blocks(b, dims, scale)), BLOCKS)


def first_centroids(vectors: DataFrame, k: int = CLUSTERS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED) -> np.ndarray:
    """The k vectors of the least hashes of their ids."""
    scaled = vectors.select("vec_id", F.transform(F.col("embedding").cast("array<double>"), lambda x: x * scale).alias("x"))
    fine = scaled.filter((F.size("x") == dims) & F.forall("x", lambda x: F.coalesce((x >= 1 - LARGEST) & (x < LARGEST), F.lit(False))))
    by_hash = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("bigint").cast("string")), 256)
    picked = fine.select(by_hash.alias("h"), F.transform("x", lambda x: F.floor(x)).alias("x")).orderBy(F.col("h").asc_nulls_last(), "x").limit(k)
    return np.array([r.x for r in picked.collect()], dtype=np.int64).reshape(-1, dims)


def lloyd(blocks: DataFrame, centroids: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The centroids after some rounds; empty ones stay where they are."""
    dims = centroids.shape[1]
    for _ in range(rounds):
        now = centroids
        parts = blocks.mapInArrow(lean(lambda b, c=now: _sums(b, c)), SUMS)
        sums = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *(F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(dims)))
        centroids = now.copy()
        for row in sums.collect():  # as many rows as centroids
            centroids[row.cluster] = [row[f"t{i}"] // row.n for i in range(dims)]
    return centroids


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256 of every kept vector."""
    spark, schema = vectors.sparkSession, f"{ASSIGNED}, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    centroids = first_centroids(vectors, k, dims, scale, seed)
    if not len(centroids):
        return spark.createDataFrame([], schema)
    point = mark()
    blocks = stored(trees(vectors, dims, scale), "trees")
    before = stored_since(point)
    centroids = lloyd(blocks, centroids, rounds)
    assigned = stored(blocks.mapInArrow(lean(lambda b: _assign(b, centroids)), ASSIGNED), "assigned")
    release(spark, before)
    found = {r.cluster: int(r.d) for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    rows = [(c, d, sum(found.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, d in found.items()]
    of = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(of), "cluster").select(*[c.split()[0] for c in schema.split(", ")])
