"""Near-duplicate vectors and clustering against brute force, and their defined results."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomspark.llm import dual_tree_lloyd as D
from loomspark.llm import rotation_codes as R

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def groups(rng, n, sizes, spread, dims=64):
    """Random vectors, and groups of near copies about some of them."""
    x = rng.standard_normal((n, dims))
    near = [rng.standard_normal(dims) + spread * rng.standard_normal((s, dims)) for s in sizes]
    return np.concatenate([x, *near]).astype(np.float32)


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0) for i, v in rows], SCHEMA).repartition(3)


def brute(x, threshold=0.95):
    u = x.astype(np.float64)
    u /= np.sqrt((u * u).sum(1))[:, None]
    near = u @ u.T >= threshold
    np.fill_diagonal(near, False)
    label = np.arange(len(x))
    while True:
        low = np.where(near, label[None, :], len(x)).min(1)
        new = np.minimum(label, low)
        if (new == label).all():
            return near.sum(1), label
        label = new


@pytest.mark.parametrize(("block", "dims"), [(2048, 64), (40, 64), (2048, 7)])
def test_links_equal_all_pairs(spark, block, dims):
    rng = np.random.default_rng(5)
    x = groups(rng, 150, [60, 30, 2, 2, 90], 0.15, dims)
    x = np.concatenate([x, x[:3], 2 * x[:2], np.repeat(x[-1:], 50, axis=0)])
    want, label = brute(x)
    assert want.max() > 80
    got = R.near_duplicates(frame(spark, enumerate(x)), block=block).orderBy("vec_id").collect()
    assert [r.n_links for r in got] == want.tolist()
    assert [r.component_id for r in got] == label.tolist()
    assert [r.kept for r in got] == (label == np.arange(len(x))).tolist()


def test_chains_of_links_are_one_component(spark):
    turn = np.arange(40) * 0.25
    x = np.zeros((40, 64))
    x[:, 0], x[:, 1] = np.cos(turn[:]), np.sin(turn)
    x = x[:12]
    want, label = brute(x)
    got = R.near_duplicates(frame(spark, enumerate(x))).orderBy("vec_id").collect()
    assert label.max() == 0 and [(r.n_links, r.component_id) for r in got] == [(n, 0) for n in want]


def test_odd_vectors_link_to_nothing(spark):
    a, b = [1.0] * 8, [0.5] * 8
    rows = [(1, a), (2, b), (2, b), (None, a), (4, None), (5, []), (6, [0.0] * 8), (7, [None, *a[1:]]), (8, [float("nan"), *a[1:]]), (9, [float("inf"), *a[1:]]), (10, [1.0] * 9), (None, [0.0]), (11, [-0.0, 3e38]), (12, [0.0, 1e-38])]
    got = R.near_duplicates(frame(spark, rows)).collect()
    found = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=repr)
    want = [(1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (None, 3, 1, False), (None, 0, None, True), (11, 1, 11, True), (12, 1, 11, False)]
    assert found == sorted(want + [(i, 0, i, True) for i in (4, 5, 6, 7, 8, 9, 10)], key=repr)
    assert R.near_duplicates(frame(spark, [(i, None) for i in range(2)])).filter("kept").count() == 2
    assert R.near_duplicates(frame(spark, rows).filter("false")).count() == 0


def test_estimates_are_unbiased_and_within_their_bound():
    rng = np.random.default_rng(1)
    u = R.units([x.tobytes() for x in rng.standard_normal((300, 64))], "<f8")
    for cosine in (0.0, 0.5, 0.95):
        q = rng.standard_normal(u.shape)
        q -= (q * u).sum(1)[:, None] * u
        v = cosine * u + np.sqrt(1 - cosine**2) * q / np.sqrt((q * q).sum(1))[:, None]
        code, factors = R.encode(u, 5)
        found = (R.turned(v, 5) * R.corrected(code, factors, 64)).sum(1)
        assert abs(found.mean() - cosine) < 0.01
        assert (found >= cosine - R.allowance(factors, 64, cosine)).all()


def test_pairs_on_the_threshold_meet():
    for n in (10, 10_000, 10**9):
        bits, many = R.bands(n)
        assert 1 - (1 - (1 - np.arccos(0.95) / np.pi) ** bits) ** many >= R.MEET


def plain(x, ids, k, rounds):
    c = x[sorted(range(len(ids)), key=lambda i: hashlib.sha256(f"2:{ids[i]}".encode()).hexdigest())[:k]]
    away = lambda c: ((x[:, None, :] - c[None, :, :]) ** 2).sum(2)
    for _ in range(rounds):
        of = away(c).argmin(1)
        c = np.array([[int(t) // int((of == j).sum()) for t in x[of == j].sum(0)] if (of == j).any() else c[j] for j in range(len(c))])
    d = away(c)
    return d.argmin(1), d.min(1), c


@pytest.mark.parametrize(("scale", "dims", "k"), [(256, 64, 40), (3, 2, 25), (1, 1, 7), (100_000, 4, 10)])
def test_clusters_equal_plain_rounds(spark, scale, dims, k):
    """Few values, so that vectors and distances tie, and large ones beyond double precision's integers."""
    rng = np.random.default_rng(8)
    v = groups(rng, 1500, [300, 200], 0.05, dims)
    v = np.concatenate([v, v[:50], 200 * v[:20] if scale == 100_000 else v[:1]])
    x = np.floor(scale * v.astype(np.float64)).astype(np.int64)
    cluster, distance, c = plain(x, range(len(x)), k, 5)
    got = D.cluster(frame(spark, enumerate(v)), k=k, dims=dims, scale=scale).orderBy("vec_id").collect()
    assert [r.cluster for r in got] == cluster.tolist()
    assert [r.distance for r in got] == distance.tolist()
    assert {r.inertia for r in got} == {distance.sum()}
    assert all(r.cluster_inertia == distance[cluster == r.cluster].sum() for r in got[:50])
    assert got[0].centroid_sha256 == hashlib.sha256(",".join(map(str, c[got[0].cluster].tolist())).encode()).hexdigest()


def test_a_cover_tree_covers_and_parts():
    rng = np.random.default_rng(2)
    x = np.floor(256 * groups(rng, 300, [100, 50], 0.02, 8)).astype(np.int64)
    order, nodes = D.cover_tree(x)
    y = x[order]
    assert sorted(order) == list(range(len(x)))
    for n in nodes:
        far = np.sqrt(((y[n["lo"] : n["hi"]] - y[n["lo"]]) ** 2).sum(1))
        assert far.max() <= n["radius"] + 1e-9
        if n["last"] > n["first"]:
            own = nodes[n["first"] : n["last"]]
            assert own["lo"][0] == n["lo"] and own["hi"][-1] == n["hi"] and (own["lo"][1:] == own["hi"][:-1]).all()
            assert (own["radius"] <= n["radius"] / 2 + 1e-9).all()
            heads = y[own["lo"]]
            assert (np.sqrt(((heads[:, None] - heads[None]) ** 2).sum(2))[~np.eye(len(heads), dtype=bool)] > n["radius"] / 2 - 1e-9).all()
    settled: list = []
    D.nearest(y, nodes, x[::50], D.centroid_tree(x[::50]), settled)
    assert any(hi - lo > 8 for lo, hi, _ in settled), "tight groups are assigned whole"


def test_odd_vectors_are_left_out(spark):
    a = [0.1] * 64
    rows = [(1, a), (2, a), (2, a), (None, a), (4, None), (5, a[1:]), (6, [None, *a[1:]]), (7, [float("nan"), *a[1:]]), (8, [float("-inf"), *a[1:]]), (9, [1e9, *a[1:]])]
    got = D.cluster(frame(spark, rows).withColumnRenamed("label", "cluster")).collect()
    assert sorted((r.vec_id or 0, r.cluster, r.distance) for r in got) == [(0, 0, 0), (1, 0, 0), (2, 0, 0), (2, 0, 0)]
    assert D.cluster(frame(spark, rows).filter(F.lit(False))).count() == 0
