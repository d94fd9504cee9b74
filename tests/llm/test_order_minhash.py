"""Near-duplicate classes against all pairs by brute force."""

import random
from difflib import SequenceMatcher

import numpy as np
import pytest

from loomspark.llm import graph, order_minhash

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_alignment_is_the_longest_common_subsequence():
    rng = random.Random(3)
    s = order_minhash.Shingler()
    for _ in range(60):
        words = [rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(1, 40))]
        other = list(words)
        for _ in range(rng.randint(0, 4)):
            other[rng.randrange(len(other))] = rng.choice("abcxyz")
        if rng.random() < 0.3:
            k = rng.randrange(len(other))
            other = other[k:] + other[:k]
        a, b = s.labelled(words), s.labelled(other)
        m = lcs(a.tolist(), b.tolist())
        assert order_minhash.aligned(a, b, 0.0) == m
        sim = m / (len(a) + len(b) - m)
        assert order_minhash.aligned(a, b) in ((m,) if sim >= 0.8 else (0, *range(1, m + 1)))
        assert order_minhash.longest_rising([np.array([3, 1, 2, 2, 5])]) == 3


def shingled(text):
    """Plain five-word shingles, read apart from the operator's hashes."""
    w = (text or "").lower().split()
    return [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []


def common(a, b):
    """Longest common subsequence, by a table; what both begin and end with is matched first."""
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    a, b = a[n:], b[n:]
    while a and b and a[-1] == b[-1]:
        a, b, n = a[:-1], b[:-1], n + 1
    return n + (lcs(a, b) if a and b else 0)


def brute(rows, by_row=False):
    """Class of each id, from all pairs of texts."""
    rows = [(i, shingled(t)) for i, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    seen = {}
    for k, (i, s) in enumerate(rows):
        for j, other in seen.items():
            if find(j) == find(k) or not s or not other or min(len(s), len(other)) < 0.79 * max(len(s), len(other)):
                continue
            if s != other and len(set(s) & set(other)) * 2.5 < min(len(set(s)), len(set(other))):  # far below what 0.8 needs
                continue
            m = common(s, other)
            if m >= 0.8 * (len(s) + len(other) - m):
                parent[find(k)] = find(j)
        if s and i is not None:
            seen[k] = s
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    out = [least.get(find(k)) for k in range(len(rows))]
    return out if by_row else {i: c for (i, _), c in zip(rows, out, strict=True)}


def test_classes_match_brute_force(spark):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(3, 300))]
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.choice((0, 0, 1, 2, len(base) // 60, len(base) // 25))):
                k = rng.randrange(len(copy))
                copy[k : k + rng.randint(0, 1)] = [rng.choice(vocabulary)] * rng.randint(0, 2) or [rng.choice(vocabulary)]
            rows.append((n, " ".join(copy)))
            n += 1
    rng.shuffle(rows)
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "one"), (1004, "ONE"), (1005, "a b c d"), (1006, "a  b c\td"), (1007, "x " * 500), (1008, "x " * 510), (1009, "x " * 900)]
    d = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOC)
    got = {r.doc_id: r.class_id for r in order_minhash.classes(d).collect()}
    assert got == brute(rows)
    kept = order_minhash.keep(d).collect()
    assert sorted(r.doc_id for r in kept) == sorted(i for i, c in got.items() if i == c)


def test_real_rows_recall(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r.class_id for r in order_minhash.classes(d).collect()}
    assert got == brute([(r.doc_id, r.text) for r in d.collect()])
    assert SequenceMatcher is not None


def test_odd_rows(spark):
    """An id of two different texts has a class for each, and neither text is lost."""
    rows = [(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (9, "A b c d e  f"), (5, "other words stand here now ok"), (None, "a b c d e f"), (6, None), (6, None), (4, "other words stand here now OK")]
    d = spark.createDataFrame([(i, t, str(k), None, k) for k, (i, t) in enumerate(rows)], "doc_id bigint, text string, `raw` string, class_id string, node int")
    got = sorted((r.doc_id or -1, r.class_id or -1) for r in order_minhash.classes(d).collect())
    assert got == [(-1, -1), (-1, -1), (4, 4), (5, 4), (5, 5), (5, 5), (6, 6), (6, 6), (9, 5)]
    left = order_minhash.keep(d)
    assert left.columns == d.columns and sorted((r.doc_id or -1, r.text or "") for r in left.collect()) == [(-1, "a b c d e f"), (-1, "a b c d e f"), (4, "other words stand here now OK"), (5, "a b c d e f"), (6, "")]
    assert order_minhash.classes(d.limit(0)).count() == order_minhash.keep(d.limit(0)).count() == 0


def test_short_texts_meet_exactly(spark):
    """Four shingles within five are a link of 0.8, and none is left to chance."""
    rng = random.Random(4)
    rows = []
    for k in range(300):
        words = [f"s{k}x{i}" for i in range(9)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[1:] if rng.random() < 0.5 else words[:-1]))]
    d = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOC)
    assert {r.doc_id: r.class_id for r in order_minhash.classes(d).collect()} == {i: i - i % 2 for i, _ in rows}


def test_pairs_just_on_the_threshold():
    """Whole numbers decide: of n shingles all but n / 9 match at exactly 0.8."""
    for n in range(1, 400):
        a, b = np.arange(5 * n, dtype=np.uint64), np.arange(5 * n, dtype=np.uint64)
        b = b[: 4 * n]
        assert order_minhash.aligned(a, b) == 4 * n and order_minhash.similarity(a, b) == pytest.approx(0.8)
        assert order_minhash.aligned(a, b[:-1]) == 0


def test_links_between_copies_of_a_hub_on_the_threshold(spark):
    """Texts of few shingles that meet in small buckets, where distances to the hub stand just on the bound."""
    rng = random.Random(21)
    rows = []
    for k in range(60):
        words = [f"h{k}x{i}" for i in range(rng.choice((9, 14, 18, 22, 40)))]
        for j in range(5):
            cut = rng.randint(0, max(1, len(words) // 9))
            rows.append((5 * k + j, " ".join(words[cut:] if rng.random() < 0.5 else words[: len(words) - cut])))
    d = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOC)
    assert {r.doc_id: r.class_id for r in order_minhash.classes(d).collect()} == brute(rows)


def test_buckets_of_many_classes(spark, monkeypatch):
    """Texts of common lines in many variants: large mixed buckets, searched by their rarest shingles."""
    monkeypatch.setattr(order_minhash, "FEW", 3)
    monkeypatch.setattr(order_minhash, "RARE", 4)
    monkeypatch.setattr(order_minhash, "PART_ROWS", 5)
    rng = random.Random(8)
    lines = [" ".join(f"l{k}x{i}" for i in range(rng.randint(6, 14))) for k in range(14)]
    rows = []
    for i in range(160):
        some = rng.sample(range(14), rng.randint(6, 12)) if i % 3 else [k for k in range(14) if rng.random() < 0.85]
        rows.append((i, " ".join(lines[k] for k in some) + f" own{i} tail{i % 7}"))
    d = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOC)
    want = brute(rows)
    assert {r.doc_id: r.class_id for r in order_minhash.classes(d).collect()} == want and 3 < len(set(want.values())) < 160


def test_a_lost_repeat_costs_only_itself(spark):
    rng = random.Random(17)
    s, rows, links = order_minhash.Shingler(), [], []
    for n, (line, own, times) in enumerate(((12, 40, 20), (20, 60, 10))):
        refrain = [f"r{n}x{i}" for i in range(line)]
        parts = [[f"o{n}x{rng.randrange(100000)}" for _ in range(own)] for _ in range(times)]
        words = [w for p in parts for w in refrain + p]
        a, b = s.plain(words), s.plain(words[line:])
        links.append(lcs(a.tolist(), b.tolist()) / len(a))
        assert order_minhash.similarity(a, b) == pytest.approx(links[-1]) and links[-1] > 0.97
        rows += [(2 * n, " ".join(words)), (2 * n + 1, " ".join(words[line:]))]
    d = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOC)
    assert {r.doc_id: r.class_id for r in order_minhash.classes(d).collect()} == {0: 0, 1: 0, 2: 2, 3: 2}
    assert sorted(r.doc_id for r in order_minhash.keep(d).collect()) == [0, 2]


def test_alignment_of_repeated_shingles():
    rng = random.Random(23)
    for k in range(300):
        alphabet = rng.choice((1, 2, 5, 30, 200))
        a = [rng.randrange(alphabet) for _ in range(rng.randint(0, 60))]
        b = list(a)
        for _ in range(rng.randint(0, 12)):
            at = rng.randint(0, len(b))
            b[at : at + rng.randint(0, 4)] = [rng.randrange(alphabet) for _ in range(rng.randint(0, 4))]
        x, y, m = np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64), lcs(a, b)
        assert order_minhash.aligned(x, y, 0.0) == order_minhash.common_bits(x, y) == m, k
        if m >= 0.8 * (len(a) + len(b) - m):
            assert order_minhash.aligned(x, y) == m, k


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(50)] + [(100, x) for x in range(101, 140)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.node: r.component for r in got} == {x: find(x) for x in parent} and len(got) == len(parent)


def test_alignments_of_repeats_need_bounded_memory(monkeypatch):
    """Matches a few at a time and bits of few shingles give the same; long texts with repeats stay small."""
    import tracemalloc

    rng = np.random.default_rng(3)
    for _ in range(60):
        a = rng.integers(0, rng.integers(2, 30), rng.integers(5, 80))
        b = np.delete(a, rng.integers(0, len(a)))
        want = order_minhash.common_bits(a, b)
        with monkeypatch.context() as m:
            m.setattr(order_minhash, "EXPANDED", 3)
            m.setattr(order_minhash, "MASK_BYTES", 2)
            assert order_minhash.common_bits(a, b) == want and order_minhash.aligned(a, b, 0.0) == want
    n = 200_000
    for a in (rng.integers(0, 1000, n), rng.integers(0, n // 3, n)):
        b = np.delete(a, rng.integers(0, n, n // 50))
        tracemalloc.start()
        assert order_minhash.aligned(a, b) > 0.95 * n
        assert tracemalloc.get_traced_memory()[1] < 300 << 20
        tracemalloc.stop()
