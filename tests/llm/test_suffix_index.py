"""Exact substring removal against brute force."""

import hashlib
import random

import numpy as np

from loomspark.llm import suffix_index

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def brute(rows, length=50):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - length + 1):
            if i is not None:
                w = b[k : k + length]
                first[w] = min(first.get(w, i), i)
    out = {}
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if i is not None and first[b[k : k + length]] < i:
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = sum(g and not (j and gone[j - 1]) for j, g in enumerate(gone))
        out.setdefault((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()), 0)
        out[(i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())] += 1
    return out


def check(spark, rows):
    d = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOC).repartition(5)
    got = {}
    for r in suffix_index.digests(d).collect():
        k = (r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
        got[k] = got.get(k, 0) + 1
    assert got == brute(rows)


def test_odd_cases(spark):
    rng = random.Random(1)
    base = "".join(rng.choice("abcdefgh é") for _ in range(400))
    passage = "".join(rng.choice("xyz ") for _ in range(50))
    rows = [(0, None), (1, ""), (2, base), (3, base), (4, base[:49]), (5, base[10:60]), (6, base[10:59]), (7, "q" + base[100:180] + "r" + base[300:]), (8, "a" * 300), (9, "a" * 49 + "b" + "a" * 120)]
    rows += [(10, "a" * 49), (11, "aa" * 25), (12, base + base), (13, "12" + passage + "34"), (14, "56" + passage + "78"), (15, passage), (15, passage), (15, "z" + passage), (None, base), (None, passage)]
    rows += [(-3, passage[:30] + "0" + passage), (1 << 60, base[::-1]), (1 << 61, base[::-1] + "x" * 60), (20, "\0" * 80), (21, "\0" * 60 + "b"), (22, "\0" * 50)]
    check(spark, rows)


def test_real_rows(spark):
    got = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    check(spark, [(r.doc_id, r.text) for r in got])


def test_random_overlaps(spark):
    rng = random.Random(7)
    pieces = ["".join(rng.choice("ab c") for _ in range(rng.randint(20, 90))) for _ in range(12)]
    rows = [(rng.randint(0, 60), "".join(rng.choice(pieces) for _ in range(rng.randint(1, 8)))) for _ in range(80)]
    check(spark, rows)


def test_empty_table(spark):
    assert suffix_index.digests(spark.createDataFrame([], DOC)).count() == 0


def test_levels_merge_geometrically():
    family = suffix_index.Levels("test")
    rng = np.random.default_rng(0)
    known = {}
    for doc in range(40):
        keys = np.unique(rng.integers(0, 3000, 100)).astype("S8")
        keys = np.sort(keys)
        want = np.array([known.get(k, np.iinfo(np.int64).max) for k in keys])
        assert (family.least(keys) == want).all()
        for k in keys:
            known.setdefault(k, doc)
        family.add(keys, np.minimum(want, doc))
    assert len(family.levels) <= 8 and sorted(known) == sorted(set(np.concatenate([x for x, _ in family.levels])))


def test_frequent_grams_split_their_suffixes(spark, monkeypatch):
    def every(rows, buckets):
        texts = [bytes(r.data) for r in rows.collect()]
        return np.unique(suffix_index._grams(texts))

    monkeypatch.setattr(suffix_index, "frequent_grams", every)
    test_odd_cases(spark)
    test_random_overlaps(spark)
    test_real_rows(spark)


def test_frequent_grams_are_found(spark):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice("abcdefgh") for _ in range(40)) + "[common]" + "".join(rng.choice("abcdefgh") for _ in range(40))) for i in range(400)]
    d = spark.createDataFrame([(t.encode(),) for _, t in rows], "data binary")
    assert len(suffix_index.frequent_grams(d, 12)) <= 24
    assert len(suffix_index.frequent_grams(d.limit(0), 12)) == 0
    check(spark, rows[:60])


def test_levels_are_asked_while_they_hold_something(spark, monkeypatch):
    """Several levels of a bucket are scanned and merged, and the result stays exact."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    texts = [(r.doc_id, 0, (r.text or "").encode(), 0) for r in sorted(rows, key=lambda r: r.doc_id)]
    keys, text, start, count, before, _ = suffix_index._sampled(texts, 0)
    ids = np.array([t[0] for t in texts])[text]
    asked, merged = {"suffix": [], "window": []}, []
    least, add = suffix_index.Levels.least, suffix_index.Levels.add

    def counted(self, some):
        asked[self.kind].append(len(self.levels))
        return least(self, some)

    def joined(self, *some):
        before = len(self.levels)
        add(self, *some)
        merged.append(len(self.levels) <= before)

    monkeypatch.setattr(suffix_index.Levels, "least", counted)
    monkeypatch.setattr(suffix_index.Levels, "add", joined)
    got = suffix_index.bucket_spans(keys, count, before, ids, 1 << 12)
    assert max(asked["suffix"]) >= 3 and sum(asked["suffix"]) > 20 and max(asked["window"]) >= 2 and sum(merged) > 5
    gone = {}
    for i, f, n in zip(*(x.tolist() for x in got), strict=True):
        gone.setdefault(text[i], set()).update(range(start[i] + f, start[i] + n + suffix_index.LENGTH))
    want = brute([(i, b.decode()) for i, _, b, _ in texts])
    out = {}
    for k, (i, _, b, _) in enumerate(texts):
        g = gone.get(k, set())
        kept = bytes(x for j, x in enumerate(b) if j not in g)
        row = (i, len(b), len(g), sum(j in g and j - 1 not in g for j in range(len(b))), hashlib.sha256(kept).hexdigest())
        out[row] = out.get(row, 0) + 1
    assert out == want


def test_suffix_array_orders_bytes():
    rng = np.random.default_rng(3)
    raw = rng.integers(97, 99, (4000, 24)).astype(np.uint8)
    raw[:, :20] = 97
    keys, docs = raw.view("S24").ravel(), rng.integers(0, 9, 4000)
    order, heads = suffix_index.suffix_array(keys, docs)
    assert [(bytes(keys[i]), docs[i]) for i in order] == sorted((bytes(k), d) for k, d in zip(keys, docs, strict=True))
    assert (keys[order[heads]] == np.unique(keys)).all()
    assert all(len(x) == 0 for x in suffix_index.suffix_array(keys[:0], docs[:0]))


def test_removal_carries_any_columns(spark):
    import datetime
    from decimal import Decimal

    at = datetime.datetime(2020, 1, 2, 3, 4, 5, 123456)
    rows = [(1, "x" * 80, at, Decimal("1.25"), [1, None], "a"), (2, "y" + "x" * 80, None, None, None, None), (None, None, at, Decimal("7.00"), [], "b")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, `rest` timestamp, data decimal(9,2), spans array<int>, bucket string")
    got = {r.doc_id: tuple(r) for r in suffix_index.remove(d).collect()}
    assert got == {1: rows[0], 2: (2, "y", None, None, None, None), None: (None, "", *rows[2][2:])}
    assert suffix_index.remove(d.select("text", "doc_id")).columns == ["text", "doc_id"]


def test_stored_index_takes_batches(spark, tmp_path):
    """Batches lose what earlier ones hold; stored levels merge geometrically."""
    rng = random.Random(11)
    pieces = ["".join(rng.choice("ab cdé") for _ in range(rng.randint(20, 120))) for _ in range(60)]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randint(1, 6)))) for i in range(360)]
    earlier, want, sizes = set(), {}, []
    got = {}
    for at in range(0, len(rows), 60):
        batch = rows[at : at + 60]
        own = [*((-1000 - i, w) for i, w in enumerate(sorted(earlier))), *((i, t) for i, t in batch)]
        left = exact_texts(own)
        want |= {i: left[i] for i, _ in batch if i in left}
        earlier |= {t for _, t in batch}
        index = suffix_index.SuffixIndex(spark, str(tmp_path / "index"))  # read again each time
        d = spark.createDataFrame([(i, t, i % 3) for i, t in batch], "doc_id bigint, text string, rest int")
        for r in index.add(d).collect():
            assert r.rest == r.doc_id % 3
            got[r.doc_id] = r.text
        sizes.append(len(index.level_rows))
    assert got == want and 1 <= min(sizes) and max(sizes) <= 4 and sizes[-1] < len(sizes)
    assert index.add(d.limit(0)).count() == 0
    assert index.add(d).count() == 0


def exact_texts(rows, length=50):
    """Texts that are left, by brute force; rows with negative ids lose nothing."""
    first = {}
    for i, t in rows:
        b = t.encode()
        for k in range(len(b) - length + 1):
            first[b[k : k + length]] = min(first.get(b[k : k + length], i), i)
    out = {}
    for i, t in rows:
        b, gone = t.encode(), set()
        for k in range(len(b) - length + 1):
            if first[b[k : k + length]] < i:
                gone.update(range(k, k + length))
        if i >= 0 and len(gone) < len(b):
            text = bytes(x for j, x in enumerate(b) if j not in gone).decode("utf-8", "ignore")
            if text:
                out[i] = text
    return out


def test_memory_of_a_chunk_and_a_bucket():
    """At their most, a map task's chunk and a bucket hold less than 3.7 and 4.3 times their suffixes' bytes."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(11)
    data = rng.integers(97, 123, 4_000_000, dtype=np.uint8).tobytes()
    rows = [(k, k, data[k * 4000 : k * 4000 + 4000]) for k in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["doc_id", "row_hash", "data"])
    ends = np.cumsum([len(r[2]) for r in rows])
    keys = suffix_index._KEY * len(suffix_index.anchors(np.frombuffer(data + b"\0" * 16, dtype=np.uint8), ends)[0])

    def peak(run, batches):
        tracemalloc.start()
        try:
            out = list(run(iter(batches)))
            return out, tracemalloc.get_traced_memory()[1] / keys
        finally:
            tracemalloc.stop()

    none = np.zeros(0, dtype=np.uint64)
    _, chunk = peak(suffix_index._suffix_blobs(40, 40, none), [batch])
    _, bucket = peak(suffix_index._bucket_runs(1), list(suffix_index._suffix_blobs(1, 1, none)(iter([batch]))))
    assert chunk < 3.7 and bucket < 4.3
