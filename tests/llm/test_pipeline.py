"""The pipeline against its stages by brute force."""

from collections import defaultdict

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from loomspark.llm import packing, quality_ledger, suffix_index  # noqa: E402

from .test_order_minhash import brute as near_classes  # noqa: E402
from .test_rowwise import bench_words  # noqa: E402

SF = "/root/testdata/sf0.001"


def expected(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    docs = {i: t for i, t in docs.items() if quality_ledger.measure(t)[-1] & quality_ledger.POLICIES[2].mask == 0}
    cls = near_classes(list(docs.items()))
    docs = {i: t for i, t in docs.items() if cls[i] == i}
    first = {}
    for i in sorted(docs):
        b = docs[i].encode()
        for k in range(len(b) - 49):
            first.setdefault(b[k : k + 50], i)
    left = {}
    for i, t in docs.items():
        b = t.encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < i:
                gone[k : k + 50] = b"\1" * 50
        s = bytes(x for x, g in zip(b, gone, strict=True) if not g).decode("utf-8", "ignore")
        if s or not any(gone):
            left[i] = s
    wins = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = bench_words(r.text)
        n = min(13, len(w))
        wins |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
    sizes = {len(w) for w in wins}
    out = {}
    for i, t in left.items():
        w, hit = bench_words(t), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in wins:
                    hit.update(range(k, k + n))
        if not hit or 20 * len(hit) < len(w):
            out[i] = t
    return out


def test_run_matches_brute_force(spark):
    want = expected(spark)
    got = defaultdict(list)
    for r in corpus_pipeline.run(spark, SF).collect():
        got[r.doc_id].append(r)
    assert got.keys() == want.keys() and len(want) > 50
    code = packing.WordCoder(packing.default_tokenizer())
    for i, raw in zip(want, code.encode(list(want.values())), strict=True):
        assert sum(r.length for r in got[i]) == len(raw) // 4 + 1 == got[i][0].doc_tokens


def test_stages_pass_documents_on(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_passages", "benchmark_overlap", "pack"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_removal_keeps_other_columns(spark):
    rows = [(1, "x" * 60 + "é", "fr", None, 61), (2, "x" * 60, None, "s", 60), (None, "x" * 60, "a", "b", 3), (3, "", "l", "s", 0), (4, "é" + "x" * 70, "l", "s", 0)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r.doc_id: tuple(r) for r in suffix_index.remove(d).collect()}
    # row 2 is nothing but the passage; row 4 keeps what no window of row 1 covers
    assert got == {1: rows[0], None: rows[2], 3: rows[3], 4: (4, "é", "l", "s", 0)}


def test_run_on_odd_rows(spark, tmp_path):
    """Nulls, repeats, shared ids, long texts and clashing columns through all stages; nothing is left in the shared folder but the result."""
    import os
    import random

    from loomspark.llm import common

    rng = random.Random(3)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n))
    a, b, c, passage, long = prose(80), prose(90), prose(100), prose(70), prose(30_000)
    bench = " ".join(f"item{k}" for k in range(40))
    rows = [
        (None, a), (None, b), (None, None), (5, a), (5, a), (5, c), (6, None), (6, ""), (7, a + " end"), (8, b), (9, c + " " + passage), (10, prose(60) + " " + passage),
        (11, bench + " " + prose(20)), (11, prose(90)), (12, long), (13, "too short"), (14, prose(400) + " " + bench),
    ]
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint, `row` int, rest string, raw string, ledger int"
    spark.createDataFrame([(i, t, None, "s", None, k, "r", "w", 1) for k, (i, t) in enumerate(rows)], kind).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, bench), (None, None)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    shared = common.shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(shared))
    got = corpus_pipeline.run(spark, str(tmp_path))
    tokens = defaultdict(list)
    for r in got.filter("start = 0").collect():
        tokens[r.doc_id].append(r.doc_tokens)
    left = [x for x in os.listdir(shared) if x not in before]
    # of (null, a) and (5, a), (5, a), (7, a + end) the null row and one row 5 stay; (5, c) is another text
    assert {i: len(v) for i, v in tokens.items()} == {None: 2, 5: 2, 8: 1, 9: 1, 10: 1, 11: 1, 12: 1, 14: 1}
    assert len(left) == 1 and left[0].startswith("pipeline-pack")
    empty = str(tmp_path / "none")
    spark.createDataFrame([], kind).write.parquet(empty + "/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(empty + "/benchmark.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
    common.release(spark)


def test_stages_read_bounded_batches(spark):
    """Workers of a stage get few MB at a time, however many short rows there are; a session's own bound stands."""
    import pyarrow as pa

    from loomspark.llm import common

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    rows = spark.range(0, 9_000, 1, 1).selectExpr("id AS doc_id", "repeat(cast(id AS string), 1000) AS text", "'' AS lang", "'' AS source", "0L AS n_chars")
    own = spark.conf.get(common._BATCHES, None)
    try:
        spark.conf.unset(common._BATCHES)
        corpus_pipeline.STAGES[2][1](spark, rows.limit(0), SF)
        found = [r.n for r in rows.mapInArrow(sizes, "n bigint").collect()]
        assert sum(found) > 30_000_000 and max(found) < 1.2 * common.BATCH_BYTES
        spark.conf.set(common._BATCHES, "9000000")
        corpus_pipeline.STAGES[2][1](spark, rows.limit(0), SF)
        assert spark.conf.get(common._BATCHES) == "9000000"
    finally:
        spark.conf.unset(common._BATCHES) if own is None else spark.conf.set(common._BATCHES, own)
