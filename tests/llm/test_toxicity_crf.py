"""The tagger's marginals against enumeration, and its scores on rows that it hasn't learnt from."""

import itertools
import zlib

import numpy as np
import pytest

from loomspark.llm import toxicity_crf as X

SF = "/root/testdata/sf0.1"


def test_marginals_match_enumeration():
    rng = np.random.default_rng(0)
    for lengths in ([1], [3, 4], [1, 1, 5, 2]):
        e, arcs = rng.normal(size=sum(lengths)) * 2, rng.normal(size=(2, 2))
        starts = np.cumsum([0, *lengths[:-1]])
        got, arcs_seen = X.marginals(e, starts, arcs, pairs=True)
        want_arcs = np.zeros((2, 2))
        for a, n in zip(starts, lengths, strict=True):
            z, p, pairs = 0.0, np.zeros(n), np.zeros((2, 2))
            for s in itertools.product((0, 1), repeat=n):
                w = np.exp(sum(e[a + i] for i in range(n) if s[i]) + sum(arcs[x, y] for x, y in itertools.pairwise(s)))
                z += w
                p += w * np.array(s)
                for x, y in itertools.pairwise(s):
                    pairs[x, y] += w
            assert got[a : a + n] == pytest.approx(p / z)
            want_arcs += pairs / z
        assert arcs_seen == pytest.approx(want_arcs)


def test_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = X.toxicity(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    own = [(r.score, toxic[r.doc_id]) for r in rows if r.held_out and r.doc_id in toxic]
    bad, good = [s for s, y in own if y], [s for s, y in own if not y]
    assert np.mean([(a > b) + 0.5 * (a == b) for a in bad for b in good]) > 0.93
    assert np.mean([(s >= 0.5) == y for s, y in own]) > 0.96
    texts = {r.doc_id: r.text for r in docs.collect()}
    shown = [texts[r.doc_id][s.start : s.stop] for r in rows for s in r.spans]
    assert any("idiot" in w.lower() for w in shown) and all(w and not w[0].isspace() for w in shown)


def test_labels_of_fold_0_are_not_learnt(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    from pyspark.sql import functions as F

    other = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r.doc_id: r.score for r in X.toxicity(docs, x).collect()} for x in (labels, other))
    assert a == b


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (None, "you idiot", "x"), (4, " \n ", "x"), (4, "w " * 9000, "x"), (5, "you idiot", "x")], "doc_id bigint, text string, toxic string")
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    flat = X.toxicity(docs, none).collect()
    assert len(flat) == 6 and {r.score for r in flat} == {0.5}
    texts = [(i, f"some plain words {i} here", 0) for i in range(40)] + [(100 + i, f"you idiot number {i} here", 1) for i in range(40)]
    learnt = X.learn(spark.createDataFrame([(i, t) for i, t, _ in texts], "doc_id bigint, text string"), spark.createDataFrame([(i, 1, y) for i, _, y in texts] + [(7, 1, None)], "doc_id bigint, quality int, toxic int"))
    got = X.score(docs, learnt).collect()
    by = {r.doc_id: r for r in got if r.doc_id != 4}
    assert by[5].score > 0.5 > by[1].score == by[2].score and by[5].spans[-1].stop <= 9
    assert X.score(docs.limit(0), learnt).count() == 0
