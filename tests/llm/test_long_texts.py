"""Texts longer than what operators take at a time."""

import random
import struct
import zlib

from pyspark.sql import functions as F

from loomspark.llm import decontamination, order_minhash, packing, pitman_yor, quality_ledger, suffix_index

KIND = "doc_id bigint, text string"


def test_removal_across_pieces(spark):
    rng = random.Random(1)
    letters = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    piece = 4 * suffix_index.PART_BYTES
    passage, head, tail = letters(300), letters(piece - 120), letters(200_000)
    rows = [(1, passage), (2, head + passage + tail), (3, letters(40) + tail[-1000:])]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in suffix_index.digests(spark.createDataFrame(rows, KIND)).collect()}
    assert got[1] == (300, 0, 0) and got[2] == (piece + 200_180, 300, 1) and got[3] == (1040, 1000, 1)


def test_packing_and_scoring_of_long_texts(spark):
    from tokenizers import Tokenizer

    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(3000)]
    text = " ".join(rng.choices(words, k=1_600_000))
    assert len(text) > 8_000_000
    d = spark.createDataFrame([(1, text), (2, "short one"), (3, text[:200])], KIND)
    pieces = packing.pieces(d.filter("doc_id = 1")).orderBy("start").collect()
    ids = [*Tokenizer.from_file(packing.default_tokenizer()).encode(text, add_special_tokens=False).ids, 2]
    assert sum(r.length for r in pieces) == len(ids) == pieces[0].doc_tokens
    for r in (pieces[0], pieces[len(pieces) // 2], pieces[-1]):
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *ids[r.start : r.start + r.length]))
    scored = {r.doc_id: r for r in pitman_yor.score(d).collect()}
    assert scored[1].n_tokens == 1_600_001 and scored[2].n_tokens == 3 and all(r.score < 0 for r in scored.values())
    assert quality_ledger.ledger(d).filter("doc_id = 1").first().n_words == 1_600_000
    assert {r.doc_id: r.class_id for r in order_minhash.classes(d).collect()} == {1: 1, 2: 2, 3: 3}
    bench = spark.createDataFrame([(7, " ".join(text.split()[800_000:800_020]))], "item_id bigint, text string")
    found = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in decontamination.contamination(d, bench).collect()}
    assert found[1] == (1_600_000, 20, 1) and found[2] == (2, 0, 0)
    assert F is not None
