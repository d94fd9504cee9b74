"""Alignment of two tokenizers against a plain one of whole texts."""

import hashlib
import random
from collections import Counter

import pytest

from loomspark.llm import token_alignment as T

COLUMNS = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
ODD = [
    (1, "a b"), (2, "  a  b "), (3, "<s> <0x41> é▁x"), (4, "\x00a\nb"), (5, ""), (6, None), (7, "ﬁ ① ＡＢ\n\nx\n y \n\nz \x1cq\x0bw"), (8, "don't  　x’s 12345 a1b2"),
    (9, "<|endoftext|> <unk> </s>"), (9, "word\nWord\n- x\n\t\ty\r\nz "), (None, " "), (10, "\n"), (11, "́x \xa0 y​ z w"), (12, "naïve Ünïcode 日本語テキスト 🙂🙂 mixed_text_1 x" * 50),
    (13, "a " * 3000), (14, "x" * 5000), (15, "... ,,, a.b.c (d) [e] {f}\n* item\n* item2"), (16, "_a _b__ \x85q \x1f z"), (1, "a b"),
]


def brute(rows):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    s = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    level, token = T._byte_level(), {i: w for w, i in t.get_vocab().items()}
    side_a = lambda i: bytes(level[c] for c in token[i])
    side_b = lambda i: bytes([int(s.id_to_piece(i)[3:5], 16)]) if s.is_byte(i) else s.id_to_piece(i).replace("▁", " ").encode()
    held, docs = Counter(), []
    for doc, text in rows:
        a, b = (t.encode(" " + text, add_special_tokens=False).ids, s.encode(text)) if text else ([], [])
        bytes_a, bytes_b = [side_a(i) for i in a], [side_b(i) for i in b]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            docs.append((doc, None))
            continue
        ends = [{sum(map(len, x[: i + 1])): i + 1 for i in range(len(x))} if len(x) < 400 else running(x) for x in (bytes_a, bytes_b)]
        cuts = sorted(ends[0].keys() & ends[1].keys())
        groups, i, j = [], 0, 0
        for c in cuts:
            groups.append((a[i : ends[0][c]], b[j : ends[1][c]]))
            i, j = ends[0][c], ends[1][c]
        pairs = Counter((p, q) for x, y in groups for p in x for q in y)
        held.update(pairs.keys())
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        docs.append((doc, (len(a), len(b), len(groups), pairs, hashlib.sha256(written.encode()).hexdigest())))
    top = {}
    for (p, _), n in held.items():
        top[p] = max(top.get(p, 0), n)
    for doc, found in docs:
        if found is None:
            yield (doc, 0, 0, 0, 0, 0, 0, "")
        else:
            pairs = found[3]
            yield (doc, *found[:3], sum(pairs.values()), sum(n for p, n in pairs.items() if held[p] == top[p[0]]), sum(n * held[p] for p, n in pairs.items()), found[4])


def running(parts):
    out, at = {}, 0
    for i, x in enumerate(parts):
        at += len(x)
        out[at] = i + 1
    return out


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_odd_texts(spark):
    docs = spark.createDataFrame([(*r, 3) for r in ODD], "doc_id bigint, text string, a int").repartition(3)
    assert rows_of(T.align(docs)) == sorted(brute(ODD), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_in_small_parts(spark, seed, monkeypatch):
    """Units are forgotten, texts are longer than a part and chunks hold few documents."""
    for name, value in (("UNITS_KEPT", 60), ("PART_CHARS", 150), ("CHUNK_CHARS", 500), ("HELD", 50), ("TOGETHER", 7)):
        monkeypatch.setattr(T, name, value)
    rng = random.Random(seed)
    words = ["the", "Über", "don't", "12", "x.y", "...", "\n", "\n\n", "  ", "\t", "日本", "é", "▁", "🙂", "a" * 70, "foo_bar", " ", "\xa0"]
    rows = [(i, "".join(rng.choice(words) + rng.choice([" ", "", "\n"]) for _ in range(rng.choice([0, 3, 40, 400])))) for i in range(25)]
    task = lambda batches: T._encode(batches, T.default_tokenizers())
    import pyarrow as pa

    class Context:
        partitionId = staticmethod(lambda: 2)  # noqa: N815

    monkeypatch.setattr(T, "TaskContext", type("C", (), {"get": staticmethod(lambda: Context)}))
    T._aligners.clear()
    out = pa.Table.from_batches(list(task(pa.table({"doc_id": pa.array([r[0] for r in rows]), "text": pa.array([r[1] for r in rows])}).to_batches(max_chunksize=4))))
    T._aligners.clear()
    want = {r[0]: r for r in brute(rows)}
    for r in out.to_pylist():
        if r["a"] is None:
            assert tuple(r[c] for c in COLUMNS[:5]) + (r["groups_sha256"],) == want[r["doc_id"]][:5] + (want[r["doc_id"]][7],)


def test_a_hot_id_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(T, "PARTS", 50)
    rows = [(i, "the same words and others " + str(i * 7919)) for i in range(400)]
    assert rows_of(T.align(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8))) == sorted(brute(rows), key=repr)


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert T.align(docs).count() == 0
    assert rows_of(T.align(spark.createDataFrame([(1, None)], "doc_id bigint, text string"))) == [(1, 0, 0, 0, 0, 0, 0, "")]
