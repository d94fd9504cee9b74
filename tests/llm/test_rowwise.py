"""Quality ledger, sharding, packing, archives and decontamination against brute force."""

import base64
import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from loomspark.llm import arc_to_warc, decontamination, packing, quality_ledger, sharding

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOC)


ODD = [None, "", " \n\t ", "a", "a b c d e f g h a b c d e f g h", "x\n\nx\nx \n\n", "é " * 30, "word " * 5000, "DE!! EN!! " * 40, "a|b #c$ <d>", "same text", "same text", "1 2 3"]


def repeats(ws):
    seen = Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
    hit = {i + j for i in range(len(ws) - 7) if seen[tuple(ws[i : i + 8])] > 1 for j in range(8)}
    return len(hit)


def check_quality(rows):
    for text, r in rows:
        ws = WORD.findall(text or "")
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        rep = repeats(ws)
        base = len(ws) < 20 or 100 * rep > 30 * len(ws)
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or "")), text
        assert (r.n_dup_lines, r.n_repeat_words, r.base_failed) == (len(lines) - len(set(lines)), rep, base), text
        assert not (r.base_failed and r.kept)


def test_quality_matches_brute_force(spark):
    for d in (docs(spark, ODD), spark.read.parquet(f"{SF}/documents.parquet")):
        texts = {r.doc_id: r.text for r in d.collect()}
        check_quality([(texts[r.doc_id], r) for r in quality_ledger.with_verdict(quality_ledger.ledger(d)).collect()])


def test_quality_keep_and_ablation_agree_with_the_ledger(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    book = quality_ledger.with_verdict(quality_ledger.ledger(d)).collect()
    assert {r.doc_id for r in book if r.kept} == {r.doc_id for r in quality_ledger.keep(d).collect()}
    for r in quality_ledger.ablation(quality_ledger.ledger(d)).collect():
        assert r.n_failed == sum(bool(x.fail_bits & r.bit) for x in book)
        assert r.n_rejected_by_it_alone == sum(x.fail_bits == r.bit for x in book)


def test_quality_keeps_plain_prose(spark):
    book = quality_ledger.with_verdict(quality_ledger.ledger(docs(spark, ["The quick brown fox jumps over a lazy dog near the river bank, and 5% of it is new & fine. " + " ".join(f"w{i}" for i in range(40))])))
    assert book.first().kept


def test_sharding_law_slots_and_growth(spark):
    d = docs(spark, [f"t{i}" for i in range(3000)] + ODD)
    rows = sharding.shard_documents(d, 8).collect()
    assert len(rows) == 3000 + len(ODD)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 8)
    assert sorted(slots) == list(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert 0.07 < sum(r.grown_shard == 8 for r in rows) / len(rows) < 0.16
    assert max(map(len, slots.values())) < 1.3 * min(map(len, slots.values()))
    by = {r.doc_id: r for r in rows}
    for i, t in enumerate(ODD):
        assert (by[3000 + i].size, by[3000 + i].text_crc32) == (len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))


def test_sharding_of_null_and_repeated_ids(spark):
    rows = [(None, "a"), (None, "b"), (None, "a"), (7, "x"), (7, "x"), (7, None), (8, ""), (9, "é" * 200_000)]
    d = spark.createDataFrame([(i, t, 1, 2, 3, 4) for i, t in rows], "doc_id bigint, text string, task int, at int, shard int, `row` int")
    got = sharding.shard_documents(d, 8).collect()
    assert sorted((r.doc_id or 0, r.size) for r in got) == sorted((i or 0, len((t or "").encode()) + 1) for i, t in rows)
    assert len({r.shard for r in got if r.doc_id is None}) == len({r.shard for r in got if r.doc_id == 7}) == 1
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = {tuple(r) for r in sharding.shard_documents(d.repartition(3), 8).collect()}
    assert again == {tuple(r) for r in got}
    assert sharding.shard_documents(d.limit(0)).count() == 0
    kept = sharding.with_slots(d)
    assert kept.columns == [*d.columns, "slot"] and kept.count() == len(rows)


def test_quality_of_null_and_repeated_ids(spark):
    good = " ".join(f"word{i}" for i in range(30))
    rows = [(None, good), (None, good), (None, None), (5, good), (5, "short"), (5, good), (6, " ".join(["spam eggs ham"] * 40)), (7, " ".join(f"w{i}" for i in range(200_000)))]
    d = spark.createDataFrame([(i, t, 1.5, k, "x") for k, (i, t) in enumerate(rows)], "doc_id bigint, text string, fail_bits double, `row` int, ledger string")
    left = quality_ledger.keep(d)
    assert left.columns == d.columns and sorted(r.row for r in left.collect()) == [0, 1, 3, 5, 7]
    assert quality_ledger.ledger(d).count() == len(rows) and quality_ledger.keep(d.limit(0)).count() == 0
    book = quality_ledger.ledger(d)
    pairs = {(r.old_kept, r.new_kept): r.n_docs for r in quality_ledger.compare(book, quality_ledger.POLICIES[1], quality_ledger.POLICIES[2]).collect()}
    assert sum(pairs.values()) == len(rows) and pairs[True, True] == 5


def test_jump_hash_matches_the_published_loop():
    import numpy as np

    def one(key, n):
        b, j = -1, 0
        while j < n:
            b = j
            key = (key * 2862933555777941757 + 1) % (1 << 64)
            j = int((b + 1) * (2147483648.0 / ((key >> 33) + 1)))
        return b

    keys = [0, 1, 7, (1 << 64) - 1, 123456789012345678] + [k * 0x9E3779B97F4A7C15 % (1 << 64) for k in range(200)]
    for n in (1, 2, 8, 9, 1000):
        assert sharding.jump_hash(np.array(keys, dtype=np.uint64), n).tolist() == [one(k, n) for k in keys]
    with pytest.raises(ValueError):
        sharding.jump_hash(np.array([1], dtype=np.uint64), 0)


def test_packing_matches_the_tokenizer(spark):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(packing.default_tokenizer())
    odd = [*ODD, "don't <|endoftext|> stop now ½ ΟΔΟΣ. naïve,,, a\x1cb éx İx 한국어! ''  x"]
    for d in (docs(spark, odd), spark.read.parquet(f"{SF}/documents.parquet")):
        texts = {r.doc_id: r.text for r in d.collect()}
        got = defaultdict(list)
        rows = packing.pieces(d).collect()
        assert all(1 << r.bucket == r.length for r in rows)
        for r in rows:
            got[r.doc_id].append(r)
        assert len({r.sequence_id for r in rows}) == len(rows) and {r.offset for r in rows} == {0}
        assert got.keys() == texts.keys()
        for i, own in got.items():
            ids = [*model.encode(texts[i] or "", add_special_tokens=False).ids, 2]
            at = 0
            for r in sorted(own, key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(ids) and r.length & (r.length - 1) == 0 and r.length <= 4096
                assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *ids[at : at + r.length])), texts[i]
                at += r.length
            assert at == len(ids)


def test_words_are_lower_cased_as_by_the_tokenizer():
    import random

    from tokenizers import Tokenizer

    model, rng = Tokenizer.from_file(packing.default_tokenizer()), random.Random(9)
    some = [*"ab σςΣİIßéÉ²½ǅΩ&.,!|_'9-", "\u0307", "\u0301", "\u212a", "\u2126", "i\u0307", "ΟΔΟΣ", " Σ.", "İ&", "'S", "\u00a0"]
    texts = ["²σΣßİ&", "ΣİX.Y", *("".join(rng.choice(some) for _ in range(rng.randint(1, 14))) for _ in range(6000))]
    code = packing.WordCoder(packing.default_tokenizer())
    for text, raw in zip(texts, code.encode(texts), strict=True):
        assert raw == struct.pack(f"<{len(raw) // 4}I", *model.encode(text, add_special_tokens=False).ids), text


def test_packing_of_null_and_repeated_ids_and_long_texts(spark, tmp_path, monkeypatch):
    rows = [(None, "a b"), (None, "a b"), (4, None), (4, ""), (4, "one two three " * 5000), (4, "one two three " * 5000)]
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id bigint, text string, length int, ids int")
    got = packing.pieces(d)
    assert sorted((r.doc_id or 0, r.doc_tokens) for r in got.filter("start = 0").collect()) == [(0, 3), (0, 3), (4, 1), (4, 1), (4, 15001), (4, 15001)]
    assert got.agg(F.sum("length")).first()[0] == 3 + 3 + 1 + 1 + 15001 * 2
    packing.write_buckets(packing.pieces(d, with_ids=True), str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b"))
    assert {(r.length, r.n_sequences) for r in packing.buckets(got).collect()} == {(r.length, r["count"]) for r in back.groupBy("length").count().collect()}
    one = spark.read.parquet(str(tmp_path / "b" / "length=4096"))
    assert {len(r.ids) for r in one.collect()} == {4096} and one.count() == 6
    assert packing.pieces(d.limit(0)).count() == 0


def test_binary_pieces():
    assert packing.binary_pieces(4096 * 2 + 5) == [4096, 4096, 4, 1]
    assert packing.binary_pieces(1) == [1]
    with pytest.raises(ValueError):
        packing.binary_pieces(5, 100)


PAGE = "page_id bigint, url string, html string, extra string"


def check_archive(pages, rows):
    payload = {p.page_id: (p.html or "").encode() for p in pages}
    best = {}
    for i, b in payload.items():
        best[b] = max(best.get(b, i), i)
    assert len(rows) == len(pages)
    for r in rows:
        b = payload[r.page_id]
        assert r.payload_bytes == len(b) and r.payload_digest == base64.b32encode(hashlib.sha1(b).digest()).decode()
        assert (r.warc_type, r.refers_to) == (("response", None) if best[b] == r.page_id else ("revisit", best[b]))


@pytest.mark.parametrize("version", [1, 2, None])
def test_archive_round_trip(spark, version):
    tricky = "WARC/1.1\r\n\r\n\r\nfiledesc://x\nhttp://a 1 2 3 4\n"
    rows = [(1, "http://a/ b?é", "<p>x</p>", "e"), (2, None, None, None), (-5, "u", "", None), (9, "http://a", tricky, None), (1 << 62, "http://b", "<p>x</p>", None), (7, "http://c", "\n\n", None)]
    pages = spark.createDataFrame(rows, PAGE)
    check_archive(pages.collect(), arc_to_warc.archive_pages(pages, version).collect())
    real = spark.read.parquet(f"{SF}/pages.parquet")
    check_archive(real.collect(), arc_to_warc.archive_pages(real, version).collect())
    assert arc_to_warc.archive_pages(pages.limit(0)).count() == 0


def test_archives_of_many_files(spark, monkeypatch, tmp_path):
    """Files are bounded by their bytes, take turns in their versions, and all records come back."""
    monkeypatch.setattr(arc_to_warc, "FILE_BYTES", 3000)
    pages = spark.range(40).select(F.col("id").alias("page_id"), F.lit("http://a").alias("url"), F.when(F.col("id") == 7, F.repeat(F.lit("long "), 4000)).otherwise(F.concat(F.lit("p"), F.repeat((F.col("id") % 9).cast("string"), 300))).alias("html")).coalesce(2)
    check_archive(pages.collect(), arc_to_warc.archive_pages(pages).collect())
    path = str(tmp_path / "arc")
    arc_to_warc.write_arc(pages, path)
    files = [arc_to_warc._inflate(bytes(r.content)) for r in arc_to_warc._files(spark, path).collect()]
    assert len(files) > 5 and sum(len(f) > 3600 for f in files) == 1
    assert {next(arc_to_warc.parse_arc(f))[0]["version"] for f in files} == {"1", "2"}


def test_foreign_archives(spark, tmp_path):
    """Records that are no HTTP messages, other header fields, and files with a fault."""
    import gzip

    one = arc_to_warc.arc_version_block(1, "x") + b"\ndns:a.example 10.0.0.1 19970101120000 text/dns 4\n1.2.\n" + b"http://a/ 10.0.0.2 199701011200 text/html 31\nHTTP/1.0 200 OK\r\nA: b\r\n\r\nbody\n!\n"
    two = arc_to_warc.arc_version_block(2, "y") + b"\nhttp://b/ 0.0.0.0 20010203040506 text/html 301 abc http://c/ 99 y 3\nxyz\nhttp://broken/ 0 1 text/html 9\n"
    (tmp_path / "part-1.arc").write_bytes(one)
    (tmp_path / "part-2.arc.gz").write_bytes(gzip.compress(two))
    out = str(tmp_path / "warc")
    with pytest.raises(Exception, match="declared 9 bytes"):
        arc_to_warc.convert(spark, str(tmp_path), str(tmp_path / "no"))
    arc_to_warc.convert(spark, str(tmp_path), out, strict=False)
    got = {r.url: r for r in arc_to_warc.read_warc(spark, out).collect()}
    assert {u: (r.warc_type, r.warc_date, bytes(r.payload)) for u, r in got.items()} == {
        "dns:a.example": ("resource", "1997-01-01T12:00:00Z", b"1.2."),
        "http://a/": ("response", "1997-01-01T12:00:00Z", b"body\n!"),
        "http://b/": ("resource", "2001-02-03T04:05:06Z", b"xyz"),
    }
    raw = b"".join(arc_to_warc._inflate(bytes(r.content)) for r in arc_to_warc._files(spark, out).collect())
    assert raw.count(b"WARC-Type: warcinfo") >= 1 and b"WARC-IP-Address: 10.0.0.1\r\n" in raw and b"X-ARC-Location: http://c/\r\n" in raw and b"X-ARC-Result-Code: 301\r\n" in raw
    bad = arc_to_warc.faults(spark, str(tmp_path)).collect()
    assert len(bad) == 1 and bad[0].file.endswith("part-2.arc.gz") and two[bad[0].at :].startswith(b"http://broken/")


def test_archive_null_ids_and_repeated_rows(spark):
    pages = spark.createDataFrame([(None, "u", "a", ""), (3, "u", "a", ""), (3, "u", "a", ""), (None, "u", "b", "")], PAGE)
    got = sorted((r.page_id or 0, r.warc_type, r.refers_to or 0) for r in arc_to_warc.archive_pages(pages).collect())
    assert got == [(0, "response", 0), (0, "revisit", 3), (3, "response", 0), (3, "response", 0)]


def test_bad_archives_are_refused():
    with pytest.raises(arc_to_warc.BadArchive):
        list(arc_to_warc.parse_arc(b"http://a 0 1 text/html 3\nabc\n"))
    with pytest.raises(arc_to_warc.BadArchive):
        list(arc_to_warc.parse_arc(arc_to_warc.arc_version_block(1, "x") + b"\nhttp://a 0 1 text/html 30\nabc\n"))
    with pytest.raises(arc_to_warc.BadArchive):
        list(arc_to_warc.parse_warc(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n"))


BENCH_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def bench_words(text):
    return BENCH_WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def check_contamination(doc_rows, items, got):
    wins = defaultdict(set)
    for r in items:
        w = bench_words(r.text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1) if w else ():
            wins[tuple(w[i : i + n])].add(str(r.item_id))
    sizes = {len(w) for w in wins}
    by = {r.doc_id: r for r in got}
    assert len(by) == len(doc_rows) == len(got)
    n_bad = 0
    for d in doc_rows:
        w, hit, ids = bench_words(d.text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (t := tuple(w[i : i + n])) in wins:
                    hit.update(range(i, i + n))
                    ids |= wins[t]
        r = by[d.doc_id]
        assert (r.n_words, r.n_hit, r.n_items) == (len(w), len(hit), len(ids)), d
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(w))
        n_bad += r.contaminated
    return n_bad


def test_contamination_matches_brute_force(spark):
    d, b = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    assert check_contamination(d.collect(), b.collect(), decontamination.contamination(d, b).collect()) > 0


def test_contamination_odd_cases(spark):
    long = " ".join(f"w{i}" for i in range(60))
    b = spark.createDataFrame([(1, long), (2, None), (3, ""), (4, "Two words"), (5, "one"), (6, long), (10, "the the the the the the the the the the the the the the"), (7, "é É")], "item_id bigint, text string")
    d = docs(spark, [*ODD, long, long.upper() + "!", "x two-WORDS one", "the " * 500, " ".join(long.split()[5:17]), " ".join(long.split()[5:18]), "É é É", "is this one? two words"])
    assert check_contamination(d.collect(), b.collect(), decontamination.contamination(d, b).collect()) > 3
    for dd, bb in ((d.limit(0), b), (d, b.limit(0))):
        assert check_contamination(dd.collect(), bb.collect(), decontamination.contamination(dd, bb).collect()) == 0
    assert decontamination.clean(d, b).columns == d.columns


def test_proximity(spark):
    b = spark.createDataFrame([(1, "alpha beta gamma"), (2, "gamma, beta")], "item_id bigint, text string")
    d = docs(spark, ["gamma x x alpha x beta", "alpha beta", "alpha " + "x " * 40 + "beta gamma"])
    near = {(r.doc_id, tuple(r.items)) for r in decontamination.proximity_matches(d, b).collect()}
    assert {i for i, items in near if 1 in items} == {0} and {i for i, items in near if 2 in items} == {0, 2}
    assert not any(r.n_hit for r in decontamination.contamination(d, b).collect())


@pytest.mark.parametrize("most", [0, 16_000_000])
def test_contamination_of_null_and_repeated_ids(spark, monkeypatch, most):
    """Every row is judged by its own text, also where all tables are joined by a shuffle."""
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", most)
    bad, good = " ".join(f"w{i}" for i in range(30)), " ".join(f"own{i}" for i in range(900))
    b = spark.createDataFrame([(1, bad), (None, bad)], "item_id bigint, text string")
    texts = [(None, bad), (None, good), (None, None), (None, bad), (7, good), (7, bad + " " + good), (7, bad), (7, bad), (8, good + " " + " ".join(bad.split()[3:20]))]
    d = spark.createDataFrame([(i, t, str(k), "win", 5) for k, (i, t) in enumerate(texts)], "doc_id bigint, text string, w string, `row` string, hits int")
    got = sorted((r.doc_id or 0, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in decontamination.contamination(d, b).collect())
    assert got == sorted([(0, 30, 30, 1, True), (0, 900, 0, 0, False), (0, 0, 0, 0, False), (0, 30, 30, 1, True), (7, 900, 0, 0, False), (7, 930, 30, 1, False), (7, 30, 30, 1, True), (7, 30, 30, 1, True), (8, 917, 17, 1, False)])
    left = decontamination.clean(d, b)
    assert left.columns == d.columns and sorted(r.w for r in left.collect()) == ["1", "2", "4", "5", "8"]


def test_native_plan_has_no_python(spark):
    d, b = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    plan = decontamination.contamination(d, b)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert F is not None
