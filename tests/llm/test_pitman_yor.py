"""The language model: exact counts and base scores, sums to one, better than the base on unseen texts."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest

from loomspark.llm import pitman_yor as py

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile("[^\x20\x09-\x0d]+")


def tokens(text):
    return [*WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")), None]


def check(rows, got):
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    counts = Counter(w for i, t in rows if not held[i] for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) == len(by)
    for i, t in rows:
        w, r = tokens(t), by[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(w), sum(counts[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), rel=1e-9, abs=1e-7)
        assert r.score < 0 or not n


def test_counts_and_base(spark):
    odd = [None, "", "ÄB a  A\ta\x0b É é", "a a a a a", "x" * 300, "b a", "nbsp joined \x1c word"] * 4
    rows = list(enumerate(odd))
    d = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOC).repartition(3)
    check(rows, py.score(d).collect())
    assert py.score(d.limit(0)).count() == 0


def test_real_rows_and_perplexity(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    scored = py.score(d)
    rows = scored.collect()
    check([(r.doc_id, r.text) for r in d.select("doc_id", "text").collect()], rows)
    by = {r.held_out: r for r in py.perplexity(scored).collect()}
    assert by[True].perplexity < 0.5 * by[True].base_perplexity
    assert {r.doc_id: r.score for r in scored.collect()} == pytest.approx({r.doc_id: r.score for r in rows}, rel=1e-6)


@pytest.mark.parametrize("spread_words", [(), ("w59", "w58", "w30", None)])
def test_probabilities_sum_to_one(spread_words):
    """The dataflow without Spark, up to the parts of the probabilities."""
    rng = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(vocabulary, rng.integers(0, 40), p=np.arange(1, 61) / np.arange(1, 61).sum())) for _ in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array([t.encode() for t in texts])], names=["doc_id", "data"])
    n = 4
    shares = {py.END if w is None else py.xxhash.xxh3_64_intdigest(w.encode()): 0.4 for w in spread_words}
    spread = py.Spread(n, shares)

    def ordered(batches):
        return sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["bucket"])

    pairs = ordered(py._pair_blobs(n, spread)(iter([batch])))
    asked = ordered(py._ask(n, spread)(iter([pa.RecordBatch.from_pylist(pairs, schema=py._SCHEMA)])))
    told = ordered(py._tell()(iter([pa.RecordBatch.from_pylist(asked, schema=py._SCHEMA)])))
    buckets = [py._Bucket(b, [(r["source"], r["payload"]) for r in pairs if r["bucket"] == b and r["kind"] == py.PAIRS], spread, True) for b in range(n)]
    assert any(len({b for b, x in enumerate(buckets) if h in x.words}) > 1 for h in shares) == bool(shares)
    size = len({h for x in buckets for h, c in zip(x.words, x.trained, strict=True) if c})
    for b, x in enumerate(buckets):
        for t in told:
            if t["bucket"] == b and t["kind"] == py.TOLD_WORDS:
                h, trained, *sums = py._unpack(t["payload"], py._WORD_PARTS)
                at = np.searchsorted(x.words, h)
                x.trained[at] = trained
                for k in range(py.KEPT):
                    x.customers[k][at], x.tables[k][at] = sums[2 * k : 2 * k + 2]
    totals = [py.struct.unpack(py._TOTAL, r["payload"]) for r in asked if r["kind"] == py.TOTAL]
    for k in range(py.KEPT):
        customers_all, tables_all = sum(t[k] for t in totals), sum(t[py.KEPT + k] for t in totals)
        rest, counted = (py.PARENT_STRENGTH + tables_all) / (size + 1), set()
        p1_sum, own_sum, back = rest / (py.PARENT_STRENGTH + customers_all), Counter(), {}
        for b, x in enumerate(buckets):
            for h, c, v in zip(x.words, x.trained, (x.customers[k] - x.tables[k] + rest) / (py.PARENT_STRENGTH + customers_all), strict=True):
                if c and h not in counted:
                    counted.add(h)
                    p1_sum += v
            for t in told:
                if t["bucket"] == b and t["kind"] == py.TOLD:
                    h, c, *tables = py._unpack(t["payload"], py._TOLD)
                    back.update((int(u), (py.DISCOUNT * int(o), n)) for u, o, n in zip(h, py._of_changes(tables)[k], c, strict=True))
            for i, v in zip(x.seen, x.counts[x.seen] - py.DISCOUNT * x.seated[k], strict=True):
                own_sum[int(x.contexts[x.context[i]])] += v
        assert p1_sum == pytest.approx(1, abs=1e-9)
        assert len(back) > 40
        for h, (opened, seated) in back.items():
            assert (own_sum[h] + (py.STRENGTH + opened) * p1_sum) / (py.STRENGTH + seated) == pytest.approx(1, abs=1e-5)

    # the scores of whole texts, from the state of the buckets by the formula alone
    total = [sum(t[i] for t in totals) for i in range(2 * py.KEPT + 2)]
    right = pa.Table.from_pylist([{k: t[k] for k in ("bucket", "kind", "payload")} | dict(zip(py._TOTALS.names, [*total[:-1], size - len(spread.hashes)], strict=True)) for t in told], schema=pa.schema([("bucket", pa.int64()), ("kind", pa.int32()), ("payload", pa.binary()), *py._TOTALS]))
    left = pa.Table.from_pylist(pairs, schema=py._SCHEMA)
    sums = []
    for b in range(n):
        own = [t.filter(pa.compute.equal(t["bucket"], b)) for t in (left, right)]
        sums += py._apply(n, spread)((pa.scalar(b),), *own).to_pylist()
    sums.sort(key=lambda r: r["source"])
    batch = pa.RecordBatch.from_pylist([{"source": r["source"], "kind": r["kind"], "payload": r["payload"], "tokens": total[-2]} for r in sums], schema=pa.schema([("source", pa.int64()), ("kind", pa.int32()), ("payload", pa.binary()), ("tokens", pa.int64())]))
    got = {r["doc_id"]: r for b in py._sum_up()(iter([batch])) for r in b.to_pylist()}
    assert len(got) == len(texts)
    seen = []
    for k in range(py.KEPT):
        rest, p1, pair, back = (py.PARENT_STRENGTH + total[py.KEPT + k]) / (size + 1), {}, {}, {}
        for b, x in enumerate(buckets):
            p1.update(zip(x.words.tolist(), ((x.customers[k] - x.tables[k] + rest) / (py.PARENT_STRENGTH + total[k])).tolist(), strict=True))
            pair.update({(int(x.contexts[x.context[i]]), int(x.words[x.word[i]])): v for i, v in zip(x.seen, x.counts[x.seen] - py.DISCOUNT * x.seated[k], strict=True)})
            for t in told:
                if t["bucket"] == b and t["kind"] == py.TOLD:
                    h, c, *tables = py._unpack(t["payload"], py._TOLD)
                    back.update(zip(h.tolist(), zip(py._of_changes(tables)[k].tolist(), c.tolist(), strict=True), strict=True))
        seen.append((p1, pair, back, rest / (py.PARENT_STRENGTH + total[k])))
    for i, t in enumerate(texts):
        hashes = [*(py.xxhash.xxh3_64_intdigest(w.encode()) for w in t.split()), py.END]
        score = 0.0
        for u, w in zip([py.END, *hashes[:-1]], hashes, strict=True):
            u &= (1 << 48) - 1
            chance = []
            for p1, pair, back, unknown in seen:
                opened, customers = back.get(u, (0, 0))
                chance.append((pair.get((u, w), 0) + (py.STRENGTH + py.DISCOUNT * opened) * p1.get(w, unknown)) / (py.STRENGTH + customers))
            score += math.log10(np.mean(chance))
        assert got[i]["score"] == pytest.approx(score, rel=1e-5), i


def seatings(n, d, fresh):
    """Chances of each number of tables of n customers of one dish under a fixed new-table weight, customer by customer."""
    weights = np.zeros(n + 2)
    weights[1] = fresh
    for seated in range(1, n):
        t = np.arange(n + 2)
        weights[1:] = weights[1:] * (seated - d * t[1:]) * (t[1:] <= seated) + fresh * weights[:-1]
        weights[0] = 0
        weights /= weights.sum()
    return weights / weights.sum()


def test_small_seating_matches_enumeration():
    d, fresh, n = 0.5, 0.8, 4
    weight = Counter()

    def seat(sizes, w, i):
        if i == n:
            weight[len(sizes)] += w
            return
        for k in range(len(sizes)):
            seat([*sizes[:k], sizes[k] + 1, *sizes[k + 1 :]], w * (sizes[k] - d), i + 1)
        seat([*sizes, 1], w * fresh, i + 1)

    seat([], 1.0, 0)
    want = {k: w / sum(weight.values()) for k, w in weight.items()}
    found = py.draw_tables(np.full(20000, n), np.full(20000, fresh), d, np.random.default_rng(0))
    for k, w in want.items():
        assert np.mean(found == k) == pytest.approx(w, abs=0.015) and seatings(n, d, fresh)[k] == pytest.approx(w)


@pytest.mark.parametrize("n", [1, 2, 3, 8, 9, 40, 200, 512, 513, 1000, 5000])
@pytest.mark.parametrize("d", [py.PARENT_DISCOUNT, py.DISCOUNT, 0.5])
def test_seating_of_any_size_matches_the_exact_posterior(n, d):
    """Means within 3 % and spreads within 12 % of the exact ones, on both sides of every switch."""
    for fresh in (1e-3, 0.5, 5.0, 60.0):
        want = seatings(n, d, fresh)
        t = np.arange(len(want))
        mean = (t * want).sum()
        spread = math.sqrt(max(0, (t * t * want).sum() - mean * mean))
        found = py.draw_tables(np.full(6000, n), np.full(6000, fresh), d, np.random.default_rng(1))
        assert found.min() >= 1 and found.max() <= n
        assert found.mean() == pytest.approx(mean, rel=0.03), (fresh, spread)
        assert found.std() == pytest.approx(spread, rel=0.12, abs=0.05), fresh


def test_gibbs_sweeps_match_a_customer_by_customer_sampler():
    """Tables of a whole restaurant: drawing dishes at once against moving one customer at a time."""
    rng, counts = np.random.default_rng(5), np.array([1, 2, 3, 5, 9, 14])
    word, context = np.arange(6), np.zeros(6, dtype=np.int64)
    many = [py.sample(word, context, counts, np.ones(6, dtype=np.int64), 1, 1, 0, seed)[0][-1].sum() for seed in range(400)]
    d, d0, h = py.DISCOUNT, py.PARENT_DISCOUNT, py.STRENGTH
    sizes = [[int(c)] for c in counts]
    above = [[1] for _ in counts]  # customers at the parent's tables of each dish
    seen = []
    for sweep in range(1500):
        for w, c in enumerate(counts):
            for _ in range(c):
                k = rng.choice(len(sizes[w]), p=np.array(sizes[w]) / sum(sizes[w]))
                sizes[w][k] -= 1
                if not sizes[w][k]:
                    del sizes[w][k]
                    j = rng.choice(len(above[w]), p=np.array(above[w]) / sum(above[w]))
                    above[w][j] -= 1
                    if not above[w][j]:
                        del above[w][j]
                tables, upper = sum(map(len, sizes)), sum(map(len, above))
                base = (py.PARENT_STRENGTH + d0 * upper) / 7
                p = (sum(above[w]) - d0 * len(above[w]) + base) / (py.PARENT_STRENGTH + sum(map(sum, above)))
                odds = np.array([*(x - d for x in sizes[w]), (h + d * tables) * p])
                k = rng.choice(len(odds), p=odds / odds.sum())
                if k < len(sizes[w]):
                    sizes[w][k] += 1
                    continue
                sizes[w].append(1)
                odds = np.array([*(x - d0 for x in above[w]), base])
                j = rng.choice(len(odds), p=odds / odds.sum())
                if j < len(above[w]):
                    above[w][j] += 1
                else:
                    above[w].append(1)
        if sweep >= 100:
            seen.append(sum(map(len, sizes)))
    assert np.mean(many) == pytest.approx(np.mean(seen), rel=0.06)
