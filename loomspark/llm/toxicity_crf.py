"""Toxic spans by a linear-chain conditional random field.

Tokens are tagged toxic or not. Token labels come from labelled documents: in toxic ones, a word whose
form or prefix is far likelier there than in the others is a toxic token, every other token is not.
A two-state chain is fitted to these tags; its forward-backward marginals give offending offsets, and
a logistic curve over their sums gives the document's score.

What is learnt comes from a bounded sample of labelled rows (``per_class`` rows of either label, of at
most ``max_bytes`` each, those whose hashed ids are smallest); the shares of the two labels are counted
over all labelled training rows. Scores read the text alone.

Defined results: null and empty texts have no tokens and get the score of a document without toxic
tokens. A null doc_id hashes as the empty string. Repeated rows are scored row by row; of repeated
labels the larger counts, null labels don't. Without labelled rows of both kinds every score is the
share of toxic labels (0.5 if there is none). Empty tables give empty results. Further columns are not
read.
"""

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PER_CLASS = 2500
MAX_BYTES = 20_000
FOLDS = 5
BITS = 18
PREFIXES = (3, 4, 5, 6, 7)
WORDS_KEPT = 300_000
#: Tokens whose marginals are taken together.
PART_TOKENS = 200_000
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_WORD = re.compile(r"\S+")

SCORED = "doc_id bigint, held_out boolean, score double, n_spans int, spans array<struct<start:int,stop:int,p:double>>"


def core(word: str) -> str:
    """A word without case and without signs at its ends."""
    return word if word.isalpha() else _EDGE.sub("", word)


def forms(word: str) -> list[str]:
    """The word and its prefixes, as strings that can't be mistaken for each other."""
    return [f"={word}", *(f"<{word[:n]}" for n in PREFIXES if len(word) >= n)]


def slots(word: str) -> list[int]:
    return [zlib.crc32(x.encode("utf-8", "replace")) >> 32 - BITS for x in forms(word)]


@dataclass
class Model:
    """Emission weights of a token's own forms and of its neighbours' words, transitions, document curve."""

    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    bias: float
    arcs: np.ndarray  # log weights [from, to]
    curve: np.ndarray  # of 1, log(1 + sum of marginals), largest marginal, log(1 + tokens)

    def emission(self, word: str) -> tuple[float, float, float]:
        at = slots(word)
        return float(self.own[at].sum()), float(self.before[at[0]]), float(self.after[at[0]])


# ---- chain


def _scan(c00: np.ndarray, c01: np.ndarray, c10: np.ndarray, c11: np.ndarray, width: int = 256) -> np.ndarray:
    """Ratio of the second to the first component of (1, 0) after each of a run of 2x2 matrices.

    The run is folded into rows; products along all rows advance together, then the rows are chained.
    """
    n = len(c00)
    rows = -(-n // width)
    pad = rows * width - n

    def grid(x: np.ndarray, fill: float) -> np.ndarray:
        return np.ascontiguousarray(np.concatenate([x, np.full(pad, fill)]).reshape(rows, width).T)

    g00, g01, g10, g11 = grid(c00, 1.0), grid(c01, 0.0), grid(c10, 0.0), grid(c11, 1.0)
    m00, m01, m10, m11 = np.ones(rows), np.zeros(rows), np.zeros(rows), np.ones(rows)
    for t in range(width):
        n00, n01 = g00[t] * m00 + g01[t] * m10, g00[t] * m01 + g01[t] * m11
        n10, n11 = g10[t] * m00 + g11[t] * m10, g10[t] * m01 + g11[t] * m11
        big = np.maximum(np.maximum(n00, n01), np.maximum(n10, n11))
        m00, m01, m10, m11 = n00 / big, n01 / big, n10 / big, n11 / big
    at = np.empty(rows)
    ratio = 0.0
    for r in range(rows):
        at[r] = ratio
        ratio = (m10[r] + m11[r] * ratio) / (m00[r] + m01[r] * ratio)
    out = np.empty((width, rows))
    for t in range(width):
        at = (g10[t] + g11[t] * at) / (g00[t] + g01[t] * at)
        out[t] = at
    return out.T.reshape(-1)[:n]


def marginals(scores: np.ndarray, starts: np.ndarray, arcs: np.ndarray, pairs: bool = False):
    """Probability of the toxic tag at each token of documents laid end to end.

    scores: log odds of the tag by a token's features; starts: places where documents begin. With
    pairs, also the expected number of each kind of arc.
    """
    n = len(scores)
    if not n:
        return (np.empty(0), np.zeros((2, 2))) if pairs else np.empty(0)
    e = np.exp(np.clip(scores, -30, 30))
    a = np.exp(arcs)
    first = np.zeros(n, dtype=bool)
    first[starts] = True
    one = np.ones(n)
    forward = _scan(
        np.where(first, 1.0, a[0, 0]) * one, np.where(first, 1.0, a[1, 0]) * one,
        np.where(first, 1.0, a[0, 1]) * e, np.where(first, 1.0, a[1, 1]) * e,
    )
    nxt = np.append(e[1:], 1.0)[::-1]
    last = np.append(first[1:], True)[::-1]
    backward = _scan(
        np.where(last, 1.0, a[0, 0]), np.where(last, 1.0, a[0, 1] * nxt),
        np.where(last, 1.0, a[1, 0]), np.where(last, 1.0, a[1, 1] * nxt),
    )[::-1]
    odds = forward * backward
    p = odds / (1 + odds)
    if not pairs:
        return p
    r, q, own = forward[:-1], backward[1:], e[1:]
    w = np.stack([a[0, 0] * np.ones(n - 1), a[0, 1] * own * q, a[1, 0] * r, a[1, 1] * r * own * q])
    w = (w / w.sum(axis=0))[:, ~first[1:]].sum(axis=1)
    return p, w.reshape(2, 2)


# ---- learning


def toxic_forms(words: list[str], codes: np.ndarray, owner: np.ndarray, labels: np.ndarray, least: int = 4, odds: float = 8.0) -> np.ndarray:
    """Which words, by themselves or a prefix, stand in many more of the toxic documents than in the others.

    codes: words of documents end to end, owner: their documents. Forms are known by their hashes, and
    documents are counted some at a time.
    """
    table = [[xxhash.xxh3_64_intdigest(f.encode("utf-8", "replace")) for f in forms(w)] for w in words]
    each = np.array([len(t) for t in table], dtype=np.int64)
    begin = np.cumsum(each) - each
    _, of = np.unique(np.fromiter((h for t in table for h in t), dtype=np.uint64, count=int(each.sum())), return_inverse=True)
    del table
    n_forms = int(of.max()) + 1 if len(of) else 0
    counts = np.zeros((2, n_forms), dtype=np.int64)
    for at in range(0, len(labels), 200):
        lo, hi = np.searchsorted(owner, [at, at + 200])
        pair = np.unique(owner[lo:hi] * len(words) + codes[lo:hi])
        doc, word = pair // max(1, len(words)), pair % max(1, len(words))
        n = each[word]
        place = np.repeat(begin[word], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        pair = np.unique(np.repeat(doc, n) * max(1, n_forms) + of[place])
        bad = labels[pair // max(1, n_forms)] == 1
        for kind, own in enumerate((pair[~bad], pair[bad])):
            counts[kind] += np.bincount(own % max(1, n_forms), minlength=n_forms)
    share = max(1, int((labels == 0).sum())) / max(1, int(labels.sum()))
    toxic = (counts[1] >= least) & (counts[1] * share >= odds * (counts[0] + 0.5))
    return np.logical_or.reduceat(toxic[of], begin) if len(words) else np.zeros(0, dtype=bool)


def fit(texts: list[str], labels: list[int], toxic_share: float, rounds: int = 60) -> Model:
    """A model from labelled texts; toxic_share is that among all labelled rows."""
    y = np.array(labels, dtype=np.int64)
    size = 1 << BITS
    if not len(y) or y.min() == y.max():
        flat = math.log(max(toxic_share, 1e-6) / max(1 - toxic_share, 1e-6))
        return Model(np.zeros(size), np.zeros(size), np.zeros(size), -12.0, np.zeros((2, 2)), np.array([flat, 0, 0, 0]))
    # the curve is fitted to documents that the chain has not seen
    late = np.array([zlib.crc32(t.encode("utf-8", "replace")) % 4 == 0 for t in texts])
    known: dict[str, int] = {}
    coded = [np.array([known.setdefault(core(w), len(known)) for w in t.lower().split()], dtype=np.int64) for t in texts]
    lengths = np.array([len(d) for d in coded])
    codes = np.concatenate(coded)
    del coded
    own_doc = np.repeat(np.arange(len(texts)), lengths)
    words = list(known)
    del known
    early = ~late[own_doc]
    seed_word = toxic_forms(words, codes[early], (np.cumsum(~late) - 1)[own_doc[early]], y[~late])
    tags = (seed_word[codes] & (y[own_doc] == 1)).astype(float)
    table = [slots(w) for w in words]
    flat, owner = np.array([s for t in table for s in t]), np.repeat(np.arange(len(words)), [len(t) for t in table])
    whole = np.array([t[0] for t in table])
    del table
    c, tag = codes[early], tags[early]
    docs_used = own_doc[early]
    starts = np.flatnonzero(np.append(True, docs_used[1:] != docs_used[:-1]))[: len(c)]
    first = np.zeros(len(c), dtype=bool)
    first[starts] = True
    left, right = np.where(first, -1, np.roll(c, 1)), np.where(np.append(first[1:], True), -1, np.roll(c, -1))
    # marginals are taken some documents at a time, which bounds what they hold
    cuts = [0, *(int(k) for k in starts[np.flatnonzero(np.diff(starts // PART_TOKENS)) + 1]), len(c)]
    parts = [(a, b, starts[np.searchsorted(starts, a) : np.searchsorted(starts, b)] - a) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]
    m = Model(np.zeros(size), np.zeros(size), np.zeros(size), -6.0, np.zeros((2, 2)), np.zeros(4))
    seen = [np.full(size, 1e-3) for _ in range(3)] + [np.full(1, 1e-3), np.full((2, 2), 1e-3)]
    observed = np.zeros((2, 2))
    np.add.at(observed, (tag[:-1][~first[1:]].astype(int), tag[1:][~first[1:]].astype(int)), 1)

    def step(x: np.ndarray, g: np.ndarray, s: np.ndarray, rate: float) -> None:
        s += g * g
        x += rate * g / np.sqrt(s)

    weights = (m.own, m.before, m.after)
    bias = np.array([m.bias])
    n_words = len(words)
    for _ in range(rounds):
        by_word = np.bincount(owner, m.own[flat], n_words)
        score = by_word[c] + bias[0] + np.where(left >= 0, m.before[whole[left]], 0) + np.where(right >= 0, m.after[whole[right]], 0)
        rest, arcs = tag.copy(), np.zeros((2, 2))
        for a, b, own in parts:
            p, some = marginals(score[a:b], own, m.arcs, pairs=True)
            rest[a:b] -= p
            arcs += some
        g = np.bincount(flat, np.bincount(c, rest, n_words)[owner], size)
        step(weights[0], g - 0.01 * m.own, seen[0], 0.5)
        for w, side, s in ((m.before, left, seen[1]), (m.after, right, seen[2])):
            ok = side >= 0
            step(w, np.bincount(whole[side[ok]], rest[ok], size) - 0.5 * w, s, 0.1)
        step(bias, np.array([rest.sum()]), seen[3], 0.5)
        step(m.arcs, observed - arcs - 0.01 * m.arcs, seen[4], 0.1)
    m.bias = float(bias[0])
    pick = late if y[late].any() and not y[late].all() else np.ones(len(y), dtype=bool)
    ends = np.cumsum(lengths)
    m.curve = _curve(m, [[words[k] for k in codes[e - n : e]] for e, n in zip(ends[pick], lengths[pick], strict=True)], y[pick], toxic_share)
    return m


def _summary(p: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What the document curve sees: one row for each document, empty ones included."""
    out = np.zeros((len(lengths), 4))
    out[:, 0] = 1
    out[:, 3] = np.log1p(lengths) / 10
    full = lengths > 0
    if full.any():
        at = starts[full]
        out[full, 1] = np.log1p(np.add.reduceat(p, at))
        out[full, 2] = np.maximum.reduceat(p, at)
    return out


def _curve(m: Model, docs: list[list[str]], t: np.ndarray, share: float) -> np.ndarray:
    """Logistic regression by Newton steps, rows weighted to the labels' true shares."""
    p, starts, lengths = Scorer(m).probabilities(docs)
    x = _summary(p, starts, lengths)
    share = min(max(share, 1e-3), 1 - 1e-3)
    w = np.where(t == 1, share / max(1, t.sum()), (1 - share) / max(1, (1 - t).sum())) * len(t)
    b = np.zeros(4)
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (w * q * (1 - q) + 1e-9)[:, None]).T @ x + 0.1 * np.eye(4)
        b += np.linalg.solve(h, x.T @ (w * (t - q)) - 0.1 * b)
    return b


# ---- scoring


class Scorer:
    def __init__(self, model: Model):
        self.m = model
        self._clear()

    def _clear(self) -> None:
        self.code: dict[str, int] = {}
        self.rows: list[tuple[float, float, float]] = []
        self.array = np.zeros((0, 3))

    def _codes(self, words: list[str], strip: bool) -> np.ndarray:
        code = self.code
        for w in set(words):
            if w not in code:
                code[w] = len(self.rows)
                self.rows.append(self.m.emission(core(w) if strip else w))
        if len(self.rows) > len(self.array):
            self.array = np.concatenate([self.array, np.array(self.rows[len(self.array) :]).reshape(-1, 3)])
        return np.fromiter(map(code.__getitem__, words), dtype=np.int64, count=len(words))

    def probabilities(self, docs: list[list[str]], strip: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Marginals of all tokens end to end, where each document begins, and how many it has."""
        if len(self.rows) > WORDS_KEPT:
            self._clear()
        lengths = np.array([len(d) for d in docs], dtype=np.int64)
        starts = np.cumsum(lengths) - lengths
        found = self.array[:0] if not lengths.sum() else None
        codes = self._codes([w for d in docs for w in d], strip)
        found = self.array[codes]
        at = starts[lengths > 0]
        first = np.zeros(len(codes), dtype=bool)
        first[at] = True
        score = found[:, 0] + self.m.bias
        if len(codes):
            score[1:] += np.where(first[1:], 0, found[:-1, 1])
            score[:-1] += np.where(first[1:], 0, found[1:, 2])
        return marginals(score, at, self.m.arcs), starts, lengths

    def score(self, texts: list[str]) -> list[tuple[float, list[tuple[int, int, float]]]]:
        """Score and offending (start, stop, probability) of each text, offsets in code points."""
        p, starts, lengths = self.probabilities([t.lower().split() for t in texts], strip=True)
        x = _summary(p, starts, lengths)
        scores = 1 / (1 + np.exp(-np.clip(x @ self.m.curve, -30, 30)))
        out: list[tuple[float, list[tuple[int, int, float]]]] = [(float(s), []) for s in scores]
        hot = np.flatnonzero(p >= 0.5)
        owner = np.searchsorted(starts, hot, side="right") - 1
        for d in np.unique(owner):
            # empty documents share a start with the next one, which searchsorted finds last
            words = list(_WORD.finditer(texts[d]))
            for t in hot[owner == d]:
                k = int(t - starts[d])
                if len(words) == lengths[d]:
                    out[d][1].append((*words[k].span(), float(p[t])))
                else:
                    out[d][1].append((-1, -1, float(p[t])))
        return out


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_bytes: int = MAX_BYTES, folds: int = FOLDS) -> Model:
    """Fit on a bounded sample of the labelled rows outside fold 0."""
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds
    train = labels.select(F.col("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).filter(fold != 0)
    train = train.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    shares = {r.toxic: r["count"] for r in train.groupBy("toxic").count().collect()}
    total = sum(shares.values())
    if not total:
        return fit([], [], 0.5)
    some = [train.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    # as many rows as the parameter says at most, so this side of the join is bounded
    ids = F.broadcast(some[0].unionByName(some[1]))
    text = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = text.join(ids, "doc_id").filter(F.octet_length("text") <= max_bytes).select("doc_id", "text", "toxic").limit(4 * per_class).collect()
    rows.sort(key=lambda r: (r.doc_id, r.text))
    texts, marks = [r.text for r in rows], [r.toxic for r in rows]
    del rows
    return fit(texts, marks, shares.get(1, 0) / total)


def score(docs: DataFrame, model: Model, folds: int = FOLDS) -> DataFrame:
    """held_out, score and offending spans of every row of docs(doc_id, text)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a few MB, fixed by BITS
    span = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("p", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            texts = batch.column(2)
            at = 0
            while at < batch.num_rows:
                part, size = [], 0
                while at + len(part) < batch.num_rows and (not part or size < 3_000_000 and len(part) < 1000):
                    part.append(texts[at + len(part)].as_py() or "")
                    size += len(part[-1])
                found = scorer.score(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(part)), batch.column(1).slice(at, len(part)), pa.array([s for s, _ in found], pa.float64()),
                        pa.array([len(x) for _, x in found], pa.int32()), pa.array([[dict(zip(("start", "stop", "p"), y, strict=True)) for y in x] for _, x in found], pa.list_(span)),
                    ],
                    names=["doc_id", "held_out", "score", "n_spans", "spans"],
                )
                at += len(part)

    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds == 0
    return docs.select(F.col("doc_id").cast("bigint"), held.alias("held_out"), F.col("text").cast("string")).mapInArrow(run, SCORED)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labelled rows outside fold 0 and score every document."""
    return score(docs, learn(docs, labels))
