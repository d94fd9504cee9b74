"""Registered queries of this package: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arc_to_warc, decontamination, dual_tree_lloyd, html_extraction, order_minhash, packing, pitman_yor, quality_ledger, rotation_codes, sharding, suffix_index, token_alignment, toxicity_crf
from .common import stored, table


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages"))


def op2_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(table(spark, sf_dir, "documents"))


def language_model_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the model counts and its base, without the sampled score."""
    scored = pitman_yor.score(table(spark, sf_dir, "documents"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 3).alias("base_score"))


def op3_suffix_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_index.digests(table(spark, sf_dir, "documents"))


def op4_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 8)


def op5_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity_crf.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "n_spans")


def op6_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = arc_to_warc.archive_pages(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"), "refers_to")


def op7_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality_ledger.with_verdict(stored(quality_ledger.ledger(table(spark, sf_dir, "documents")), "ledger"))
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "fail_bits")


def quality_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both policies over one stored ledger: what each rule rejects, and what it alone does."""
    book = stored(quality_ledger.ledger(table(spark, sf_dir, "documents")), "ledger")
    first, *more = (quality_ledger.ablation(book, p) for p in quality_ledger.POLICIES.values())
    for other in more:
        first = first.unionByName(other)
    return first


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.classes(table(spark, sf_dir, "documents"))


def op9_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op10_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pieces(table(spark, sf_dir, "documents"))


def op11_postings_cogroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"))


def op12_rotation_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotation_codes.near_duplicates(table(spark, sf_dir, "embeddings"))


def op13_dual_tree_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dual_tree_lloyd.cluster(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_html_extraction, op2_pitman_yor, op3_suffix_levels, op4_jump_sharding, op5_toxicity_crf, op6_arc_to_warc, op7_quality_ledger, op8_order_minhash, op9_positional_index, op10_power_of_two_packing, op11_postings_cogroup, op12_rotation_codes, op13_dual_tree_lloyd, quality_ablation, language_model_counts)}


_WORDS = r"[^\x20\x09-\x0D]+"
_TERMS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

QUALITY_SQL = rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) AS g FROM d WHERE len(w) >= 8),
twice AS (SELECT doc_id, g FROM g GROUP BY ALL HAVING count(*) > 1),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM g JOIN twice USING (doc_id, g)) GROUP BY 1),
m AS (SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORDS}')) AS l, coalesce(r.n, 0) AS n_repeat_words,
length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS letters, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper FROM d LEFT JOIN r USING (doc_id)),
b AS (SELECT *, len(l) - len(list_distinct(l)) AS n_dup_lines FROM m),
f AS (SELECT *, CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END + CASE WHEN 10 * n_symbols > 4 * n_words THEN 4 ELSE 0 END
+ CASE WHEN 100 * n_dup_lines > 50 * len(l) THEN 8 ELSE 0 END + CASE WHEN n_words > 0 AND NOT 2 * word_chars BETWEEN 3 * n_words AND 60 * n_words THEN 16 ELSE 0 END
+ CASE WHEN letters >= 20 AND 10 * upper > 7 * letters THEN 32 ELSE 0 END AS bits FROM b)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
bits & 3 <> 0 AS base_failed, bits = 0 AS kept, CAST(bits AS BIGINT) AS fail_bits FROM f"""

_RULES = "(VALUES ('few_words', 1), ('repeated_words', 2), ('symbols', 4), ('duplicate_lines', 8), ('word_length', 16), ('shouting', 32)) AS r(rule, bit)"
ABLATION_SQL = f"""WITH q AS ({QUALITY_SQL}),
p AS (SELECT policy_version, mask, rule, bit FROM (VALUES (1, 3), (2, 63)) AS v(policy_version, mask), {_RULES} WHERE mask & bit <> 0)
SELECT policy_version, (SELECT count(*) FROM q) AS n_docs, rule, bit, (SELECT count(*) FROM q WHERE fail_bits & bit <> 0) AS n_failed,
(SELECT count(*) FROM q WHERE fail_bits & mask = bit) AS n_rejected_by_it_alone FROM p"""

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
CONTAMINATION_SQL = rf"""WITH d AS (SELECT doc_id, regexp_extract_all({_LOW}, '{_TERMS}') AS w FROM documents),
b AS (SELECT item_id, w, least(len(w), 13) AS n FROM (SELECT item_id, regexp_extract_all({_LOW}, '{_TERMS}') AS w FROM benchmark) WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g FROM b),
occ AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS s, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n),
hit AS (SELECT doc_id, s, n, item_id FROM occ JOIN win USING (n, g)),
cover AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN items USING (doc_id)"""


_CRC_TABLE = "SELECT list_transform(range(0, 256), lambda i: list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384::UBIGINT, c >> 1) ELSE c >> 1 END, i::UBIGINT)) AS crc_table"


def _crc(text: str) -> str:
    """CRC-32 of a text's UTF-8, byte by byte."""
    data = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: CAST('0x' || x AS UBIGINT))"
    return f"CAST(xor(4294967295::UBIGINT, list_reduce({data}, lambda v, x: xor(crc_table[1 + CAST(xor(v, x) & 255 AS INTEGER)], v >> 8), 4294967295::UBIGINT)) AS BIGINT)"


def _times(a: str, b: str | int) -> str:
    return f"CAST(({a})::UHUGEINT * {b}::UHUGEINT % 18446744073709551616::UHUGEINT AS UBIGINT)"


def _turn(a: str, bits: int) -> str:
    return f"CAST(({a})::UHUGEINT * {1 << bits}::UHUGEINT % 18446744073709551616::UHUGEINT AS UBIGINT) | ({a} >> {64 - bits})"


#: Published constants of the 64-bit hash and of the jump's generator.
_P1, _P2, _P3, _P4, _P5 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261
SHARD_SQL = f"""WITH RECURSIVE c AS MATERIALIZED ({_CRC_TABLE}),
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
h0 AS (SELECT r, CAST((doc_id::HUGEINT + 18446744073709551616::HUGEINT) % 18446744073709551616::HUGEINT AS UBIGINT) AS x FROM d),
h1 AS (SELECT r, {_times("x", _P2)} AS x FROM h0), h2 AS (SELECT r, {_turn("x", 31)} AS x FROM h1),
h3 AS (SELECT r, xor({42 + _P5 + 8}::UBIGINT, {_times("x", _P1)}) AS x FROM h2), h4 AS (SELECT r, {_turn("x", 27)} AS x FROM h3),
h5 AS (SELECT r, CAST(({_times("x", _P1)}::UHUGEINT + {_P4}::UHUGEINT) % 18446744073709551616::UHUGEINT AS UBIGINT) AS x FROM h4),
h6 AS (SELECT r, {_times("xor(x, x >> 33)", _P2)} AS x FROM h5), h7 AS (SELECT r, {_times("xor(x, x >> 29)", _P3)} AS x FROM h6),
k AS MATERIALIZED (SELECT r, xor(x, x >> 32) AS x FROM h7),
j AS (SELECT r, n, x, 0::BIGINT AS ahead FROM k, (VALUES (8), (9)) AS v(n) UNION ALL
SELECT r, n, y, CAST(floor((ahead + 1)::DOUBLE * (2147483648::DOUBLE / ((y >> 33) + 1)::DOUBLE)) AS BIGINT) FROM
(SELECT r, n, ahead, CAST((x::UHUGEINT * 2862933555777941757::UHUGEINT + 1::UHUGEINT) % 18446744073709551616::UHUGEINT AS UBIGINT) AS y FROM j WHERE ahead < n)),
s AS (SELECT r, CAST(max(ahead) FILTER (n = 8 AND ahead < n) AS INTEGER) AS shard, CAST(max(ahead) FILTER (n = 9 AND ahead < n) AS INTEGER) AS grown_shard FROM j GROUP BY r),
z AS (SELECT doc_id, CAST(strlen(t) + 1 AS BIGINT) AS size, {_crc("t")} AS text_crc32, 'key' AS law, shard, grown_shard FROM d JOIN s USING (r), c)
SELECT *, row_number() OVER (PARTITION BY shard ORDER BY doc_id, size, text_crc32) - 1 AS slot FROM z"""

REMOVAL_SQL = """WITH d AS (SELECT doc_id, row_number() OVER () AS r, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT r, doc_id, i, b[i:i + 49] AS s FROM (SELECT r, doc_id, b, unnest(range(1, octet_length(b) - 48)) AS i FROM d)),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s HAVING count(*) > 1), h AS (SELECT r, i FROM w JOIN f USING (s) WHERE first < doc_id),
g AS (SELECT r, i, sum(CASE WHEN i - before <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS n FROM (SELECT r, i, coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), -100) AS before FROM h)),
x AS (SELECT r, min(i) AS a, max(i) + 50 AS z FROM g GROUP BY r, n),
k AS (SELECT r, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 1) AS a, a AS z FROM x
UNION ALL SELECT r, coalesce(last, 1), octet_length(b) + 1 FROM d LEFT JOIN (SELECT r, max(z) AS last FROM x GROUP BY r) USING (r)),
t AS (SELECT r, string_agg(hex(b[a:z - 1]), '' ORDER BY a) AS kept FROM k JOIN d USING (r) WHERE z > a GROUP BY r), n AS (SELECT r, sum(z - a) AS n_removed, count(*) AS n_spans FROM x GROUP BY r)
SELECT doc_id, octet_length(b) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN n USING (r) LEFT JOIN t USING (r)"""

ARCHIVE_SQL = """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), s AS (SELECT page_id, h, strlen(h) AS n, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS best FROM p)
SELECT page_id, n AS payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
1 + CAST((CAST('0x' || substr(x, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)), '') AS payload_digest,
CASE WHEN page_id IS NULL AND best IS NOT NULL OR page_id < best THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id IS NULL OR page_id < best THEN best END AS refers_to FROM s"""

LM_SQL = rf"""WITH c AS MATERIALIZED ({_CRC_TABLE}),
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_crc("CAST(doc_id AS VARCHAR)")} % 7 = 2 AS held_out, list_append(regexp_extract_all({_LOW}, '{_WORDS}'), '') AS w FROM documents, c),
t AS MATERIALIZED (SELECT r, held_out, unnest(w) AS w FROM d), u AS (SELECT w, count(*) AS c FROM t WHERE NOT held_out GROUP BY w), n AS (SELECT sum(c) AS n, count(*) AS v FROM u),
s AS (SELECT r, count(*) AS n_tokens, count(c) AS n_known, sum(log10((coalesce(c, 0) + 1) / (SELECT n + v + 1 FROM n))) AS b FROM t LEFT JOIN u USING (w) GROUP BY r)
SELECT doc_id, held_out, n_tokens, n_known, CAST((SELECT n FROM n) AS BIGINT) AS train_tokens, round(b, 3) AS base_score FROM d JOIN s USING (r)"""


NEAR_VECTORS_SQL = """WITH RECURSIVE e AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
f AS MATERIALIZED (SELECT r, vec_id, v, sqrt(list_dot_product(v, v)) AS n FROM e WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (SELECT a.r AS a, b.r AS b FROM f a JOIN f b ON a.r <> b.r AND len(a.v) = len(b.v) AND list_dot_product(a.v, b.v) >= 0.95 * a.n * b.n),
w AS (SELECT r AS a, r AS b FROM f UNION SELECT w.a, l.b FROM w JOIN l ON l.a = w.b),
c AS (SELECT w.a AS r, min(f.vec_id) AS least FROM w JOIN f ON f.r = w.b GROUP BY w.a), n AS (SELECT a AS r, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, CASE WHEN c.r IS NULL THEN e.vec_id ELSE least END AS component_id, e.vec_id IS NOT DISTINCT FROM CASE WHEN c.r IS NULL THEN e.vec_id ELSE least END AS kept
FROM e LEFT JOIN c USING (r) LEFT JOIN n USING (r)"""


def _lloyd_sql(k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: int = 2) -> str:
    """Rounds of assignments and means, one after the other."""
    away = "list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = [
        f"""e AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: {scale} * x::DOUBLE) AS y FROM embeddings WHERE len(embedding) = {dims}),
x AS MATERIALIZED (SELECT r, vec_id, list_transform(y, lambda z: CAST(floor(z) AS BIGINT)) AS v FROM e WHERE len(list_filter(y, lambda z: z IS NULL OR NOT isfinite(z) OR floor(z) <= -134217728 OR floor(z) >= 134217728)) = 0),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS k, v FROM (SELECT sha256('{seed}:' || vec_id) AS h, v FROM x ORDER BY h, v LIMIT {k}))"""
    ]
    for i in range(rounds + 1):
        steps.append(f"a{i} AS MATERIALIZED (SELECT x.r, arg_min(k, (d, k)) AS k, min(d) AS d FROM (SELECT x.r, k, CAST({away} AS BIGINT) AS d FROM x, c{i} c) x GROUP BY x.r)")
        if i < rounds:
            mean = "SELECT k, list(m ORDER BY p) AS v FROM (SELECT k, p, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS m FROM (SELECT k, p, sum(y) AS s, count(*) AS n FROM (SELECT k, unnest(v) AS y, generate_subscripts(v, 1) AS p FROM x JOIN "
            steps.append(f"m{i} AS ({mean}a{i} USING (r)) GROUP BY k, p)) GROUP BY k), c{i + 1} AS MATERIALIZED (SELECT k, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m USING (k))")
    last = f"SELECT vec_id, k AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256 FROM a{rounds} JOIN x USING (r) JOIN c{rounds} c USING (k)"
    return "WITH " + ",\n".join(steps) + "\n" + last


def oracle_sql() -> dict[str, str]:
    return {
        "op3_suffix_levels": REMOVAL_SQL, "op4_jump_sharding": SHARD_SQL, "op6_arc_to_warc": ARCHIVE_SQL, "op7_quality_ledger": QUALITY_SQL,
        "op9_positional_index": CONTAMINATION_SQL, "language_model_counts": LM_SQL, "quality_ablation": ABLATION_SQL,
        "op12_rotation_codes": NEAR_VECTORS_SQL, "op13_dual_tree_lloyd": _lloyd_sql(),
    }
