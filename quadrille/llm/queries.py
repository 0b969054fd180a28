"""The registered queries over whole tables, and SQL for those that SQL can express.

Every query is thin: it reads its table, calls its operator with production parameters and derives the digest columns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, centroids, embedding_graph, importance, merkle, mixing, quality_rules, sharding, simhash, substring_dedup, token_store, url_filter, warc

#: Places of the tokenizer files; parameters of the operators.
WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.filter_urls(spark.read.parquet(f"{sf}/pages.parquet"))


def op2_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality_rules.ledger(spark.read.parquet(f"{sf}/documents.parquet"), keep=["doc_id"])
    base, kept = ~quality_rules.passes("base"), quality_rules.passes("v1")
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), kept.alias("kept"), "fail_bits", quality_rules.sole_failure("v1").alias("sole_rule"))


def op3_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring_dedup.remove_repeats(spark.read.parquet(f"{sf}/documents.parquet"), with_text=False)


def op4_token_store(spark: SparkSession, sf: str) -> DataFrame:
    store = token_store.write_store(spark.read.parquet(f"{sf}/documents.parquet"), WORD_BPE, end_id=1)
    return token_store.read_store(store).withColumnRenamed("doc", "doc_id")


def op5_sharding(spark: SparkSession, sf: str) -> DataFrame:
    rows = sharding.shard(spark.read.parquet(f"{sf}/documents.parquet"), shards=16)
    law = {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}
    return rows.withColumns(law).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op6_mixing(spark: SparkSession, sf: str) -> DataFrame:
    rows = mixing.mix(spark.read.parquet(f"{sf}/documents.parquet"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def op7_simhash(spark: SparkSession, sf: str) -> DataFrame:
    rows = simhash.near_duplicates(spark.read.parquet(f"{sf}/documents.parquet"))
    return rows.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


def op8_importance(spark: SparkSession, sf: str) -> DataFrame:
    return importance.resample(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))


def op9_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return byte_bpe.encode_documents(docs, BYTE_BPE, public_tokenizers.PATTERN, keep=["doc_id"], with_ids=False)


def op10_embedding_graph(spark: SparkSession, sf: str) -> DataFrame:
    return embedding_graph.link_vectors(spark.read.parquet(f"{sf}/embeddings.parquet"))


def op11_centroids(spark: SparkSession, sf: str) -> DataFrame:
    rows = centroids.cluster_vectors(spark.read.parquet(f"{sf}/embeddings.parquet"))
    return rows.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", centroids.centroid_digest().alias("centroid_sha256"))


def op12_merkle(spark: SparkSession, sf: str) -> DataFrame:
    rows = merkle.manifest(spark.read.parquet(f"{sf}/documents.parquet"), present=merkle.tampered(), with_path=False)
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_warc(spark: SparkSession, sf: str) -> DataFrame:
    rows = warc.read_archives(warc.write_archives(spark.read.parquet(f"{sf}/pages.parquet")))
    return rows.select(F.col("page").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id")


OP1_SQL = r"""
WITH RECURSIVE p AS (
  SELECT page_id, url, html,
    CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
h AS (
  SELECT page_id, url, html, lower(regexp_extract(rest, '^[^/?#]*')) AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS tail, rest
  FROM p),
tags AS (
  SELECT host, url, host || CASE WHEN tail = '' THEN '/' ELSE tail END AS node,
    unnest(regexp_extract_all(coalesce(html, ''), '(?is)<(?:link|meta)\b[^>]*>')) AS tag
  FROM h WHERE contains(coalesce(url, ''), '://') AND regexp_matches(coalesce(html, ''), '(?i)canonical|http-equiv')),
links AS (
  SELECT host, url, node, replace(trim(CASE
    WHEN regexp_matches(tag, '(?is)^<link') AND regexp_matches(tag, '(?is)\brel\s*=\s*["'']?[^"''>]*\bcanonical\b')
      THEN regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''>\s]+)', 1)
    WHEN regexp_matches(tag, '(?is)\bhttp-equiv\s*=\s*["'']?refresh')
      THEN regexp_extract(tag, '(?is)\bcontent\s*=\s*["'']?\s*[\d.]*\s*[;,]\s*url\s*=\s*["'']?([^"''>]+)', 1)
    END), '&amp;', '&') AS target
  FROM tags),
absolute AS (
  SELECT node, CASE
    WHEN contains(target, '://') THEN substr(target, strpos(target, '://') + 3)
    WHEN starts_with(target, '//') THEN substr(target, 3)
    WHEN starts_with(target, '/') THEN host || target
    ELSE host || coalesce(nullif(regexp_extract(regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*'), '^[^/]*(.*/)', 1), ''), '/') || target END AS t
  FROM links WHERE target <> '' AND NOT starts_with(target, '#')),
one AS (
  SELECT DISTINCT node AS u, lower(regexp_extract(t, '^[^/?#]*')) ||
    CASE WHEN regexp_extract(t, '^[^/?#]*([^#]*)', 1) = '' THEN '/' ELSE regexp_extract(t, '^[^/?#]*([^#]*)', 1) END AS v
  FROM absolute),
edges AS (SELECT u, v FROM one WHERE u <> v UNION SELECT v, u FROM one WHERE u <> v),
reach AS (SELECT u AS node, u AS other FROM edges UNION SELECT r.node, e.v FROM reach r JOIN edges e ON r.other = e.u),
rules(rule, host, path, allowed) AS (VALUES ('com/', 'com', '/', true), ('example.com/en/', 'example.com', '/en/', false),
  ('www.example.com/en/', 'www.example.com', '/en/', true), ('net/es/', 'net', '/es/', false), ('net/fr/', 'net', '/fr/', false)),
named AS (
  SELECT r.other, arg_max(q.allowed, length(q.rule)) AS allowed
  FROM (SELECT DISTINCT other, regexp_extract(other, '^[^/?#]*') AS host, regexp_extract(other, '^[^/?#]*([^?#]*)', 1) AS path FROM reach) r
  JOIN rules q ON (r.host = q.host OR ends_with(r.host, '.' || q.host)) AND starts_with(r.path, q.path) GROUP BY ALL),
class AS (
  SELECT node, min(other) AS component, CASE WHEN coalesce(bool_or(allowed), true) THEN 'allow' ELSE 'block' END AS verdict
  FROM reach LEFT JOIN named USING (other) GROUP BY node),
own AS (
  SELECT page_id, h.host, h.path, CASE WHEN contains(coalesce(url, ''), '://') THEN h.host || CASE WHEN tail = '' THEN '/' ELSE tail END END AS node,
    (SELECT arg_max(q.rule, length(q.rule)) FROM rules q
     WHERE (h.host = q.host OR ends_with(h.host, '.' || q.host)) AND starts_with(h.path, q.path)) AS rule
  FROM h)
SELECT page_id, own.host, own.path, own.rule,
  CASE WHEN q.allowed THEN 'allow' WHEN own.rule IS NOT NULL THEN 'block' ELSE coalesce(class.verdict, 'allow') END AS verdict,
  class.component, own.rule IS NULL AND class.verdict IS NOT NULL AS inherited
FROM own LEFT JOIN class USING (node) LEFT JOIN rules q ON own.rule = q.rule
"""

OP2_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
windows AS (
  SELECT r, unnest(range(1, len(w) - 3)) AS i, w FROM d WHERE len(w) >= 5),
joined AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS s FROM windows),
counted AS (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM joined),
repeated AS (
  SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS j FROM counted WHERE n > 1) GROUP BY r),
lines AS (
  SELECT r, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(l.dup, 0) AS n_dup_lines,
    coalesce(q.n, 0) AS n_repeat_words, coalesce(l.n, 0) AS n_lines,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS n_letters
  FROM d LEFT JOIN repeated q USING (r) LEFT JOIN lines l USING (r)),
f AS (
  SELECT *, n_words < 10 AS a, 100 * n_repeat_words > 20 * n_words AS b,
    word_chars < 2 * n_words OR word_chars > 20 * n_words AS c, 10 * n_symbols > 3 * n_words AS d,
    2 * n_dup_lines > n_lines AND n_lines > 3 AS e, 2 * n_upper > n_letters AND n_words >= 10 AS g
  FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, a OR b AS base_failed,
  NOT (a OR b OR c OR d OR e OR g) AS kept,
  (a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT + 32 * g::INT)::BIGINT AS fail_bits,
  CASE WHEN a::INT + b::INT + c::INT + d::INT + e::INT + g::INT = 1 THEN
    CASE WHEN a THEN 'few_words' WHEN b THEN 'repeated_windows' WHEN c THEN 'word_length' WHEN d THEN 'symbols' WHEN e THEN 'duplicate_lines' ELSE 'shouting' END END AS sole_rule
FROM f
"""

OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, w FROM d WHERE len(w) >= 20),
hashed AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s FROM windows),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS n FROM hashed) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t
  FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5(doc_id::VARCHAR) AS key
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM d GROUP BY source),
ordered AS (
  SELECT *, row_number() OVER w AS n, 1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER before, 0)::DOUBLE AS left_over,
    sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS rate
  FROM s WINDOW w AS (ORDER BY 2 * source_size / weight, source NULLS LAST),
    before AS (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT left_over, rate FROM ordered WHERE weight * left_over / rate <= 2 * source_size ORDER BY n LIMIT 1),
t AS (
  SELECT source, source_size,
    CASE WHEN weight * level.left_over / level.rate > 2 * source_size THEN (2 * source_size)::DOUBLE ELSE weight * level.left_over / level.rate END AS target
  FROM ordered, level),
placed AS (
  SELECT doc_id, size, source_size, target, floor(target)::BIGINT AS budget,
    sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING)::BIGINT - size AS pos
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size + greatest(0, least(size, budget % source_size - pos)) END::BIGINT AS taken
FROM placed
"""


#: Every pair of a label, by brute force.
OP10_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda x: isfinite(x::DOUBLE))) AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT u AS node, w AS other FROM l UNION SELECT r.node, l.w FROM reach r JOIN l ON r.other = l.u),
c AS (SELECT node AS vec_id, least(node, min(other)) AS component_id FROM reach GROUP BY node),
n AS (SELECT u AS vec_id, count(*) AS n_links FROM l GROUP BY u)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, vec_id = coalesce(component_id, vec_id) AS kept
FROM (SELECT vec_id FROM embeddings) LEFT JOIN n USING (vec_id) LEFT JOIN c USING (vec_id)
"""


def _op11_sql(rounds: int = 10) -> str:
    """Every vector against every centroid, a pair of tables a round."""
    near = """SELECT r, e, k, d, c FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY d, k) AS n FROM (
    SELECT v.r, v.e, k, c, list_sum(list_transform(list_zip(v.e, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM v, {}))
    WHERE n = 1"""
    parts = []
    for i in range(1, rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED ({near.format(f"c{i - 1}")}),
c{i} AS MATERIALIZED (SELECT k, coalesce(u.c, o.c) AS c FROM c{i - 1} o LEFT JOIN (
    SELECT k, list((s - ((s % n + n) % n)) // n ORDER BY j) AS c FROM (
      SELECT k, j, sum(x) AS s, count(*) AS n FROM (SELECT k, unnest(e) AS x, unnest(range(64)) AS j FROM a{i}) GROUP BY k, j) GROUP BY k) u USING (k))""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::HUGEINT) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x::DOUBLE))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, e) - 1 AS k, e AS c
  FROM (SELECT sha256('3:' || vec_id) AS h, e FROM v WHERE vec_id IS NOT NULL ORDER BY h, e LIMIT 8)),
{", ".join(parts)},
last AS ({near.format(f"c{rounds}")})
SELECT vec_id, k::INT AS cluster, d::BIGINT AS distance, sum(d) OVER (PARTITION BY k)::BIGINT AS cluster_inertia,
  sum(d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM last JOIN v USING (r)
"""


def _op12_sql(levels: int = 8) -> str:
    """Tables of every level, and the rows walking up through them; enough for 8 to the power of ``levels`` leaves a group."""

    def up(name: str, start: str, walkers: str) -> str:
        """Levels ``name{k}`` over ``start (g, i, h)`` and walkers ``name w{k} (r, g, i, cur, proof)``."""
        out = [f"{name}0 AS (SELECT *, count(*) OVER (PARTITION BY g) AS m FROM {start}), {name}w0 AS ({walkers})"]
        for k in range(levels):
            out.append(f"""{name}r{k} AS MATERIALIZED (SELECT g, i // 8 AS run, max(m) AS m, list(h ORDER BY i) AS hs FROM {name}{k} GROUP BY g, i // 8),
{name}{k + 1} AS (SELECT g, run AS i, CASE WHEN m = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h, count(*) OVER (PARTITION BY g) AS m FROM {name}r{k}),
{name}w{k + 1} AS MATERIALIZED (
  SELECT r, w.g, run AS i, proof || a || b AS proof, CASE WHEN m = 1 THEN cur ELSE sha256(a || cur || b) END AS cur
  FROM (SELECT w.*, run, m, array_to_string(hs[:w.i % 8], '') AS a, array_to_string(hs[w.i % 8 + 2:], '') AS b
    FROM {name}w{k} w JOIN {name}r{k} q ON w.g = q.g AND w.i // 8 = q.run) w)""")
        return ",\n".join(out)

    table = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        table.append(byte)
    crc = "xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)), lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])))"
    value = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c} END"
    leaf = lambda text: "sha256(" + " || ".join(value(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    now = f"CASE WHEN {crc} % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END"
    return f"""
WITH t AS (SELECT {table}::BIGINT[] AS crc_table),
l AS (SELECT *, {leaf("text")} AS leaf, {leaf("now")} AS changed FROM (SELECT *, {now} AS now FROM documents, t)),
d AS MATERIALIZED (
  SELECT *, row_number() OVER () AS r, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
  FROM l),
{up("x", "(SELECT g, i, leaf AS h FROM d)", "SELECT r, g, i, changed AS cur, '' AS proof FROM d")},
s AS (SELECT g, h AS subroot FROM x{levels}),
{up("y", "(SELECT 0 AS g, g AS i, subroot AS h FROM s)", f"SELECT r, 0 AS g, g AS i, cur, proof FROM xw{levels}")}
SELECT doc_id, leaf, subroot, y{levels}.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = y{levels}.h AS verified
FROM d JOIN s USING (g) JOIN yw{levels} w USING (r), y{levels}
"""


OP13_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS least FROM pages),
q AS (SELECT *, strlen(body) AS n, strlen(body) >= 100 AND least IS NOT NULL AND page_id IS DISTINCT FROM least AS again, sha256(body) AS digest FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN least END AS refers_to, '<urn:page:' || coalesce(page_id::VARCHAR, 'null') || ':' || digest || '>' AS record_id
FROM q
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filters": OP1_SQL,
        "op2_quality_rules": OP2_SQL,
        "op3_substring_dedup": OP3_SQL,
        "op6_mixing": OP6_SQL,
        "op10_embedding_graph": OP10_SQL,
        "op11_centroids": _op11_sql(),
        "op12_merkle": _op12_sql(),
        "op13_warc": OP13_SQL,
    }
