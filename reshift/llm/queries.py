"""The ``opN_<name>`` queries over the whole tables, and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reshift.llm import bpe, lines, merkle, minhash, negatives, packing, pii, pivots, quality, tokens, toxicity, trie, urls
from reshift.llm.common import table


def op1_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.duplicates(table(spark, sf_dir, "documents"))


def op2_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit_damaged_copy(table(spark, sf_dir, "pages"))


def op3_quality_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge(docs, table(spark, sf_dir, "labels")).select("doc_id", "quality.*")


def op4_url_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages).select("page_id", "url_verdict.*")


def op5_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.duplicates(table(spark, sf_dir, "embeddings"))


def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_checked(table(spark, sf_dir, "documents"))


def op7_factorization_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.judge(docs, table(spark, sf_dir, "labels")).select("doc_id", "toxicity.*")


def op8_range_coder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.round_trip(table(spark, sf_dir, "documents"))


def op9_exact_complement_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op11_sorted_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.drop_repeated_lines(docs).select("doc_id", "line_dedup.*", F.sha2("text", 256).alias("kept_sha256"))


def op12_centroid_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_threshold_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", shifted)
    return negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)


def queries():
    return {f.__name__: f for f in (
        op1_weighted_minhash, op2_merkle_audit, op3_quality_ratio, op4_url_ratio, op5_pivot_index, op6_surrogates,
        op7_factorization_machine, op8_range_coder, op9_exact_complement_packing, op10_bpe_automaton,
        op11_sorted_runs, op12_centroid_trie, op13_threshold_negatives)}


# Five-word shingles, word hashes, models and tokenizers are beyond SQL; the embeddings are not.
OP2_SQL = """
WITH page AS (
    SELECT page_id, coalesce(html, '') AS html,
        'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: '
        || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, ''))
        || chr(13) || chr(10) || chr(13) || chr(10) AS header
    FROM pages
), record AS (
    SELECT page_id AS record_id, floor(page_id / 1000)::BIGINT AS file, strlen(header) + strlen(html) + 4 AS length,
        sha256('leaf' || chr(10) || header || html) AS primary_hash,
        CASE WHEN page_id % 97 = 13 AND html <> '' THEN sha256('leaf' || chr(10) || header
            || CASE WHEN html[1] = '~' THEN '!' ELSE '~' END || substr(html, 2)) END AS replica_hash
    FROM page
), placed AS (
    SELECT *, coalesce(sum(length) OVER (PARTITION BY file ORDER BY record_id, primary_hash
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset"
    FROM record
)
SELECT file, "offset", record_id, length::BIGINT AS length, primary_hash, replica_hash, 'altered' AS status
FROM placed WHERE replica_hash IS NOT NULL
"""

OP5_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), u AS (
    SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM v
), link AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
    WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.9
), reach AS (
    SELECT vec_id AS node, vec_id AS seen FROM embeddings
    UNION SELECT r.node, l.b FROM reach r JOIN link l ON l.a = r.seen
), low AS (
    SELECT node, min(seen) AS component_id FROM reach GROUP BY node
), degree AS (
    SELECT a, count(*) AS n FROM link GROUP BY a
)
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, low.component_id, e.vec_id = low.component_id AS kept
FROM embeddings e JOIN low ON low.node = e.vec_id LEFT JOIN degree d ON d.a = e.vec_id
"""


OP11_SQL = """
WITH d AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
    SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d
), k AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM l
), heavy AS (
    SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
    SELECT k.doc_id, pos, line, coalesce(k.doc_id <> keeper, false) AS dropped FROM k LEFT JOIN heavy USING (key)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (dropped))::BIGINT AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

# CRC-32 of the decimal digits, bit by bit; a prefix is the text of its turns' digests
OP12_SQL = """
WITH t AS (
    SELECT conv_id::BIGINT AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
    FROM conversations WHERE conv_id IS NOT NULL
), digits AS (
    SELECT c, list_transform(range(1, length(c::VARCHAR) + 1), lambda k: ascii(substr(c::VARCHAR, k, 1))::BIGINT) AS bytes
    FROM (SELECT DISTINCT c FROM t)
), conv AS (
    SELECT c, c - c % 100 AS base, xor(4294967295, list_reduce(bytes, lambda a, b: list_reduce(range(8),
        lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(a, b)),
        4294967295::BIGINT)) % 6 AS h
    FROM digits
), there AS (
    SELECT conv.c, h, base, least(h, (SELECT count(*) FROM t WHERE t.c = base)) AS taken FROM conv
), rebuilt AS (
    SELECT there.c, t.i AS d, role, text FROM there JOIN t ON t.c = base AND t.i <= h
    UNION ALL SELECT there.c, taken + t.i - h, role, text FROM there JOIN t ON t.c = there.c AND t.i > h
), step AS (
    SELECT c, d, text, string_agg(md5(md5(role) || text), '') OVER (PARTITION BY c ORDER BY d) AS prefix FROM rebuilt
    UNION ALL SELECT c, 0, '', '' FROM conv
), length_of AS (
    SELECT c, max(d) AS n FROM step GROUP BY c
), node AS (
    SELECT prefix, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(length(text)) AS own,
        sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = n), '')) AS ends_sha256
    FROM step JOIN length_of USING (c) GROUP BY prefix, d
), child AS (
    SELECT left(prefix, length(prefix) - 32) AS prefix, count(*) AS n FROM node WHERE d > 0 GROUP BY 1
), below AS (
    SELECT a.prefix, sum(b.own) AS saved, count(*) FILTER (b.prefix NOT IN (SELECT prefix FROM child)) AS leaves
    FROM node a JOIN node b ON starts_with(b.prefix, a.prefix) GROUP BY a.prefix
)
SELECT node.conv_id, node.d::BIGINT AS depth, up.conv_id AS parent_conv_id, node.n_convs::BIGINT AS n_convs,
    coalesce(child.n, 0)::BIGINT AS n_children, leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, node.ends_sha256
FROM node JOIN below USING (prefix) LEFT JOIN child USING (prefix)
LEFT JOIN node up ON up.prefix = left(node.prefix, length(node.prefix) - 32) AND node.d > 0 AND up.d = node.d - 1
"""

OP13_SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pair AS (
    SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label, list_dot_product(a.e, b.e)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positive AS (
    SELECT anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score FROM pair WHERE label = anchor_label
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
    SELECT p.anchor_id, p.positive_id, pair.vec_id AS negative_id, positive_score, score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY score DESC, pair.vec_id) AS rank
    FROM positive p JOIN pair ON pair.anchor_id = p.anchor_id AND pair.label <> p.anchor_label
    WHERE 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT anchor_id::BIGINT AS anchor_id, positive_id::BIGINT AS positive_id, rank::INTEGER AS rank,
    negative_id::BIGINT AS negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 3
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_merkle_audit": OP2_SQL, "op5_pivot_index": OP5_SQL, "op11_sorted_runs": OP11_SQL,
            "op12_centroid_trie": OP12_SQL, "op13_threshold_negatives": OP13_SQL}
