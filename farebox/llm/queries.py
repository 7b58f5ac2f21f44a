"""Registered queries of the operators (``opN_<name>``) and their SQL twins."""

from __future__ import annotations

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession

from farebox.llm import bpe, dac, fertility, lengths, mixing, mtree, prefixes, repair, secrets, simhash, toxicity, urls, warc
from farebox.llm.common import table

RANKS = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"
WORDS = "word_bpe_49k.json"


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op2_fertility_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.quality(table(spark, sf_dir, "documents"), tokenizers.path(PIECES), tokenizers.path(RANKS),
                             tokenizers.PATTERN)


def op3_target_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_mtree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(table(spark, sf_dir, "embeddings"))


def op5_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.token_lengths(table(spark, sf_dir, "documents"), tokenizers.path(RANKS), tokenizers.PATTERN)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), tokenizers.path(RANKS), tokenizers.PATTERN, with_ids=False)


def op7_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (warc.round_trip(table(spark, sf_dir, "pages"))
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op9_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (simhash.near_duplicates(table(spark, sf_dir, "documents"))
            .select("doc_id", "fingerprint", "component_id"))


def op11_direct_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dac.token_file_round_trip(table(spark, sf_dir, "documents"), tokenizers.path(WORDS))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair.audit(repair.damage(conversations), of=conversations)


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_fertility_quality, op3_target_mix, op4_mtree_top_k, op5_token_lengths, op6_byte_bpe, op7_warc_round_trip,
    op8_toxicity, op9_url_verdicts, op10_simhash_near_dedup,
    op11_direct_codes, op12_prefix_trie, op13_structure_repair)}

ORACLE: dict[str, str] = {
    "op4_mtree_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op9_url_verdicts": """
        WITH RECURSIVE u AS (
            SELECT page_id, url, html, coalesce(regexp_extract(url, '(?s)^.*?://(.*)$', 1), '') AS after FROM pages),
        p AS (
            SELECT page_id, html,
                   translate(regexp_extract(after, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(substr(after, length(regexp_extract(after, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u),
        rules(verdict, h, start) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
            ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
        fits AS (
            SELECT page_id, max_by(h || start, length(h || start)) AS rule, max_by(verdict, length(h || start)) AS verdict
            FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, start) GROUP BY page_id)
        SELECT p.page_id, host, path, rule,
               -- without canonical or refresh links a page has no aliases; the twin stops where there are any
               coalesce(fits.verdict, CASE WHEN regexp_matches(html, '(?i)<(link|meta)[^>]*(canonical|refresh)')
                                           THEN error('aliases are not covered by this twin') ELSE 'allow' END) AS verdict
        FROM p LEFT JOIN fits USING (page_id)""",
    "op12_prefix_trie": """
        WITH RECURSIVE bits(i, k, v) AS (
            SELECT range::UBIGINT, 0, range::UBIGINT FROM range(256) UNION ALL
            SELECT i, k + 1, xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END::UBIGINT) FROM bits WHERE k < 8),
        crc AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
        own AS (
            SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
                                 ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        hashed AS (
            SELECT conv_id, turns, conv_id - conv_id % 5 AS source, xor(4294967295::UBIGINT, list_reduce(
                       list_prepend(4294967295::UBIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
                       lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::BIGINT + 1]))) % 9 AS h
            FROM own, crc),
        rebuilt AS (
            SELECT a.conv_id, list_concat(coalesce(b.turns, [])[1:a.h::BIGINT], a.turns[a.h::BIGINT + 1:]) AS s
            FROM hashed a LEFT JOIN own b ON b.conv_id = a.source),
        paths AS (
            SELECT conv_id, len(s) AS n, unnest(range(0, len(s) + 1)) AS depth, s FROM rebuilt),
        keyed AS (
            SELECT conv_id, n, depth, sha256(to_json(s[1:depth])) AS node, sha256(to_json(s[1:depth - 1])) AS parent,
                   CASE WHEN depth = 0 THEN 0 ELSE octet_length(encode(s[depth].t)) END AS bytes, s FROM paths),
        nodes AS (
            SELECT node, any_value(CASE WHEN depth > 0 THEN parent END) AS parent, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                   any_value(bytes) AS bytes, arg_min(s, conv_id) AS s,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
            FROM keyed GROUP BY node, depth),
        children AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
        full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (node)),
        under AS (
            SELECT unnest(list_transform(range(0, depth + 1), lambda k: sha256(to_json(s[1:k])))) AS node,
                   (n_convs - 1) * bytes AS saved, (n_children = 0)::INT AS leaf FROM full_nodes),
        sums AS (SELECT node, sum(saved)::BIGINT AS saved_tokens, sum(leaf)::BIGINT AS n_leaves FROM under GROUP BY node)
        SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, f.ends_sha256
        FROM full_nodes f JOIN sums USING (node) LEFT JOIN nodes p ON p.node = f.parent""",
}
