"""The operators over their whole tables, as registered queries."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from mirrorset.llm import bpe, html, licenses, merkle, minhash, packing, quality, sharding, suffix_dedup, topk, trie
from mirrorset.llm import urls, whitening
from mirrorset.llm.catalog import query
from mirrorset.llm.common import table


@query()
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    documents = table(spark, sf_dir, "documents")
    return quality.classify(documents, quality.train(documents, table(spark, sf_dir, "labels")))


@query()
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and their decoded text, as digests."""
    return bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document, with their places in the packed sequences."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


#: Rules of the URL query: host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

_URL_SQL = """
WITH rules(rhost, rpath, rverdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), rest AS (
  SELECT page_id, CASE WHEN url IS NULL OR position('://' IN url) = 0 THEN ''
    ELSE substr(url, position('://' IN url) + 3) END AS r FROM pages
), parsed AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), fits AS (
  SELECT page_id, host, path, rhost || rpath AS rule, rverdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rhost) + length(rpath) DESC NULLS LAST, length(rhost) DESC) AS n
  FROM parsed LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict FROM fits WHERE n = 1
"""


@query(_URL_SQL)
def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url under nested rules."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge_urls(table(spark, sf_dir, "pages"), rules)


_TOPK_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a, v b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query(_TOPK_SQL)
def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best inner products for every fiftieth vector against all others."""
    rows = table(spark, sf_dir, "embeddings")
    return topk.top_k(rows, rows.where("vec_id % 50 = 0"))


@query()
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle fingerprints of every document and of an edit of it, and how alike they are."""
    return merkle.compare_with_edit(table(spark, sf_dir, "documents"))


@query()
def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.extract(table(spark, sf_dir, "pages"))


@query()
def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document, and whether it stays."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its 200-byte strings that occur more than once."""
    return suffix_dedup.removal_report(table(spark, sf_dir, "documents"))


@query()
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence wordings in every document, with coverage and spans."""
    return licenses.scan(table(spark, sf_dir, "documents"))


#: CRC-32 in SQL: the table of the polynomial 0xEDB88320, then one step a byte.
_CRC_TABLE = """crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t
)"""


def _crc32(text: str) -> str:
    return f"""xor(list_reduce(list_prepend(4294967295,
    list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda b: ('0x' || b)::BIGINT)),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295)"""


_SHARD_SQL = f"""
WITH {_CRC_TABLE}, d AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), k AS (
  SELECT doc_id, octet_length(encode(text)) + 1 AS size, md5(text) AS g, {_crc32("text")} AS text_crc32 FROM d, crc
), o AS (
  SELECT *, sum(size) OVER (ORDER BY g, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) - size AS begins,
    row_number() OVER (ORDER BY g, doc_id NULLS FIRST) AS n, sum(size) OVER () AS total FROM k
), s AS (
  SELECT *, (CASE WHEN sum(size) OVER (PARTITION BY g) * 16 * 64 <= total THEN min(begins) OVER (PARTITION BY g) ELSE begins END
    * 16) // total AS shard FROM o
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, shard::INTEGER AS shard,
  n - min(n) OVER (PARTITION BY shard) AS slot, NULL::INTEGER AS grown_shard
FROM s
"""


@query(_SHARD_SQL)
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen shards of nearly equal bytes for all documents."""
    return sharding.assign(table(spark, sf_dir, "documents"))


@query()
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First four whitened components of every vector."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


_TRIE_SQL = f"""
WITH {_CRC_TABLE}, turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS rn
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, c - c % 100 AS b, {_crc32("c::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT c FROM turns), crc
), mixed AS (
  SELECT convs.c, rn, role, text FROM convs JOIN turns ON turns.c = convs.b AND rn <= h
  UNION ALL
  SELECT convs.c, rn, role, text FROM convs JOIN turns ON turns.c = convs.c AND rn > h
), placed AS (
  SELECT c, row_number() OVER own AS d, count(*) OVER (PARTITION BY c) AS turns, length(text) AS chars,
    string_agg(sha256(length(role) || ':' || role || text), '') OVER own AS path
  FROM mixed WINDOW own AS (PARTITION BY c ORDER BY rn ROWS UNBOUNDED PRECEDING)
), members AS (
  SELECT * FROM placed
  UNION ALL
  SELECT c, 0, (SELECT count(*) FROM mixed WHERE mixed.c = convs.c), 0, '' FROM convs
), nodes AS (
  SELECT d, path, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved,
    count(*) FILTER (WHERE turns = d) = count(*) AS leaf,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE turns = d), '')) AS ends_sha256
  FROM members GROUP BY d, path
), owners AS (
  SELECT members.c, d, conv_id AS owner FROM members JOIN nodes USING (d, path)
), linked AS (
  SELECT nodes.*, owner AS parent_conv_id FROM nodes LEFT JOIN owners ON owners.c = conv_id AND owners.d = nodes.d - 1
), totals AS (
  SELECT owner AS conv_id, owners.d, sum(saved) AS saved, count(*) FILTER (WHERE leaf) AS leaves
  FROM nodes JOIN owners ON owners.c = nodes.conv_id AND owners.d <= nodes.d GROUP BY ALL
), children AS (
  SELECT parent_conv_id AS conv_id, d - 1 AS d, count(*) AS n FROM linked WHERE d > 0 GROUP BY ALL
)
SELECT conv_id, d::BIGINT AS depth, parent_conv_id, n_convs, coalesce(children.n, 0) AS n_children,
  totals.leaves AS n_leaves, totals.saved::BIGINT AS saved_tokens, ends_sha256
FROM linked JOIN totals USING (conv_id, d) LEFT JOIN children USING (conv_id, d)
"""


@query(_TRIE_SQL)
def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all conversations, with heads exchanged between neighbours."""
    turns = trie.ranked_turns(table(spark, sf_dir, "conversations"))
    return trie.prefix_trie(*trie.rebuilt(turns))
