"""The queries of this subpackage over the given tables, with the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import read, text_session

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(text_session(spark), sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return build
    return add


@query("op1_token_count")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyline.llm.token_count import count_tokens
    return count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op6_byte_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyline.llm.bpe import digests
    return digests(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@query("op7_simhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyline.llm.simhash import near_duplicates
    return near_duplicates(read(spark, sf_dir, "documents"))


_OP10 = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS k
  FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(i) WHERE len(w) > 0),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM d, ns, unnest(range(1, len(w) - n + 2)) AS t(i) WHERE len(w) >= n),
hits AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.n = bw.n),
nh AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id),
it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN nh USING (doc_id) LEFT JOIN it USING (doc_id)
"""


@query("op10_decontamination", _OP10)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyline.llm.decontam import summary
    return summary(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


_OP2 = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
          WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT c.vec_id, coalesce(n_links, 0) AS n_links, component_id, c.vec_id = component_id AS kept
FROM c LEFT JOIN n USING (vec_id)
"""


@query("op2_embedding_dedup", _OP2)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyline.llm.embed_dedup import near_duplicates
    return near_duplicates(read(spark, sf_dir, "embeddings"))


_OP5 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h),
q AS (
  SELECT page_id, strlen(html) AS n, CASE WHEN page_id <> first THEN first END AS refers_to,
         list_transform(range(8), lambda i: CAST('0x' || h[i * 5 + 1:i * 5 + 5] AS BIGINT)) AS parts
  FROM p JOIN f USING (h))
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'
         [CAST((parts[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31 AS INTEGER) + 1]), '') AS payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM q
"""


@query("op5_warc", _OP5)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyline.llm.warc import round_trip
    return round_trip(read(spark, sf_dir, "pages"))


@query("op4_line_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyline.llm.line_dedup import dedup_lines
    return dedup_lines(read(spark, sf_dir, "documents"), report=True).select("doc_id", "text", "n_lines", "n_removed")


@query("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyline.llm.langid import identify
    return identify(read(spark, sf_dir, "documents"))


@query("op9_pii_surrogates")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key here is a fixed one; whoever runs this on real data brings their own and keeps it."""
    from tallyline.llm.pii import pseudonymize
    return pseudonymize(read(spark, sf_dir, "documents").select("doc_id", "text"), b"surrogates of the test tables")


@query("op3_html_text")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyline.llm.html_text import extract
    return extract(read(spark, sf_dir, "pages"))


# CRC-32 of the digits of an id, by the table of its 256 remainders.
_OP13 = """
WITH RECURSIVE crc_step AS (
  SELECT i, 0 AS k, CAST(i AS BIGINT) AS r FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END FROM crc_step WHERE k < 8),
crc_table AS (SELECT list(r ORDER BY i) AS t FROM crc_step WHERE k = 8),
t AS (
  SELECT conv_id, md5(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS code,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words, turn
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, list(code ORDER BY turn NULLS FIRST, code) AS codes, list(words ORDER BY turn NULLS FIRST, code) AS words
  FROM t GROUP BY conv_id),
h AS (
  SELECT c.*, xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
         lambda a, b: xor(tab[xor(a, b) % 256 + 1], a >> 8), CAST(4294967295 AS BIGINT)), 4294967295) % 4 AS h
  FROM c, (SELECT t AS tab FROM crc_table)),
r AS (
  SELECT h.conv_id, list_concat(coalesce(b.codes[1:h], []), h.codes[h + 1:]) AS codes,
         list_concat(coalesce(b.words[1:h], []), h.words[h + 1:]) AS words
  FROM h LEFT JOIN c b ON b.conv_id = h.conv_id - h.conv_id % 20),
p AS (
  SELECT conv_id, d AS depth, md5(array_to_string(codes[1:d], ',')) AS k, len(codes) = d AS is_end,
         CASE WHEN d > 0 THEN md5(array_to_string(codes[1:d - 1], ',')) END AS up, CASE WHEN d > 0 THEN words[d] ELSE 0 END AS w
  FROM r, unnest(range(0, len(codes) + 1)) AS x(d)),
n AS (
  SELECT k, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(w) AS own, max(up) AS up,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends_sha256
  FROM p GROUP BY k, depth),
kids AS (SELECT up AS k, depth - 1 AS depth, count(*) AS n FROM n WHERE depth > 0 GROUP BY ALL),
sub AS (
  SELECT p.k, p.depth, sum(n.own) AS saved_tokens, count(*) FILTER (kids.n IS NULL) AS n_leaves
  FROM n JOIN p ON p.conv_id = n.conv_id AND p.depth <= n.depth LEFT JOIN kids ON kids.k = n.k AND kids.depth = n.depth
  GROUP BY p.k, p.depth)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0) AS n_children, n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN sub ON sub.k = n.k AND sub.depth = n.depth LEFT JOIN kids ON kids.k = n.k AND kids.depth = n.depth
LEFT JOIN n u ON u.k = n.up AND u.depth = n.depth - 1
"""


@query("op13_conversation_trie", _OP13)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyline.llm.conv_trie import numbered_turns, prefix_trie, with_shared_heads
    return prefix_trie(with_shared_heads(numbered_turns(read(spark, sf_dir, "conversations"))))


_OP11 = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, text, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM (SELECT DISTINCT item_id, text FROM benchmark)),
q AS (SELECT item_id, text, term, count(*) AS times FROM (SELECT item_id, text, unnest(w) AS term FROM b) GROUP BY ALL),
g AS (SELECT count(*) AS n, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY ALL),
wt AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, g GROUP BY term),
m AS (SELECT r, doc_id, 25 + (75 * len(w) * n) // l AS m FROM d, g WHERE len(w) > 0),
s AS (
  SELECT item_id, text, r, doc_id, CAST(sum(times * wt.w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN wt USING (term) JOIN m USING (r) GROUP BY ALL),
k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
  FROM s WHERE score > 0)
SELECT * FROM k WHERE rank <= 10
"""


@query("op11_lexical_search", _OP11)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyline.llm.lexical import rank_documents
    return rank_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


# All pairs: equal to the query as long as a query is compared with the whole table, as on small ones.
_OP12 = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.e, b.e) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id
      WHERE a.vec_id % 20 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20
"""


@query("op12_nearest_neighbours", _OP12)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyline.llm.ann import nearest
    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
