"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from foldcast.llm import decontamination, embeddings, wavelet
from foldcast.llm.common import table
from foldcast.llm.jaccard import THRESHOLD, near_duplicates
from foldcast.llm.lines import without_common_lines
from foldcast.llm.packing import best_fit
from foldcast.llm.pii import personal_data
from foldcast.llm.prefixes import prefix_trie
from foldcast.llm.quality import quality
from foldcast.llm.ranked import ranked_search
from foldcast.llm.suffixes import without_repeats
from foldcast.llm.token_counts import token_counts
from foldcast.llm.toxicity import toxicity


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit(table(spark, sf_dir, "documents"), vocabulary=public_tokenizers.path("byte_bpe_50k.json"), near=THRESHOLD)


def op4_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"), keep=False)


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op7_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = wavelet.write_shards(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return wavelet.read_documents(shards)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_common_lines(table(spark, sf_dir, "documents"), keep=False)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_token_counts": op2_token_counts,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_embedding_near_duplicates": op4_embedding_near_duplicates,
    "op5_repeated_passages": op5_repeated_passages,
    "op6_personal_data": op6_personal_data,
    "op7_wavelet_shards": op7_wavelet_shards,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_decontamination": op9_decontamination,
    "op10_quality": op10_quality,
    "op11_ranked_search": op11_ranked_search,
    "op12_line_dedup": op12_line_dedup,
    "op13_prefix_trie": op13_prefix_trie,
}

WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES: dict[str, str] = {
    "op4_embedding_near_duplicates": """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a),
counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT r.vec_id, coalesce(any_value(c.n), 0) AS n_links, min(r.other) AS component_id, min(r.other) = r.vec_id AS kept
FROM reach r LEFT JOIN counted c ON c.vec_id = r.vec_id GROUP BY r.vec_id""",
    "op9_decontamination": f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
i AS (SELECT item_id, w, least(10, len(w)) AS m FROM (SELECT item_id, {WORDS} AS w FROM benchmark)),
windows AS (
  SELECT DISTINCT item_id, m, w[k : k + m - 1] AS x
  FROM (SELECT item_id, m, w, unnest(range(1, len(w) - m + 2)) AS k FROM i WHERE m > 0)),
places AS (
  SELECT doc_id, m, k, w[k : k + m - 1] AS x
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS k
        FROM d JOIN (SELECT DISTINCT m FROM windows) ON len(w) >= m)),
found AS (SELECT p.doc_id, p.k, p.m, v.item_id FROM places p JOIN windows v ON p.m = v.m AND p.x = v.x),
hits AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + m)) AS place FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_ranked_search": r"""
WITH d AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM documents),
q AS (
  SELECT DISTINCT item_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM benchmark),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY doc_id, term),
n AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
size AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, size WHERE term IN (SELECT term FROM q) GROUP BY term),
scored AS (
  SELECT item_id, tf.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN n ON n.doc_id = tf.doc_id, size
  GROUP BY item_id, tf.doc_id),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10""",
    "op12_line_dedup": """
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l AS (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS position FROM split),
k AS (
  SELECT doc_id, line, position,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
common AS (
  SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT k.doc_id, line, position, c.key IS NOT NULL AND k.doc_id <> c.last AS gone FROM k LEFT JOIN common c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id""",
    "op13_prefix_trie": r"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
bits(i, r) AS (
  WITH RECURSIVE b(i, k, r) AS (
    SELECT CAST(i AS BIGINT), 0, CAST(i AS BIGINT) FROM range(256) AS v(i)
    UNION ALL SELECT i, k + 1, CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END FROM b WHERE k < 8)
  SELECT i, r FROM b WHERE k = 8),
crc(c, r) AS (
  WITH RECURSIVE s(c, k, r) AS (
    SELECT DISTINCT c, 0, 4294967295 FROM t
    UNION ALL
    SELECT s.c, s.k + 1, xor(s.r >> 8, b.r)
    FROM s JOIN bits b ON b.i = xor(s.r & 255, ascii(substr(CAST(s.c AS VARCHAR), s.k + 1, 1)))
    WHERE s.k < length(CAST(s.c AS VARCHAR)))
  SELECT c, r FROM s WHERE k = length(CAST(c AS VARCHAR))),
plan AS (SELECT c, c - c % 20 AS base, xor(r, 4294967295) % 4 AS h FROM crc),
size AS (
  SELECT p.c, p.base, p.h, (SELECT count(*) FROM t WHERE t.c = p.base AND t.pos <= p.h) AS lead FROM plan p),
rebuilt AS (
  SELECT s.c, t.pos, t.role, t.text FROM size s JOIN t ON t.c = s.base AND t.pos <= s.h
  UNION ALL SELECT s.c, t.pos - s.h + s.lead, t.role, t.text FROM size s JOIN t ON t.c = s.c AND t.pos > s.h),
path AS (
  SELECT c, 0 AS depth, '' AS node, 0 AS words FROM plan
  UNION ALL
  SELECT c, pos, md5(string_agg(md5(role) || md5(text), '') OVER (PARTITION BY c ORDER BY pos)),
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) FROM rebuilt),
ended AS (SELECT c, max(depth) AS len FROM path GROUP BY c),
node AS (
  SELECT p.depth, p.node, min(p.c) AS owner, count(*) AS n_convs, any_value(p.words) AS words,
    string_agg(CAST(p.c AS VARCHAR), ',' ORDER BY p.c) FILTER (WHERE e.len = p.depth) AS ends
  FROM path p JOIN ended e USING (c) GROUP BY p.depth, p.node),
link AS (
  SELECT n.depth, n.node, n.owner, p.owner AS parent, p.node AS parent_node
  FROM node n JOIN path x ON x.c = n.owner AND x.depth = n.depth - 1 JOIN node p ON p.depth = x.depth AND p.node = x.node),
children AS (SELECT depth - 1 AS depth, parent_node AS node, count(*) AS n FROM link GROUP BY ALL),
below AS (
  SELECT a.depth, a.node, sum((n.n_convs - 1) * n.words) AS saved, count(*) FILTER (WHERE k.n IS NULL) AS leaves
  FROM node n JOIN path a ON a.c = n.owner AND a.depth <= n.depth
  LEFT JOIN children k ON k.depth = n.depth AND k.node = n.node
  GROUP BY a.depth, a.node)
SELECT n.owner AS conv_id, CAST(n.depth AS BIGINT) AS depth, l.parent AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
  CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM node n JOIN below b ON b.depth = n.depth AND b.node = n.node
LEFT JOIN link l ON l.depth = n.depth AND l.node = n.node
LEFT JOIN children k ON k.depth = n.depth AND k.node = n.node""",
}
