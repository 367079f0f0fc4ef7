"""Registered queries of the training-data operators: name -> f(spark, sf_dir), whole tables, and the
DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from bluelines.llm import decontaminate, html_text, langid, line_dedup, merkle, mixing, near_dedup, packing, spelling, token_index, topk, toxicity, urls
from bluelines.llm.common import table
from bluelines.session import work_path


def op1_url_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_recurrent_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4_segment_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op5_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), work_path(spark, "tokens")
    buckets = token_index.write(docs, folder, corpus_pipeline.tokenizer_file())
    return token_index.read(spark, folder, docs.select("doc_id"), buckets)


def op6_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_line_edit_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_classes(table(spark, sf_dir, "documents"))


def op8_pigeonhole_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_compression_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op11_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), corpus_pipeline.tokenizer_file())


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_path(spark, "merkle")
    rows, groups = merkle.manifest(table(spark, sf_dir, "documents"), folder)
    return merkle.proofs(rows, folder, groups)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_url_language_model": op1_url_language_model,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_recurrent_html_text": op3_recurrent_html_text,
    "op4_segment_topk": op4_segment_topk,
    "op5_token_index": op5_token_index,
    "op6_toxic_segments": op6_toxic_segments,
    "op7_line_edit_join": op7_line_edit_join,
    "op8_pigeonhole_decontamination": op8_pigeonhole_decontamination,
    "op9_pivotal_mixing": op9_pivotal_mixing,
    "op10_compression_langid": op10_compression_langid,
    "op11_bestfit_packing": op11_bestfit_packing,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_spelling_variants": op13_spelling_variants,
}

# crc32 of the UTF-8 bytes of {0}: per byte one exclusive or and eight shifts (-1) of the reflected polynomial
CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
    string_split(hex(encode({0})), '')[1:0] || list_transform(range(1, strlen({0}) + 1), lambda i: substr(hex(encode({0})), CAST(2 * i - 1 AS INTEGER), 2)),
    lambda h: [CAST('0x' || h AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, s: CASE WHEN s >= 0 THEN xor(a, s) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295)"""


def _field(sql: str) -> str:
    return f"coalesce(strlen(CAST({sql} AS VARCHAR)) || ':' || CAST({sql} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


ORACLE = {
    "op13_spelling_variants": f"""
WITH RECURSIVE runs AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS times FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{7,}}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents) GROUP BY ALL),
hashed AS MATERIALIZED (SELECT *, {CRC32.format("(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)")} AS h FROM runs),
words AS MATERIALIZED (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT times, CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word
    FROM hashed) WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
rests AS MATERIALIZED (SELECT word, k, substr(word, 1, k - 1) || substr(word, k + 1) AS rest FROM words, LATERAL (SELECT unnest(range(1, length(word) + 1)) AS k)),
near AS MATERIALIZED (
  SELECT a.word AS a, b.word AS b FROM rests a JOIN rests b ON a.k = b.k AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, w.word FROM rests a JOIN words w ON w.word = a.rest
  UNION SELECT w.word, a.word FROM rests a JOIN words w ON w.word = a.rest),
best AS (
  SELECT a, b, w.n, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY w.n DESC, b) AS place
  FROM near JOIN words w ON w.word = b),
rows AS MATERIALIZED (
  SELECT w.word, CASE WHEN b.n >= 10 * w.n THEN b.b END AS form, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.n >= 10 * w.n THEN b.n END AS form_n
  FROM words w LEFT JOIN best b ON b.a = w.word AND b.place = 1),
follow(word, reached) AS (
  SELECT word, word FROM rows UNION ALL SELECT f.word, r.form FROM follow f JOIN rows r ON r.word = f.reached WHERE r.form IS NOT NULL),
roots AS (SELECT f.word, f.reached AS root FROM follow f JOIN rows r ON r.word = f.reached WHERE r.form IS NULL)
SELECT r.word, form, root, n, n_near, form_n FROM rows r JOIN roots USING (word)
""",
    "op12_merkle_manifest": f"""
WITH RECURSIVE leaves AS MATERIALIZED (
  SELECT doc_id, lang, {_leaf("n_chars")} AS leaf,
    CASE WHEN {CRC32.format("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_leaf("(n_chars + 1)")} END AS altered
  FROM documents),
rows AS MATERIALIZED (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY lang) AS n,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS nth
  FROM leaves),
up(tree, level, i, n, d) AS (
  SELECT tree, 0, nth, n, leaf FROM rows UNION ALL
  SELECT tree, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY i)) FROM up WHERE n > 1 GROUP BY tree, level, i // 2, n),
subroots AS MATERIALIZED (SELECT tree, level AS height, d AS subroot FROM up WHERE n = 1),
top(level, i, n, d) AS (
  SELECT 0, tree, (SELECT count(*) FROM subroots), subroot FROM subroots UNION ALL
  SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY level, i // 2, n),
whole AS MATERIALIZED (SELECT level AS height, d AS root FROM top WHERE n = 1),
steps AS MATERIALIZED (
  SELECT r.tree, r.nth, l.level AS step, (r.nth >> l.level) & 1 = 1 AS on_left, u.d AS sibling
  FROM rows r JOIN subroots s ON s.tree = r.tree JOIN (SELECT DISTINCT level FROM up) l ON l.level < s.height
  LEFT JOIN up u ON u.tree = r.tree AND u.level = l.level AND u.i = xor(r.nth >> l.level, 1)
  UNION ALL
  SELECT r.tree, r.nth, s.height + l.level, (r.tree >> l.level) & 1 = 1, t.d
  FROM rows r JOIN subroots s ON s.tree = r.tree JOIN (SELECT DISTINCT level FROM top) l ON l.level < (SELECT height FROM whole)
  LEFT JOIN top t ON t.level = l.level AND t.i = xor(r.tree >> l.level, 1)),
proof AS (SELECT tree, nth, sha256(coalesce(string_agg(sibling, '' ORDER BY step), '')) AS proof_sha256, count(sibling) AS n_siblings FROM steps GROUP BY ALL),
folds(tree, nth, step, d) AS (
  SELECT tree, nth, 0, coalesce(altered, leaf) FROM rows UNION ALL
  SELECT f.tree, f.nth, f.step + 1, sha256(CASE WHEN sibling IS NULL THEN d WHEN on_left THEN sibling || d ELSE d || sibling END)
  FROM folds f JOIN steps s ON s.tree = f.tree AND s.nth = f.nth AND s.step = f.step)
SELECT r.doc_id, r.leaf, s.subroot, w.root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, f.d AS folded_root, f.d = w.root AS verified,
  2 * r.nth - bit_count(r.nth) AS log_position, CAST(coalesce(p.n_siblings, 0) AS INTEGER) AS n_siblings
FROM rows r JOIN subroots s ON s.tree = r.tree CROSS JOIN whole w
JOIN folds f ON f.tree = r.tree AND f.nth = r.nth AND f.step = s.height + w.height
LEFT JOIN proof p ON p.tree = r.tree AND p.nth = r.nth
""",
    "op4_segment_topk": r"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS nr, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT q.nr, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.nr <> q.nr AND len(c.v) = len(q.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY nr ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
""",
    "op2_minhash_near_dedup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS items
  FROM w),
x AS MATERIALIZED (SELECT doc_id, unnest(items) AS item FROM s),
shared AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM x a JOIN x b ON a.item = b.item AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN s p ON p.doc_id = a JOIN s q ON q.doc_id = b
  WHERE 100 * n >= 75 * (len(p.items) + len(q.items) - n)),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
low AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.items) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(low.low, s.doc_id)) AS component_id,
  s.doc_id = least(s.doc_id, coalesce(low.low, s.doc_id)) AS kept
FROM s LEFT JOIN low ON low.a = s.doc_id
""",
}
