"""The queries of the corpus operators: each applies its operator to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, html_text, huffman, language, mixing, mtree, pivots, quality, simhash, toxicity
from .common import new_path, table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-files")
    huffman.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return huffman.read(spark, path, digest=True)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return mtree.top_k(vectors, vectors.where("vec_id % 20 = 0"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.classify(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_mixing, op2_embedding_dedup, op3_simhash, op4_html, op5_token_files, op6_byte_bpe, op7_top_k, op8_quality, op9_language, op10_toxicity)
    return {f.__name__: f for f in own}


#: Earliest deadline first, block by block; exact weights as whole units of a sum of about 2^44.
_OP1 = """
WITH RECURSIVE s AS (SELECT coalesce(source, '') AS source, count(*) AS n FROM documents GROUP BY 1),
z AS (SELECT CAST(greatest(64, (sum(n) + 65535) // 65536) AS BIGINT) AS size FROM s),
l AS (SELECT list(source ORDER BY source) AS names, list(sqrt(n) ORDER BY source) AS ws, list(CAST((n + size - 1) // size AS BIGINT) ORDER BY source) AS nb FROM s, z),
u AS (SELECT *, list_transform(ws, lambda x: greatest(1, CAST(round(x * 17592186044416 / list_sum(ws)) AS BIGINT))) AS us FROM l),
a AS (SELECT *, CAST(list_sum(us) AS BIGINT) AS p, CAST(list_sum(nb) AS BIGINT) AS total FROM u),
edf AS (
  SELECT CAST(0 AS BIGINT) AS step, CAST(-1 AS BIGINT) AS t, list_transform(us, lambda x: CAST(0 AS BIGINT)) AS nx, CAST(0 AS BIGINT) AS pick FROM a
  UNION ALL
  SELECT step + 1, now, list_transform(nx, lambda x, i: CASE WHEN i = best THEN x + 1 ELSE x END), best FROM (
    SELECT step, now, nx, list_sort(list_filter(list_transform(us, lambda x, i: CASE WHEN nx[i] < nb[i] AND (nx[i] * p) // x <= now
      THEN {'d': least(((nx[i] + 1) * p + x - 1) // x, 4398046511104), 'i': CAST(i AS BIGINT)} END), lambda c: c IS NOT NULL))[1].i AS best
    FROM (SELECT step, nx, us, nb, p, greatest(t + 1, list_min(list_transform(us, lambda x, i: CASE WHEN nx[i] < nb[i] THEN (nx[i] * p) // x END))) AS now
      FROM edf, a WHERE step < total) due) picked),
cycle AS (SELECT names[pick] AS source, us[pick] AS units, p, t AS slot, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS k FROM edf, a WHERE pick > 0),
d AS (SELECT doc_id, coalesce(source, '') AS source, row_number() OVER (PARTITION BY coalesce(source, '') ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1 AS i FROM documents)
SELECT d.doc_id, d.source, d.i // size AS block, d.i % size AS place, (k * p) // units AS release, ((k + 1) * p + units - 1) // units AS deadline, slot
FROM d, z JOIN cycle c ON c.source = d.source AND c.k = d.i // z.size
"""

#: The distance of whole integer vectors from each query, ranked.
_OP7 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s) WHERE r <= 20
"""

#: All pairs by cosine, and the smallest id that links reach.
_OP2 = """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id, vec_id AS c FROM embeddings UNION SELECT r.vec_id, l.y FROM r JOIN l ON r.c = l.x)
SELECT e.vec_id, CAST((SELECT count(*) FROM l WHERE l.x = e.vec_id) AS BIGINT) AS n_links, m.c AS component_id, e.vec_id = m.c AS kept
FROM embeddings e JOIN (SELECT vec_id, min(c) AS c FROM r GROUP BY 1) m ON m.vec_id = e.vec_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": _OP1, "op2_embedding_dedup": _OP2, "op7_top_k": _OP7}
