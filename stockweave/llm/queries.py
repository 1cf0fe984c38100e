"""The operators applied to their whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import use_utc
from . import (
    decontaminate,
    html_blocks,
    language,
    minhash,
    mixing,
    pii,
    prefix_trie,
    quality_cnn,
    ranked_search,
    simhash,
    token_counts,
    toxicity,
    vector_files,
)
from .common import read_table as read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(use_utc(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_html_extraction")
def op1(spark, sf_dir):
    return html_blocks.main_text(read(spark, sf_dir, "pages"))


@query("op2_pii")
def op2(spark, sf_dir):
    return pii.personal_data(read(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct([array_to_string(ws[i : i + 4], ' ') for i in range(1, len(ws) - 3)]) END AS sh FROM w),
n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles FROM s),
e AS MATERIALIZED (SELECT doc_id, unnest(sh) AS x FROM s),
i AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS MATERIALIZED (
  SELECT u, v FROM i JOIN n p ON p.doc_id = u JOIN n q ON q.doc_id = v
  WHERE 100 * c >= 85 * (p.n_shingles + q.n_shingles - c)),
b AS MATERIALIZED (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
r AS (SELECT doc_id AS a, doc_id AS z FROM n UNION SELECT r.a, b.v FROM r JOIN b ON b.u = r.z WHERE r.a > 0 OR r.a <= 0),
m AS (SELECT a AS doc_id, min(z) AS component_id FROM r GROUP BY a)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN m USING (doc_id)
"""


@query("op3_minhash_near_dedup", OP3_SQL)
def op3(spark, sf_dir):
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


@query("op4_source_mixing", mixing.mixture_sql())
def op4(spark, sf_dir):
    return mixing.mixture(read(spark, sf_dir, "documents"))


@query("op5_language_id")
def op5(spark, sf_dir):
    documents = read(spark, sf_dir, "documents")
    return language.identify_with_pages(documents, read(spark, sf_dir, "pages"), language.fit(documents))


@query("page_language_id")
def page_language(spark, sf_dir):
    model = language.fit(read(spark, sf_dir, "documents"))
    found = language.identify_pages(read(spark, sf_dir, "pages"), model)
    return found.select("page_id", "url", "predicted_lang", F.round("confidence", 6).alias("confidence"), "accepted")


OP6_SQL = r"""
WITH v AS MATERIALIZED (
  SELECT vec_id, CAST(list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS DOUBLE[]) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op6_exact_top_k", OP6_SQL)
def op6(spark, sf_dir):
    return vector_files.top_k(read(spark, sf_dir, "embeddings"), lambda c: c % 50 == 0)


@query("op7_quality")
def op7(spark, sf_dir):
    return quality_cnn.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op8_token_counts")
def op8(spark, sf_dir):
    return token_counts.token_counts(read(spark, sf_dir, "documents"))


@query("op9_toxicity")
def op9(spark, sf_dir):
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op10_decontamination")
def op10(spark, sf_dir):
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op11_simhash_near_dedup", simhash.near_duplicates_sql())
def op11(spark, sf_dir):
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


@query("op12_prefix_trie", prefix_trie.family_trie_sql())
def op12(spark, sf_dir):
    return prefix_trie.family_trie(read(spark, sf_dir, "conversations"))


@query("op13_ranked_search", ranked_search.RANKED_SQL)
def op13(spark, sf_dir):
    return ranked_search.ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
