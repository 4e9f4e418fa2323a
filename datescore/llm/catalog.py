"""The registered queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from datescore.llm import (
    bpe,
    centroids,
    decontaminate,
    exact_dedup,
    fingerprints,
    html_text,
    lm_score,
    ngram_join,
    packing,
    pii,
    sharding,
    token_links,
    toxicity,
)
from datescore.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 shards under the law ``rows``: with no slack the ring's bounded loads differ by one at most."""
    placed = sharding.shard_documents(read_table(spark, sf_dir, "documents"), shards=24)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "moved",
    )


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.extract(read_table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_and_decode(read_table(spark, sf_dir, "documents"))


def op4_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(read_table(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(read_table(spark, sf_dir, "pages"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).withColumnRenamed("rejected", "toxic")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = ngram_join.near_classes(read_table(spark, sf_dir, "documents"), n=3, num=90, den=100)
    return classes.select("doc_id", "n_shingles", "component_id")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edits(spark, read_table(spark, sf_dir, "documents"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_report(read_table(spark, sf_dir, "embeddings"))


def op12_token_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_links.link_scores(read_table(spark, sf_dir, "documents"))


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlap_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_sharding": op1_sharding,
    "op2_pii": op2_pii,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_ppm": op4_ppm,
    "op5_html_text": op5_html_text,
    "op6_toxicity": op6_toxicity,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_packing": op8_packing,
    "op9_ngram_join": op9_ngram_join,
    "op10_fingerprints": op10_fingerprints,
    "op11_centroids": op11_centroids,
    "op12_token_links": op12_token_links,
    "op13_decontaminate": op13_decontaminate,
}

SQL: dict[str, str] = {
    "op7_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents),
r AS (
  SELECT doc_id, h, count(*) OVER (PARTITION BY h) AS group_size,
         first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS rn
  FROM d
  WINDOW w AS (PARTITION BY h ORDER BY length(t) DESC, doc_id))
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, h AS text_sha256 FROM r
""",
    "op9_ngram_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
e AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * k >= 90 * (na.n + nb.n - k)),
l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (
  SELECT doc_id, doc_id AS c FROM documents
  UNION
  SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.c) AS component_id
FROM documents d JOIN r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id
""",
    "op11_centroids": centroids.report_sql(),
    "op13_decontaminate": decontaminate.REPORT_SQL,
}
