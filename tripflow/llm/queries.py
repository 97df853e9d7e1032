"""Registered queries of the subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import (
    bagminhash,
    collocations,
    conversations,
    edits,
    extraction,
    language,
    mixing,
    neighbours,
    packing,
    quality,
    repeats,
    sharding,
    urls,
)
from tripflow.llm.common import text_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable, sql: str | None = None) -> Callable:
    QUERIES[fn.__name__] = fn
    if sql:
        ORACLES[fn.__name__] = sql.strip()
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op9_language_naive_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_held_out(table(spark, sf_dir, "documents"))


@query
def op10_quality_factorization_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_held_out(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_bagminhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = bagminhash.near_classes(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "class_id", "class_size", "kept")


@query
def op7_subset_sum_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents"))


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op1_histogram_sort_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.histogram_shards(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.select(
        "doc_id", "size", F.crc32(text_of().cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op6_site_template_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = extraction.main_texts(table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


@query
def op4_url_boosted_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"))


@query
def op3_adaptive_dimension_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.search(vectors, vectors.where("vec_id % 20 = 0"))


@query
def op8_edit_embedding_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edits.fingerprint_rows(table(spark, sf_dir, "documents"))


@query
def op13_seed_extend_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repeats.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.drop("text", "repeats")


COLLOCATIONS_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
numbered AS (SELECT lang, row_number() OVER () AS id, regexp_split_to_array(piece, '[ \t]+') AS words FROM pieces),
words AS (SELECT lang, id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM numbered),
runs AS (
  SELECT lang, w AS w1, lead(w) OVER piece AS w2, lead(w, 2) OVER piece AS w3 FROM words WHERE w <> ''
  WINDOW piece AS (PARTITION BY id ORDER BY i)),
grams AS (
  SELECT lang, 1 AS size, w1 AS phrase FROM runs
  UNION ALL SELECT lang, 2, concat(w1, ' ', w2) FROM runs WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, concat(w1, ' ', w2, ' ', w3) FROM runs WHERE w3 IS NOT NULL),
f AS (SELECT lang, size, phrase, count(*) AS times FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(times) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, phrase, times AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND times >= 10),
cuts AS (
  SELECT c.lang, c.phrase, a, k, x.times AS l, y.times AS r,
    CAST(1000000::HUGEINT * a * a // (x.times::HUGEINT * y.times) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ')),
lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (
  SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS longer
  FROM candidates, (VALUES (1), (2)) AS s(i) WHERE size = 3 GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM lowest JOIN totals USING (lang) LEFT JOIN inner_phrases USING (lang, phrase)
WHERE longer IS NULL OR 100 * longer < 50 * a
QUALIFY rank <= 2000
"""


def op11_external_stream_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


query(op11_external_stream_collocations, COLLOCATIONS_SQL)


@query
def op12_weighted_cyk_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired(table(spark, sf_dir, "conversations"))
