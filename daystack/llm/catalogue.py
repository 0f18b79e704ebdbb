"""Queries of this package: name -> callable, and name -> DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daystack.llm.common import load
from daystack.llm import language_id, language_model, quality, toxicity
from daystack.llm.exact_dedup import exact_dedup
from daystack.llm.fingerprint import fingerprint_edits
from daystack.llm.jaccard_join import jaccard_components
from daystack.llm.mixing import mix
from daystack.llm.packing import pack
from daystack.llm.pii import personal_data_digest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_path() -> str:
    """The vocabulary of the fixed results; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(load(spark, sf_dir, "documents"), tokenizer_path())


QUERIES["op1_best_fit_packing"] = op1_best_fit_packing


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(load(spark, sf_dir, "documents"))


QUERIES["op4_exact_dedup"] = op4_exact_dedup
ORACLES["op4_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(load(spark, sf_dir, "documents"))


QUERIES["op5_source_mixing"] = op5_source_mixing


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(load(spark, sf_dir, "documents"))


QUERIES["op9_ngram_jaccard_join"] = op9_ngram_jaccard_join
ORACLES["op9_ngram_jaccard_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')))
                             WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * i >= 75 * (p.n + q.n - i)
), both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x
), least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN least ON least.x = d.doc_id
"""


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.train(docs, ~language_id.held_out()))


QUERIES["op7_language_id"] = op7_language_id


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data_digest(load(spark, sf_dir, "documents"))


QUERIES["op8_pii"] = op8_pii


def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(load(spark, sf_dir, "documents"))


QUERIES["op10_fingerprint"] = op10_fingerprint


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(load(spark, sf_dir, "documents"))


QUERIES["op6_lm_scoring"] = op6_lm_scoring


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, load(spark, sf_dir, "labels")))


QUERIES["op2_toxicity"] = op2_toxicity


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites are sources, and their sections are languages, as the table has no addresses."""
    docs = load(spark, sf_dir, "documents")
    model = quality.train(docs, load(spark, sf_dir, "labels"))
    sited = docs.select("doc_id", "text", F.col("source").alias("host"), F.col("lang").alias("path"))
    return quality.classify(sited, model)


QUERIES["op3_quality"] = op3_quality
