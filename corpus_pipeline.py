"""A corpus pipeline over ``documents``: languages, exact copies, near copies, mixture, sequences.

Each stage takes what its predecessor kept, as a table; all but the last return the columns of
``documents``.  ``STAGES`` lists them for a runner that writes every stage's rows as Parquet and reads
them again; ``run`` does the same in the session's shared folder.
"""

from __future__ import annotations

import os
import sys
import uuid

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from daystack.llm.catalogue import tokenizer_path  # noqa: E402
from daystack.llm.common import load, shared_folder  # noqa: E402
from daystack.llm.exact_dedup import keep_one  # noqa: E402
from daystack.llm.jaccard_join import keep_one_similar  # noqa: E402
from daystack.llm.language_id import with_known_language  # noqa: E402
from daystack.llm.mixing import mixed  # noqa: E402
from daystack.llm.packing import pack  # noqa: E402
from daystack.session import share  # noqa: E402


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without letters, or with no language that prevails, go."""
    share(spark)
    return with_known_language(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the largest doc_id."""
    share(spark)
    return keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of similar texts join, the one with the smallest doc_id."""
    share(spark)
    return keep_one_similar(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    share(spark)
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences."""
    share(spark)
    return pack(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("source_mixing", source_mixing),
    ("packing", packing),
]

#: Language identification, mixing and packing are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each one's rows kept in the shared folder before the next reads them."""
    docs = load(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
