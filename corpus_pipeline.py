"""The training-data pipeline: documents to mixed, decontaminated token files.

Part of the llm subpackage. Every stage takes (spark, docs, sf_dir) and returns a DataFrame;
``run`` writes each stage's rows to the shared scratch folder and reads them again.

Stages: toxic documents go; of each group linked by Jaccard one document stays, the one with
the smallest id (then text); documents with benchmark passages go; sources are mixed to
their target weights, a document shown more than once becoming several rows; the rest is
coded as token files and read back, one row per document.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallycast.llm import decontaminate, jaccard, mixing, rans, toxicity  # noqa: E402
from tallycast.llm.common import read_table  # noqa: E402
from tallycast.llm.queries import tokenizer_path  # noqa: E402
from tallycast.session import arrow_rows, scratch_path  # noqa: E402

BATCH_ROWS = 2_000  # of whole texts, handed to a Python worker at a time
CACHE_PIECES = 100_000  # of the tokenizer: the executors' memory holds what earlier stages made them take


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under the threshold; the model is fitted on every labelled row of ``docs``."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.keep_clean(docs, model)


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of the Jaccard join, the document with the smallest id, then text; texts without words all stay.

    Words come in fives and 80 percent link, unlike in the query op4_jaccard_components.
    """
    return jaccard.keep_first(docs, jaccard.components(docs, size=5, percent=80))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rans.encode_documents(docs, tokenizer_path(), CACHE_PIECES)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", one_per_group),
    ("benchmark_decontamination", drop_leaks),
    ("mix_sources", mix_sources),
    ("token_output", token_files),
]

# The stages train a model and code tokens, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    with arrow_rows(spark, BATCH_ROWS):
        for name, stage in STAGES:
            rows = stage(spark, docs, sf_dir)
            path = scratch_path(spark, f"pipeline-{name}")
            rows.write.parquet(path)
            docs = spark.read.schema(rows.schema).parquet(path)
    return docs
