"""A corpus pipeline: filter, de-duplicate, decontaminate, protect and pack documents.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet into the shared folder and reads again as the next stage's
documents.  All but the last return the columns of documents.

Defined cases: each operator's own (see its module); rows with a null id or
text go through all stages like others, and other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagloom.llm.common import staged, table
from tagloom.llm.decontam import decontaminate
from tagloom.llm.ngram_join import keep_one
from tagloom.llm.packing import pack_documents
from tagloom.llm.quality import keep_quality
from tagloom.llm.surrogates import replace_entities


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of the n-gram Jaccard join."""
    return keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of benchmark items."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose entities have surrogates."""
    return replace_entities(docs).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences."""
    return pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("personal_data", personal_data),
    ("packing", packing),
]

# Two stages rest on trained scores, hashing and a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, f"pipeline-{name}")
    return docs
