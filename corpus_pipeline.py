"""From raw documents to packed sequences: one decision per stage, each written before the next reads it.

Quality scores drop junk, exact and near copies leave one document each, sources are mixed to their weights
by repeating or leaving out whole documents, and what is left is packed along a space-filling curve. Every
stage works on all rows its predecessor kept; all but the last return the columns of ``documents``. Nulls,
empty and repeated rows, empty tables and extra columns are treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm.common import stored, table
from strata.llm.exact_dedup import without_copies
from strata.llm.mixing import mixed_documents
from strata.llm.near_copies import without_similar
from strata.llm.packing import packed, piece_digests
from strata.llm.quality import good_documents
from strata.llm.queries import vocabulary


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return good_documents(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_similar(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_digests(packed(docs, vocabulary("word_bpe_49k.json")))


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mix_sources", mix_stage),
    ("pack", pack_stage),
]

#: Classifier and fingerprints are beyond SQL; tests/llm/test_pipeline.py makes all decisions on plain lists.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
