"""Documents to packed training sequences in five stages, each written as Parquet and read again by the next."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orestrata.llm.common import table
from orestrata.llm.exact_dedup import without_copies
from orestrata.llm.mixing import mixed_documents
from orestrata.llm.ngram_join import one_of_each
from orestrata.llm.packing import pack_documents
from orestrata.llm.quality import good_documents
from orestrata.session import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return good_documents(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    return without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the one with the smallest doc_id stays."""
    return one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as its source's target asks for, in training order."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2048 tokens."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL can express neither the classifier nor the tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(spark, stage(spark, docs, sf_dir), f"after-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
