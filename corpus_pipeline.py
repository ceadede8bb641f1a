"""Training-data pipeline over ``documents``: five stages, each written as Parquet and read again by the next one.

Every stage works on all that the one before it kept. All but the last return the
columns of ``documents``; the last returns where each token piece lies in its sequence.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm.decontamination import drop_leaking
from reviewloom.llm.jaccard_join import keep_representatives
from reviewloom.llm.quality_rules import keep_documents
from reviewloom.llm.sequence_packing import pack_documents
from reviewloom.llm.suffix_dedup import clean_texts
from reviewloom.session import Workspace

TOKENIZER = "byte_bpe_50k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and look more like trusted text than like junk."""
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")
    return keep_documents(docs, trusted)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of every group of near duplicates (five-word shingles, similarity 0.8)."""
    return keep_representatives(docs, words=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings of 200 bytes that occur elsewhere too."""
    return clean_texts(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return drop_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents and their places in sequences of 1024 tokens."""
    import public_tokenizers

    return pack_documents(docs, tokenizer_path=public_tokenizers.path(TOKENIZER), content=F.crc32).withColumnRenamed("content", "ids_crc32")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("token_sequences", token_sequences),
]

#: SQL cannot express the ratio model, the similarity groups and the packing; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    space = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = space.write(stage(spark, docs, sf_dir), name)
        if k:
            space.drop(STAGES[k - 1][0])
    return docs
