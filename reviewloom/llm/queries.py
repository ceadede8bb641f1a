"""Registered queries of the training-data operators and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from reviewloom.llm import hard_negatives, source_divergence

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@_register
def op1_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    from reviewloom.llm.jaccard_join import link_documents

    return link_documents(_table(spark, sf, "documents"), words=3, percent=90)


@_register
def op2_licence_scan(spark: SparkSession, sf: str) -> DataFrame:
    from reviewloom.llm.licence_scan import scan_licences

    return scan_licences(_table(spark, sf, "documents"))


@_register
def op3_toxicity_chain(spark: SparkSession, sf: str) -> DataFrame:
    from reviewloom.llm.toxicity import score_toxicity

    return score_toxicity(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


@_register
def op4_sequence_packing(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    from reviewloom.llm.sequence_packing import pack_documents

    packed = pack_documents(_table(spark, sf, "documents"), tokenizer_path=public_tokenizers.path("byte_bpe_50k.json"), content=F.crc32)
    return packed.withColumnRenamed("content", "ids_crc32")


@_register
def op5_warc_archive(spark: SparkSession, sf: str) -> DataFrame:
    from reviewloom.llm.warc_files import archive_folder, read_archive, write_archive

    folder = archive_folder(spark)
    # small shards, so that a table of a few hundred MB is written by many tasks
    manifest = write_archive(_table(spark, sf, "pages"), folder, shard_bytes=8 << 20, file_bytes=1 << 20)
    return read_archive(manifest, folder).select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@_register
def op6_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    from reviewloom.llm.quality_classifier import score_quality

    return score_quality(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


@_register
def op7_context_tree_scoring(spark: SparkSession, sf: str) -> DataFrame:
    from reviewloom.llm.lm_scoring import score_documents

    return score_documents(_table(spark, sf, "documents"))


@_register
def op8_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    from reviewloom.llm.decontamination import find_leaks

    return find_leaks(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


@_register
def op9_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    from reviewloom.llm.quality_rules import judge_documents

    trusted = _table(spark, sf, "labels").where("quality = 1").select("doc_id")
    return judge_documents(_table(spark, sf, "documents"), trusted).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio_score")


@_register
def op10_suffix_array_dedup(spark: SparkSession, sf: str) -> DataFrame:
    from reviewloom.llm.suffix_dedup import removal

    return removal(_table(spark, sf, "documents")).drop("spans")


@_register
def op11_language_profiles(spark: SparkSession, sf: str) -> DataFrame:
    from reviewloom.llm.language_id import identify_languages

    docs = _table(spark, sf, "documents")
    return identify_languages(docs, F.crc32(docs["doc_id"].cast("string").cast("binary")) % 5 == 0)


@_register
def op12_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    rows = _table(spark, sf, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.withColumn("label", shifted)
    return hard_negatives.mine_hard_negatives(rows, rows["vec_id"] % 100 == 0)


@_register
def op13_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return source_divergence.audit_sources(_table(spark, sf, "documents"))


ORACLES["op12_hard_negatives"] = hard_negatives.CHECK_SQL
ORACLES["op13_source_divergence"] = source_divergence.CHECK_SQL


@_register
def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf)


if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
