"""From raw documents to packed training sequences: five stages, each one operator over all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillcast.llm import linedup, mixing, packing, quality_pu, simhash
from tillcast.llm.common import read_table, written
from tillcast.llm.queries import small_batches, tokenizer_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    small_batches(spark)
    return quality_pu.keep_good(docs, read_table(spark, sf_dir, "labels"))


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that came before, in them or elsewhere."""
    return linedup.dedupe(docs)


def unique_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    small_batches(spark)
    return simhash.dedupe(docs, shingle=3, max_distance=2)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their token ids, placed in sequences of 4096 tokens."""
    small_batches(spark)
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), 4096)


STAGES = [
    ("quality", good_quality),
    ("line_dedup", unique_lines),
    ("near_dedup", unique_documents),
    ("mix", mixed_sources),
    ("pack", packed_sequences),
]

#: The classifier's training and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in a row over ``documents``; each result is written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
