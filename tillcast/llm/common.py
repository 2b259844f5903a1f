"""Shared helpers of the corpus operators: table reading, row packing, intermediate tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.session import written

__all__ = ["FOLDS", "HELD_OUT", "WORD_SPACE", "WORD_SPACE_RE", "held_out", "packed", "read_table", "word_array", "word_count", "written"]

#: White space that separates words: space and U+0009..U+000D.
WORD_SPACE = " \t\n\x0b\x0c\r"
WORD_SPACE_RE = r"[\x20\x09-\x0D]+"

#: Learning fold: rows whose crc32(doc_id as text) modulo FOLDS is not HELD_OUT.
FOLDS, HELD_OUT = 4, 2


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the rows a model may not learn from; a null id counts as the text ``null``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % FOLDS == HELD_OUT


def packed(df: DataFrame) -> DataFrame:
    """All columns in one struct ``row``, so that working columns cannot clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def word_array(text: Column) -> Column:
    """Words of a text (maximal runs without ``WORD_SPACE``); empty for null or blank texts."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WORD_SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_SPACE_RE))


def word_count(text: Column) -> Column:
    return F.size(word_array(text)).cast("long")
