"""Helpers the training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
# Fixed value: the same white space, as bytes.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text; empty for NULL."""
    return F.coalesce(F.col(column), F.lit(""))


def crc_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; NULL ids count as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus
