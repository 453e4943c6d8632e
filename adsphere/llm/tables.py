"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the input folder, read by Spark (any file system it knows)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    """The text, with NULL as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


#: A word is a maximal run of characters other than space, \t, \n, \x0B, \f and \r.
WORD_BREAK = r"[\x20\x09-\x0D]+"


def words(column: Column) -> Column:
    """The words of a text in order; no words for an empty or NULL text."""
    return F.filter(F.split(F.coalesce(column, F.lit("")), WORD_BREAK), lambda w: w != "")
