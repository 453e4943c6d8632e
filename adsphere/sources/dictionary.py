"""Text dictionaries: one ``key##value`` entry per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEPARATOR = "##"


def read_kv_dictionary(spark: SparkSession, path: str, key: str = "key",
                       value: str = "value") -> DataFrame:
    """(key, value) from a text file; when a key repeats, the later line wins.

    Read with ``spark.read.text`` (distributed, no driver ``collect``).  "Later" goes by file
    path, then by the block of the file that Spark reads, then by the order inside it.
    Lines without the separator are skipped.  The result is meant for a
    size-checked broadcast join, not a driver-side map.
    """
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("line"))
    lines = spark.read.text(path).select("value", place.alias("_place"))
    parts = F.split(F.col("value"), SEPARATOR)
    kv = (lines.where(F.col("value").contains(SEPARATOR))
          .select(parts.getItem(0).alias(key), parts.getItem(1).alias(value), "_place"))
    return kv.groupBy(key).agg(
        F.max_by(F.col(value), F.col("_place")).alias(value))
