"""Stored layouts that later reads profit from: bucketed tables (S6) and sorted files.

*Bucketed tables.*  Rows are dealt to a fixed number of buckets by key when they are written, so a join
of two tables with the same buckets reads them side by side: the shuffle is paid once, not per join.
A join without a shuffle cannot be split at run time either, so hot keys get a salt that is part of the
bucket key (:func:`salted_pair`): the large side's rows are spread over the salts, the small side's row is
stored once per salt.

*Sorted files.*  Rows are range-partitioned and sorted by key and written in small row groups with a
Bloom filter per group.  A point lookup then reads the one group whose range and filter admit the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import SALT, hot_keys, salt
from ..session import materialize

ROW_GROUP_BYTES = 1 << 20
HOT_SHARE = 0.01  # of the rows: such a key is salted


# ---------------------------------------------------------------- bucketed tables


def write_bucketed(df: DataFrame, table: str, path: str, keys: list[str], buckets: int) -> str:
    """``df`` as the table ``table`` at ``path``, bucketed and sorted by ``keys``, one file a bucket."""
    (df.repartition(buckets, *keys).write.format("parquet").mode("overwrite").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return table


def salted_pair(large: DataFrame, small: DataFrame, key: str, salt_columns: list[str], salts: int = 16,
                share: float = HOT_SHARE) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt: 0, or for a key with ``share`` of the large side one of ``salts``.

    ``small`` has one row per key.  The join on (key, salt) equals the join on the key.
    """
    hot = materialize(hot_keys(large.where(F.col(key).isNotNull()), key, min_share=share).select(key, F.lit(True).alias("_hot")), "hot-keys")
    flags = F.broadcast(hot)  # at most 1 / share rows
    one, many = F.lit(0).cast("bigint"), salt(salt_columns, salts)
    left = large.join(flags, key, "left").withColumn(SALT, F.when(F.col("_hot"), many).otherwise(one)).drop("_hot")
    last = F.when(F.col("_hot"), F.lit(salts - 1)).otherwise(F.lit(0))
    right = (small.join(flags, key, "left")
             .withColumn(SALT, F.explode(F.sequence(F.lit(0), last).cast("array<bigint>"))).drop("_hot"))
    return left, right


def bucketed_join(spark: SparkSession, left: str, right: str, key: str, how: str = "left") -> DataFrame:
    """The join of two tables bucketed by (key, salt); without an exchange, so the hint keeps it a merge join."""
    return spark.table(left).join(spark.table(right).hint("merge"), [key, SALT], how).drop(SALT)


# ---------------------------------------------------------------- sorted files


def write_sorted(df: DataFrame, path: str, key: str, group_bytes: int = ROW_GROUP_BYTES, distinct_per_group: int = 100_000) -> str:
    """``df`` sorted by ``key`` over all files, in row groups of about ``group_bytes`` with Bloom filters."""
    (df.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite")
     .option("parquet.block.size", group_bytes)
     .option("parquet.page.row.count.limit", 1000).option("parquet.block.size.row.check.min", 100)
     .option("parquet.page.size.row.check.min", 100)
     .option(f"parquet.bloom.filter.enabled#{key}", "true")
     .option(f"parquet.bloom.filter.expected.ndv#{key}", distinct_per_group).parquet(path))
    return path


def point_lookup(spark: SparkSession, path: str, key: str, value: Column | str | int) -> DataFrame:
    """The rows of one key: the predicate reaches the files' ranges and filters."""
    return spark.read.parquet(path).where(F.col(key) == value)
