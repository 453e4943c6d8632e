"""Joins and aggregations for skewed keys.

All salts are deterministic functions of the row (``xxhash64`` of given
columns), never ``rand()``: a retried task recomputes the same salt, so a
lost executor cannot duplicate or drop rows.  Every operator returns exactly
the rows of the plain join/aggregate it replaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import BROADCAST_MAX_ROWS, checked_broadcast, fits_broadcast

SALT = "_salt"


def salt(columns: list[str], buckets: int) -> Column:
    """A salt in ``[0, buckets)`` derived from the row's own columns."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.lit(buckets))


def replicate(df: DataFrame, buckets: int, name: str = SALT) -> DataFrame:
    """``buckets`` copies of every row, tagged 0..buckets-1 (one generator, no union loop)."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)).cast("array<bigint>")))


def hot_keys(df: DataFrame, key: str, min_count: int | None = None,
             min_share: float | None = None) -> DataFrame:
    """Keys whose row count reaches ``min_count`` or ``min_share`` of all rows.

    With ``min_share`` the result has at most ``1/min_share`` rows — a bound
    that makes it safe to broadcast.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    if min_share is not None:
        total = df.count()
        return counts.where(F.col("n") >= F.lit(min_share * total))
    return counts.where(F.col("n") >= F.lit(min_count if min_count is not None else 2))


def filter_null_keys_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                          preserve: bool = True) -> DataFrame:
    """NULL/'' keys never match, so keep them out of the shuffle.

    ``preserve=False`` is the reference's form (those rows are dropped);
    ``preserve=True`` unions them back with NULL right columns, which equals
    the plain left join.
    """
    usable = F.col(left_key).isNotNull() & (F.col(left_key).cast("string") != "")
    joined = left.where(usable).join(right, left[left_key] == right[right_key], "left")
    if not preserve:
        return joined
    nulls = left.where(~usable)
    for f in right.schema.fields:
        nulls = nulls.withColumn(f.name, F.lit(None).cast(f.dataType))
    return joined.unionByName(nulls)


def broadcast_join(big: DataFrame, small: DataFrame, on, how: str = "left") -> DataFrame:
    """Broadcast the small side after a size check (else a shuffle join)."""
    return big.join(checked_broadcast(small), on, how)


def two_phase_count(df: DataFrame, key: str, salt_columns: list[str], buckets: int = 10) -> DataFrame:
    """Count per (key, salt), then per key — same result as a plain count.

    Spark already combines counts map-side; the explicit salt also spreads a
    hot key over ``buckets`` reducers in the first phase.
    """
    first = (df.withColumn(SALT, salt(salt_columns, buckets))
             .groupBy(key, SALT).agg(F.count(F.lit(1)).alias("n")))
    return first.groupBy(key).agg(F.sum("n").alias("n"))


def isolate_hot_keys_join(left: DataFrame, right: DataFrame, key: str, hot: DataFrame,
                          salt_columns: list[str], buckets: int = 10, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """A left join in which only hot keys are salted.

    ``hot`` must be small and stored (:func:`hot_keys` by share).  Hot left rows get a salt, hot
    right rows a copy per salt, all others salt 0; one shuffle join on (key, salt) then serves
    both.  A right side that passes the broadcast check is broadcast as it is instead.
    """
    if fits_broadcast(right, max_rows):
        return left.join(F.broadcast(right), key, "left")
    flags = checked_broadcast(hot.select(key).distinct().withColumn("_hot", F.lit(True)))
    is_hot = F.col("_hot").isNotNull()
    salted = (left.join(flags, key, "left")
              .withColumn(SALT, F.when(is_hot, salt(salt_columns, buckets)).otherwise(F.lit(0).cast("bigint"))).drop("_hot"))
    copies = F.when(is_hot, F.lit(buckets - 1)).otherwise(F.lit(0))
    spread = (right.join(flags, key, "left")
              .withColumn(SALT, F.explode(F.sequence(F.lit(0), copies).cast("array<bigint>"))).drop("_hot"))
    return salted.join(spread.hint("merge"), [key, SALT], "left").drop(SALT)


def expand_join(left: DataFrame, right: DataFrame, key: str, salt_columns: list[str],
                buckets: int = 10, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Salt every left row, replicate the right side ``buckets`` times, left join.

    A right side that passes the broadcast check is broadcast as it is: a broadcast join
    shuffles nothing, so there is no hot partition to salt.
    """
    if fits_broadcast(right, max_rows):
        return left.join(F.broadcast(right), key, "left")
    return (left.withColumn(SALT, salt(salt_columns, buckets))
            .join(replicate(right, buckets).hint("merge"), [key, SALT], "left").drop(SALT))


def rows_per_partition(df: DataFrame) -> DataFrame:
    """A14 (diagnostic): rows in each partition."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("n"))
