"""Inserts that enforce a key.

A keyed table holds at most one row per key and day, and no NULL in a key.  :func:`insert_keyed` takes a
batch of rows, adds those it may, and appends the others to ``<name>_rejects`` with a reason:

``null key``      a key column is NULL
``stored key``    the day already holds the key
``repeated key``  the batch holds the key more than once; the row that is least by its other columns goes in

Rejected rows that are equal are one row with their number ``n``, so a key that a third of the batch
repeats is aggregated before it is shuffled, and no task gathers its rows.  The stored day is read for
the batch's keys only: Spark builds a Bloom filter of them at run time and drops the other stored rows
in the scan's stage, before the shuffle (:func:`stored_hits`).
"""

from __future__ import annotations

import contextlib
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .snapshots import read_snapshot

RUNTIME_FILTER = {
    # the filter pays whenever the batch is smaller than the day, so no least size of the stored side
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    # a batch small enough to broadcast is filtered by too: the stored day never moves for it
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@contextlib.contextmanager
def runtime_filter(spark: SparkSession):
    """Settings for a join whose left side a Bloom filter of the right one may cut down, while it is planned."""
    old = {k: spark.conf.get(k) for k in RUNTIME_FILTER}
    for k, v in RUNTIME_FILTER.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def stored_hits(stored: DataFrame, batch_keys: DataFrame, keys: list[str]) -> DataFrame:
    """The keys of ``batch_keys`` (stored, distinct) that ``stored`` holds; plan it inside :func:`runtime_filter`."""
    # a predicate that always holds: Spark takes a filter's source only from a scan with a condition
    wanted = batch_keys.where(F.length(F.col(keys[0]).cast("string")) >= 0)
    return stored.select(*keys).hint("merge").join(wanted, keys, "left_semi").distinct()


def _all(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, columns)


def insert_keyed(df: DataFrame, root: str, name: str, ds: str, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Insert a batch into the day ``ds`` of ``name``; returns the (accepted, rejected) rows, both stored.

    Equal rows of a batch are told apart by nothing, so of those one goes in.
    """
    spark, cols = df.sparkSession, df.columns
    rest = [c for c in cols if c not in keys]
    path = f"{root.rstrip('/')}/{name}"
    counted = materialize(df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")), "keyed-batch")
    whole = _all([F.col(k).isNotNull() for k in keys])
    usable = counted.where(whole)
    # the key's least row; a struct of the other columns orders rows, and a flag keeps it from being empty
    row = F.struct(F.lit(0).alias("_"), *rest)
    first = materialize(usable.groupBy(*keys).agg(F.min(row).alias("_first")), "keyed-first")
    stored = read_snapshot(spark, root, name, ds, df.schema)
    with runtime_filter(spark):
        hits = materialize(stored_hits(stored, first.select(*keys), keys), "keyed-hits")
    judged = (usable.withColumn("_row", row).join(first, keys).join(hits.withColumn("_hit", F.lit(True)), keys, "left")
              .withColumn("_goes_in", F.col("_hit").isNull() & F.col("_row").eqNullSafe(F.col("_first"))))
    judged = materialize(judged.select(*cols, "_n", "_hit", "_goes_in"), "keyed-judged")
    accepted = judged.where("_goes_in").select(*cols)
    n = F.col("_n") - F.when(F.col("_goes_in"), 1).otherwise(0)
    reason = F.when(F.col("_hit"), "stored key").otherwise("repeated key")
    rejected = (judged.withColumn("n", n).where("n > 0").select(*cols, reason.alias("reason"), "n")
                .unionByName(counted.where(~whole).select(*cols, F.lit("null key").alias("reason"), F.col("_n").alias("n"))))
    rejected = materialize(rejected, "keyed-rejected")
    for out, where in ((accepted, path), (rejected, f"{path}_rejects")):
        out.withColumn("ds", F.lit(ds)).write.mode("append").partitionBy("ds").parquet(where)
    return accepted, rejected
