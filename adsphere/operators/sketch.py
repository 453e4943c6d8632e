"""Heavy hitters from sketches that are stored per day.

:func:`day_sketches` reads a day's facts once and keeps a frequent-items sketch of its keys, a few
thousand counters however many rows the day has.  Sketches of any days merge, so hot keys of a month are
asked of stored sketches, and only the few candidates are counted in the facts, in one aggregation whose
shuffle carries a row per candidate and task.  The result is exact: a key with at least ``share`` of all
rows is always a candidate, because a sketch is made large enough (:func:`counters`).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_COUNTERS = 1_000_000


def counters(share: float) -> int:
    """Counters of a sketch that reports every key with this share of the rows.

    A sketch of ``m`` counters has a table of at least ``m / 0.75`` places and errs by at most
    ``3.5 / places`` of all rows, in either direction; it reports the keys whose lower bound is above
    that error.  With ``8 / share`` counters the error is a third of the share.
    """
    m = math.ceil(8 / share)
    if not 0 < share <= 1 or m > MAX_COUNTERS:
        raise ValueError(f"no sketch finds keys with a share of {share} of all rows")
    return m


def day_sketches(facts: DataFrame, key: str, day: str, share: float) -> DataFrame:
    """(day, sketch, n): a frequent-items sketch of the keys and the rows of each day."""
    return facts.groupBy(F.col(day).alias("day")).agg(
        F.expr(f"approx_top_k_accumulate(`{key}`, {counters(share)})").alias("sketch"), F.count(F.lit(1)).alias("n"))


def candidates(sketches: DataFrame, key: str, share: float) -> DataFrame:
    """The keys that the merged sketches report: at most ``counters(share)`` rows."""
    m = counters(share)
    merged = sketches.agg(F.expr(f"approx_top_k_combine(sketch, {m})").alias("sketch"))
    items = merged.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {m})")).alias("i"))
    return items.select(F.col("i.item").alias(key)).where(F.col(key).isNotNull())


def hot_keys_from_sketches(facts: DataFrame, sketches: DataFrame, key: str, share: float) -> DataFrame:
    """(key, n) of the keys with at least ``share`` of the rows of the sketched days, exact.

    ``facts`` are the rows of those days.  NULL is a key like any other and always counted.
    """
    found = F.broadcast(candidates(sketches, key, share).select(F.col(key).alias("_key")))  # at most counters(share) rows
    rows = facts.select(key)
    known = rows.join(found, F.col(key) == F.col("_key"), "left_semi")
    counts = known.unionByName(rows.where(F.col(key).isNull())).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = sketches.agg(F.sum("n").alias("n")).first()["n"] or 0
    return counts.where(F.col("n") >= F.lit(share * total))
