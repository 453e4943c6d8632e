"""Join helpers: size-checked broadcast and the bucketed range join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A dimension is broadcast only when it is checked to be below both limits.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 128 * 1024 * 1024


def measure(df: DataFrame):
    """(rows, approximate bytes) of ``df`` in one aggregation job.

    Bytes are the UTF-8 length of every value's text form plus 8 per value —
    close to the size of the rows a broadcast ships.
    """
    sizes = [F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) + F.lit(8)
             for f in df.schema.fields]
    row_bytes = sizes[0]
    for c in sizes[1:]:
        row_bytes = row_bytes + c
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes.cast("long")).alias("b")).collect()[0]
    return r["n"], r["b"] or 0


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether ``df`` is below both limits; ``max_rows=0`` answers without a measuring job."""
    if max_rows <= 0:
        return False
    n, b = measure(df)
    return n <= max_rows and b <= max_bytes


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                      max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast ``df`` only after measuring it; otherwise leave a shuffle join.

    The measurement runs ``df``'s plan once, so pass a source table, a stored
    one, or a cheap derivation of such.  Beyond either limit the plain frame is
    returned, and the planner uses a sort-merge join (AQE can still switch to
    broadcast at run time and split skewed partitions).
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def bucket_ranges(ranges: DataFrame, start: str, end: str, bits: int = 16,
                  bucket: str = "_bucket") -> DataFrame:
    """One row per (range, ``bits``-wide bucket) it overlaps.

    For disjoint ranges over a 32-bit key this has at most
    ``2**(32-bits) + number_of_ranges`` rows — a bound independent of the
    probe side, which is what makes broadcasting it safe.
    """
    return ranges.withColumn(
        bucket, F.explode(F.sequence(F.shiftright(F.col(start), bits),
                                     F.shiftright(F.col(end), bits))))


def range_join(probe: DataFrame, key: Column, ranges: DataFrame, start: str, end: str,
               how: str = "left", bits: int = 16, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Join each probe row to the range with ``start <= key <= end``.

    A plain ``between`` join plans as a nested loop; here it becomes an equi
    join on ``key >> bits`` plus the ``between`` residual, so Spark plans a
    (broadcast) hash join and the probe side is never shuffled when the
    bucketed dimension passes the size check.
    """
    buckets = checked_broadcast(bucket_ranges(ranges, start, end, bits), max_rows)
    probe = probe.withColumn("_probe_key", key)
    cond = ((F.shiftright(probe["_probe_key"], bits) == buckets["_bucket"])
            & (probe["_probe_key"] >= buckets[start]) & (probe["_probe_key"] <= buckets[end]))
    return probe.join(buckets, cond, how).drop("_bucket", "_probe_key")
