"""The funnel reports over a stream of log files (Structured Streaming).

The daily batch job reads one day of logs; the same report can be kept up to
date while the day's files arrive.  The funnel metrics are sums, so they are
maintained as a streaming aggregation (state = one row of partial sums per
group); the ratios are derived when the result is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.funnel import funnel_aggregates, with_ratios


def read_log_stream(spark: SparkSession, path: str, schema: StructType,
                    fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream of log rows with an explicit schema."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def streaming_funnel(stream: DataFrame, dims: list[str]) -> DataFrame:
    """Running funnel sums per group (use output mode ``update`` or ``complete``)."""
    return stream.groupBy(*dims).agg(*funnel_aggregates())


def funnel_snapshot(running: DataFrame, dims: list[str]) -> DataFrame:
    """Add the ratio columns to a (batch) read of the running sums."""
    return with_ratios(running, list(dims))


def streaming_ods(stream: DataFrame, ranges: DataFrame) -> DataFrame:
    """IP enrichment of arriving log rows: a stream–static join against the
    size-checked, broadcast bucketed ranges (no state, no shuffle)."""
    from ..plans.ods import enrich

    return enrich(stream, ranges)
