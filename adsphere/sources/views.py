"""Temp views for SQL users (S9): name the log, the ODS and the dimensions."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .adlog import ad_log
from .dims import app_dictionary, device_dictionary, geocode_responses, ip_ranges


def register_views(spark: SparkSession, sf_dir: str, with_ods: bool = True) -> list[str]:
    """Create ``ad_log``, ``ods``, ``ip_ranges``, ``app_dict``, ``device_dict`` and
    ``geocode`` temp views; Catalyst optimises SQL on them like the DataFrame API."""
    views = {
        "ad_log": ad_log(spark, sf_dir, with_ds=True),
        "ip_ranges": ip_ranges(spark, sf_dir),
        "app_dict": app_dictionary(spark, sf_dir),
        "device_dict": device_dictionary(spark),
        "geocode": geocode_responses(spark, sf_dir),
    }
    if with_ods:
        from ..plans.ods import build_ods
        views["ods"] = build_ods(spark, sf_dir, with_ds=True)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
