"""ODS build: the log enriched with location from IP ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ip import (UNKNOWN_AREA, UNKNOWN_COUNTRY, area_label, city_of, ip_to_number,
                            province_of)
from ..operators.joins import range_join
from ..sources.adlog import AD_LOG_COLUMNS, ad_log
from ..sources.dims import ip_ranges
from ..sources.jsonlog import AD_LOG_FIELDS

# ODS column order: the log columns, with province/city taken from the IP lookup.
ODS_COLUMNS = tuple(AD_LOG_COLUMNS)


def has_ip(col="ip"):
    """A usable IP text."""
    return F.col(col).isNotNull() & (F.col(col) != "")


def distinct_ips(log: DataFrame) -> DataFrame:
    """P1 + A8."""
    return log.select("ip").where(has_ip()).distinct()


def lookup_ips(ips: DataFrame, ranges: DataFrame) -> DataFrame:
    """(ip, ip_num, country, area, province, city, longitude, latitude); a miss gets the
    unknown labels and NULL coordinates."""
    joined = range_join(ips, ip_to_number(F.col("ip")), ranges, "start_ip", "end_ip", how="left")
    country = F.coalesce(F.col("country"), F.lit(UNKNOWN_COUNTRY))
    return joined.select(
        "ip", ip_to_number(F.col("ip")).alias("ip_num"), country.alias("country"),
        F.coalesce(area_label(F.col("area")), F.lit(UNKNOWN_AREA)).alias("area"),
        province_of(country).alias("province"), city_of(country).alias("city"),
        F.col("longitude").cast("double").alias("longitude"), F.col("latitude").cast("double").alias("latitude"))


def enrich(log: DataFrame, ranges: DataFrame) -> DataFrame:
    """J1 without the distinct + join-back: each log row probes the bucketed ranges directly.

    The bucketed range table is size-checked and broadcast, so this is a
    narrow, map-only stage — the log is never shuffled.  Rows without an IP
    keep NULL location; unknown IPs get the unknown labels.  J3: a log without
    coordinates gets those of its range (NULL on a miss).
    """
    cols = [c for c in log.columns if c not in ("province", "city")]
    located = [] if "longitude" in cols else [c for c in ("longitude", "latitude") if c in ranges.columns]
    # the labels are split once per range, not once per log row
    country = F.coalesce(F.col("country"), F.lit(UNKNOWN_COUNTRY))
    places = ranges.select("start_ip", "end_ip", province_of(country).alias("_province"), city_of(country).alias("_city"), *located)
    joined = range_join(log, ip_to_number(F.col("ip")), places, "start_ip", "end_ip", how="left")
    province = F.when(has_ip(), F.coalesce("_province", F.lit(UNKNOWN_COUNTRY))).alias("province")
    city = F.when(has_ip(), F.coalesce("_city", F.lit(UNKNOWN_COUNTRY))).alias("city")
    out = joined.select(*cols, province, city, *located)
    return out.select(*[c for c in ODS_COLUMNS if c in out.columns],
                      *[c for c in out.columns if c not in ODS_COLUMNS])


def build_ods(spark: SparkSession, sf_dir: str, columns=None, with_ds: bool = False,
              ds: str | None = None) -> DataFrame:
    cols = list(columns) if columns is not None else list(ODS_COLUMNS)
    if "ip" not in cols:
        cols.append("ip")
    log = ad_log(spark, sf_dir, [c for c in cols if c not in ("province", "city")], with_ds=with_ds, ds=ds)
    out = enrich(log, ip_ranges(spark, sf_dir))
    keep = [c for c in out.columns if c in cols or c == "ds"]
    return out.select(*keep)


def full_ods(log: DataFrame, ranges: DataFrame) -> DataFrame:
    """The 89 columns — all log fields (NULL where the log lacks one) plus
    longitude, latitude, province and city from the IP join."""
    names = [n for n, _ in AD_LOG_FIELDS]
    padded = log.select(*[F.col(n).cast(t).alias(n) if n in log.columns else F.lit(None).cast(t).alias(n)
                          for n, t in AD_LOG_FIELDS])
    return enrich(padded, ranges).select(*names, "longitude", "latitude", "province", "city")
