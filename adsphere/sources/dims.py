"""Dimension tables derived from the driver tables (FIXTURES §3.2).

The reference reads an IP database, two text dictionaries and a geocoder;
none ships with it, so each is derived by rule from the driver's tables.
Every derivation is a Spark job over a driver table, so it grows with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .adlog import AD_LOG_EXPRESSIONS
from .tables import read_table

# The four IP blocks per nation — (block, first offset, last
# offset) added to (16 + nation) * 2**24; nation 24 and offsets 1024–1099
# match nothing.
IP_BLOCKS = ((0, 0, 255), (1, 256, 1023), (2, 1100, 4095), (3, 4096, 16777215))
IP_UNMAPPED_NATION = 24
# A range's coordinates, by nation and block (valid in both engines).
RANGE_LONGITUDE = "cast(-180 + (n_nationkey*1373 + b.j*577)%36000/100.0e0 as float)"
RANGE_LATITUDE = "cast(-90 + (n_nationkey*691 + b.j*353)%18000/100.0e0 as float)"

# The device dictionary (key##code), in file order.
DEVICE_DICTIONARY = (
    ("1", "D00010001"), ("2", "D00010002"), ("3", "D00010003"), ("4", "D00010004"),
    ("WIFI", "D00020001"), ("4G", "D00020002"), ("3G", "D00020003"), ("2G", "D00020004"),
    ("NETWORKOTHER", "D00020005"),
    ("移动", "D00030001"), ("联通", "D00030002"), ("电信", "D00030003"),
    ("OPERATOROTHER", "D00030004"),
)
# Codes used when a value is missing from the device dictionary.
CLIENT_OTHER, NETWORK_OTHER, OPERATOR_OTHER = "D00010004", "D00020005", "D00030004"

APP_DICT_SIZE = 50  # app ids XRX0..XRX49; multiples of 10 are left out (misses)


def ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(start_ip, end_ip, country, area, longitude, latitude): four disjoint ranges per mapped nation."""
    blocks = F.array(*[F.struct(F.lit(j).alias("j"), F.lit(lo).cast("bigint").alias("lo"),
                                F.lit(hi).cast("bigint").alias("hi")) for j, lo, hi in IP_BLOCKS])
    n = F.col("n_nationkey")
    base = (n + 16).cast("bigint") * 16777216
    return (read_table(spark, sf_dir, "nation")
            .where(n != IP_UNMAPPED_NATION)
            .select(n, F.explode(blocks).alias("b"))
            .select((base + F.col("b.lo")).alias("start_ip"),
                    (base + F.col("b.hi")).alias("end_ip"),
                    F.when(F.col("b.j") < 3,
                           F.concat(F.lit("P"), n, F.lit("省C"), n, F.lit("_"), F.col("b.j")))
                     .otherwise(F.concat(F.lit("M"), n)).alias("country"),
                    F.when(F.col("b.j") == 2, F.lit(" CZ88.NET"))
                     .otherwise(F.concat(F.lit("ISP"), F.col("b.j"))).alias("area"),
                    F.expr(RANGE_LONGITUDE).alias("longitude"), F.expr(RANGE_LATITUDE).alias("latitude")))


def app_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(appid, name): derived from the part keys present, ids not divisible by 10."""
    k = F.col("p_partkey") % APP_DICT_SIZE
    return (read_table(spark, sf_dir, "part").select(k.alias("k")).distinct()
            .where(F.col("k") % 10 != 0)
            .select(F.concat(F.lit("XRX"), F.col("k")).alias("appid"),
                    F.concat(F.lit("App "), F.col("k")).alias("name")))


def device_dictionary(spark: SparkSession) -> DataFrame:
    """(key, code): the 13 fixed entries."""
    return spark.createDataFrame(list(DEVICE_DICTIONARY), "key string, code string")


def geocode_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(longitude, latitude, response): a saved geocoder answer per customer location.

    ``c_custkey % 4`` = 0 → an empty area list ``[[]]``; 1 → invalid JSON;
    otherwise two areas ``BA{c%20}`` and ``BA{c%7}``.
    """
    c = F.col("c_custkey")
    lon = F.expr(AD_LOG_EXPRESSIONS["longitude"])
    lat = F.expr(AD_LOG_EXPRESSIONS["latitude"])

    def item(name):
        return F.concat(F.lit('{"location":"'), F.col("longitude").cast("string"), F.lit(","),
                        F.col("latitude").cast("string"),
                        F.lit('","name":"'), name, F.lit('","id":"'), c.cast("string"), F.lit('"}'))

    areas = F.concat(F.lit("["), item(F.concat(F.lit("BA"), c % 20)), F.lit(","),
                     item(F.concat(F.lit("BA"), c % 7)), F.lit("]"))
    body = (F.when(c % 4 == 0, F.lit("[[]]")).otherwise(areas))
    response = F.when(c % 4 == 1, F.lit("oops")).otherwise(
        F.concat(F.lit('{"status":"1","regeocode":{"addressComponent":{"businessAreas":'),
                 body, F.lit("}}}")))
    # One answer per coordinate: the lowest customer key at that location.
    first = (read_table(spark, sf_dir, "customer")
             .select(lon.alias("longitude"), lat.alias("latitude"), "c_custkey")
             .groupBy("longitude", "latitude").agg(F.min("c_custkey").alias("c_custkey")))
    return first.select("longitude", "latitude", response.alias("response"))
