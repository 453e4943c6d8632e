"""The raw JSON ad log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The log's 85 field names in file order, with their types.
_S, _L, _D = T.StringType(), T.LongType(), T.DoubleType()
AD_LOG_FIELDS = (
    ("ip", _S), ("sessionid", _S), ("advertisersid", _L), ("adorderid", _L), ("adcreativeid", _L),
    ("adplatformproviderid", _L), ("sdkversion", _S), ("adplatformkey", _S), ("putinmodeltype", _L),
    ("requestmode", _L), ("adprice", _D), ("adppprice", _D), ("requestdate", _S), ("appid", _S),
    ("appname", _S), ("uuid", _S), ("device", _S), ("client", _L), ("osversion", _S),
    ("density", _S), ("pw", _L), ("ph", _L), ("ispid", _L), ("ispname", _S),
    ("networkmannerid", _L), ("networkmannername", _S), ("iseffective", _L), ("isbilling", _L),
    ("adspacetype", _L), ("adspacetypename", _S), ("devicetype", _L), ("processnode", _L),
    ("apptype", _L), ("district", _S), ("paymode", _L), ("isbid", _L), ("bidprice", _D),
    ("winprice", _D), ("iswin", _L), ("cur", _S), ("rate", _D), ("cnywinprice", _D),
    ("imei", _S), ("mac", _S), ("idfa", _S), ("openudid", _S), ("androidid", _S),
    ("rtbprovince", _S), ("rtbcity", _S), ("rtbdistrict", _S), ("rtbstreet", _S),
    ("storeurl", _S), ("realip", _S), ("isqualityapp", _L), ("bidfloor", _D), ("aw", _L),
    ("ah", _L), ("imeimd5", _S), ("macmd5", _S), ("idfamd5", _S), ("openudidmd5", _S),
    ("androididmd5", _S), ("imeisha1", _S), ("macsha1", _S), ("idfasha1", _S),
    ("openudidsha1", _S), ("androididsha1", _S), ("uuidunknow", _S), ("userid", _S),
    ("iptype", _L), ("initbidprice", _D), ("adpayment", _D), ("agentrate", _D),
    ("lomarkrate", _D), ("adxrate", _D), ("title", _S), ("keywords", _S), ("tagid", _S),
    ("callbackdate", _S), ("channelid", _S), ("mediatype", _L), ("email", _S), ("tel", _S),
    ("sex", _S), ("age", _S),
)
AD_LOG_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in AD_LOG_FIELDS])
CORRUPT = "_corrupt_record"


def read_json_log(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    """Line-delimited JSON with an explicit schema (no inference pass).

    Malformed lines are kept (PERMISSIVE) with their text in
    ``_corrupt_record`` when ``keep_corrupt`` is set.
    """
    schema = AD_LOG_SCHEMA
    if keep_corrupt:
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE")
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(path)


def parse_json_log(lines: DataFrame) -> DataFrame:
    """The 85 fields of each line (column ``value``) with ``rescued``, ``reason`` and ``line``.

    ``reason`` says why a line is no record: ``malformed`` (no JSON) or ``not an object``; else it is
    NULL.  ``rescued`` is a VARIANT object of what the fields do not hold: unknown fields, and known
    ones whose value has another type (the field itself is then NULL); NULL where there is none.
    Blank lines are no lines.
    """
    value = F.col("value")
    names = [n for n, _ in AD_LOG_FIELDS]
    typed = T.StructType([*AD_LOG_SCHEMA.fields, T.StructField(CORRUPT, T.StringType(), True)])
    df = lines.where(value.rlike(r"\S")).select(
        value.alias("line"), F.try_parse_json(value).alias("_v"),
        F.from_json(value, typed, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("_r"))
    whole = F.col("_v").isNotNull()
    # a JSON text is an object if it begins with a brace: no need to describe all of its values
    reason = (F.when(~whole, "malformed")
              .when(~F.startswith(F.ltrim(F.col("line"), F.lit(" \t\n\r")), F.lit("{")), "not an object"))
    # a field whose value does not fit makes the parsed record a corrupt one, so only a record with a misfit or
    # an unknown field pays for the map of all its values
    unknown = F.coalesce(F.exists(F.json_object_keys("line"), lambda k: ~k.isin(*names)), F.lit(True))
    plain = F.col("reason").isNotNull() | (F.col("_r")[CORRUPT].isNull() & ~unknown)
    df = df.withColumn("reason", reason).withColumn("_plain", plain)
    empty = F.array_compact(F.array(*[F.when(F.col("_r")[n].isNull(), F.lit(n)) for n in names]))
    known = F.array(*[F.lit(n) for n in names])
    df = df.withColumn("_m", F.when(~F.col("_plain"), F.from_json("line", T.MapType(T.StringType(), T.VariantType()))))
    df = df.withColumn("_empty", F.when(~F.col("_plain"), empty))
    kept = F.map_filter("_m", lambda k, v: (~F.array_contains(known, k) | F.array_contains(F.col("_empty"), k))
                        & ~F.is_variant_null(v))
    df = df.withColumn("_kept", F.when(~F.col("_plain"), kept))
    rescued = F.when(F.size("_kept") > 0, F.to_variant_object("_kept"))
    return df.select(*[F.when(F.col("reason").isNull(), F.col("_r")[n]).alias(n) for n in names],
                     rescued.alias("rescued"), "reason", "line")


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """S1 with rescue: :func:`parse_json_log` of a file or folder of JSON lines."""
    return parse_json_log(spark.read.text(path))
