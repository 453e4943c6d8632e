"""The ad-exchange log as a view over the driver's TPC-H-like tables.

One log row per ``lineitem`` row.  Each log column is a SQL expression over
``lineitem``/``orders``/``customer``/``nation``/``part`` columns; the text is
valid in both Spark SQL and DuckDB, so the correctness oracle builds the very
same input.  Only the tables a caller's columns need are joined: a report on
``province, city`` never touches ``part``, and one on ``appid`` never touches
``orders`` or ``customer``.

Join plan (sizes at scale: lineitem ≫ orders > customer ≫ nation):
``orders ⋈ customer ⋈ nation`` is built first on the narrow order side, then
joined to ``lineitem`` on ``l_orderkey``; ``part`` is joined on ``l_partkey``.
``nation`` has the spec-fixed 25 rows and is broadcast; every other join is
left to the planner (sort-merge at scale, AQE turns small sides into
broadcasts at run time, and splits skewed partitions).  ``lineitem ⋈ orders``
carries a sort-merge hint: both are fact-sized.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# The fixture's definition of every log column (shared with the
# oracle; `||` is string concatenation in both engines).
AD_LOG_EXPRESSIONS: dict[str, str] = {
    "ip": "(16+c_nationkey) || '.' || (cast(floor(c_custkey/65536) as bigint)%256) || '.' || "
          "(cast(floor(c_custkey/256) as bigint)%256) || '.' || (c_custkey%256)",
    "requestmode": "cast(1 + l_partkey%3 as bigint)",
    "processnode": "cast(1 + l_linenumber%3 as bigint)",
    "iseffective": "cast(case when cast(floor(l_quantity) as bigint)%5<>0 then 1 else 0 end as bigint)",
    "isbilling": "cast(case when l_returnflag='N' then 0 else 1 end as bigint)",
    "isbid": "cast(case when l_linestatus='O' then 1 else 0 end as bigint)",
    "iswin": "cast(case when (l_suppkey+l_partkey)%2=0 then 1 else 0 end as bigint)",
    "adplatformproviderid": "cast(99950 + l_suppkey%100 as bigint)",
    "adorderid": "cast(case when l_partkey%7=0 then 0 else 199000+l_orderkey end as bigint)",
    "adcreativeid": "cast(199500 + l_partkey as bigint)",
    "winprice": "l_extendedprice",
    "adpayment": "l_extendedprice - l_quantity",
    "client": "cast(1 + l_partkey%5 as bigint)",
    "device": "p_brand",
    "devicetype": "cast(l_partkey%4 as bigint)",
    "ispname": "case l_suppkey%5 when 0 then '移动' when 1 then '联通' when 2 then '电信' "
               "when 3 then 'OPERATOROTHER' else 'UNLISTED' end",
    "networkmannerid": "cast((l_linenumber+l_partkey)%5 as bigint)",
    "networkmannername": "case (l_linenumber+l_partkey)%5 when 0 then 'WIFI' when 1 then '4G' "
                         "when 2 then '3G' when 3 then '2G' else 'NETWORKOTHER' end",
    "channelid": "cast(l_suppkey%20 as varchar(9))",
    "appid": "'XRX' || (l_partkey%50)",
    "appname": "case when l_partkey%11=0 then null else p_name end",
    "adspacetypename": "p_type",
    "keywords": "replace(p_name,' ',',')",
    "sex": "case when l_orderkey%13=0 then null else o_orderstatus end",
    "age": "cast(18+c_custkey%50 as varchar(9))",
    "province": "n_name",
    "city": "n_name || '_' || (c_custkey%4)",
    "longitude": "cast(-180 + (c_custkey*7919%36000)/100.0e0 as float)",
    "latitude": "cast(-90 + (c_custkey*104729%18000)/100.0e0 as float)",
    "mac": "case when l_orderkey%10=9 then null else 'M' || cast(floor(l_orderkey/4) as bigint) end",
    "androidid": "case when cast(floor((l_orderkey+2)/4) as bigint)%3<>0 and l_orderkey%10<>9 "
                 "then 'A' || cast(floor((l_orderkey+2)/4) as bigint) else '' end",
    "imei": "case when l_orderkey%10=9 and l_orderkey%4=1 then '   ' else null end",
    "idfa": "cast(null as string)",
    "openudid": "cast(null as string)",
    "event_ts": "l_shipdate",
}

# Tables each log column reads besides lineitem.
_NEEDS = {
    "ip": {"customer"}, "age": {"customer"}, "longitude": {"customer"},
    "latitude": {"customer"}, "province": {"customer", "nation"},
    "city": {"customer", "nation"}, "sex": {"orders"},
    "device": {"part"}, "appname": {"part"}, "adspacetypename": {"part"},
    "keywords": {"part"},
}

AD_LOG_COLUMNS = tuple(AD_LOG_EXPRESSIONS)

# Columns of the log that the funnel reports read.
FUNNEL_INPUT = ("requestmode", "processnode", "iseffective", "isbilling", "isbid", "iswin",
                "adplatformproviderid", "adorderid", "adcreativeid", "winprice", "adpayment")

# The day split of the fixture: rows shipped before this date form the
# history day, the rest today (day suffixes per G20).
HISTORY_END = "1998-07-01"
TODAY_DS = "19980701"
HISTORY_DS = "19980630"
DS_EXPRESSION = (f"case when event_ts < timestamp '{HISTORY_END} 00:00:00' "
                 f"then '{HISTORY_DS}' else '{TODAY_DS}' end")


def needed_tables(columns) -> set[str]:
    need: set[str] = set()
    for c in columns:
        need |= _NEEDS.get(c, set())
    if "customer" in need:
        need.add("orders")
    return need


def day_filter(ds: str):
    """The rows of one fixture day as a predicate on ``l_shipdate`` (pushed into the scan)."""
    # a zone-free literal: the column is timestamp_ntz, the split must not move with the session zone
    bound = F.lit(f"{HISTORY_END} 00:00:00").cast("timestamp_ntz")
    if ds == HISTORY_DS:
        return F.col("l_shipdate") < bound
    if ds == TODAY_DS:
        return F.col("l_shipdate") >= bound
    raise ValueError(f"the fixture has no day {ds!r}")


def ad_log(spark: SparkSession, sf_dir: str, columns=None, with_ds: bool = False,
           ds: str | None = None) -> DataFrame:
    """The log restricted to ``columns`` (all when None), joining only what they need.

    ``ds`` keeps one day; the predicate reaches the lineitem scan.
    """
    cols = list(columns) if columns is not None else list(AD_LOG_COLUMNS)
    if with_ds and "event_ts" not in cols:
        cols.append("event_ts")
    need = needed_tables(cols)
    df = read_table(spark, sf_dir, "lineitem")
    if ds is not None:
        df = df.where(day_filter(ds))
    if "orders" in need:
        side = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
        if "customer" in need:
            cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
            if "nation" in need:
                # TPC-H fixes nation at 25 rows: a proven bound, safe to broadcast.
                nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
                cust = cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey)
            side = side.join(cust, side.o_custkey == cust.c_custkey)
        # Both sides are fact-sized at scale: pin a sort-merge join so the
        # planner never broadcasts lineitem on a stale size estimate, and the
        # work after the join runs in shuffle partitions.
        df = df.join(side.hint("merge"), df.l_orderkey == side.o_orderkey)
    if "part" in need:
        part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", "p_type")
        df = df.join(part, df.l_partkey == part.p_partkey)
    out = df.select(*[F.expr(AD_LOG_EXPRESSIONS[c]).alias(c) for c in cols])
    if with_ds:
        out = out.withColumn("ds", F.expr(DS_EXPRESSION.replace("timestamp '", "timestamp_ntz '")))
    return out
