"""The seven daily funnel reports over an ODS/log frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.funnel import (count_report, device_labels, device_report, funnel_aggregates,
                                funnel_report, with_ratios)
from ..sources.adlog import FUNNEL_INPUT, ad_log

# report name → grouping columns (device is special: raw client, then label)
REPORT_DIMS = {
    "report_region": ["province", "city"],
    "report_app": ["appid", "appname"],
    "report_device": ["client", "device"],
    "report_network": ["networkmannerid", "networkmannername"],
    "report_operator": ["ispname"],
    "report_channel": ["channelid"],
}


def report(df: DataFrame, name: str) -> DataFrame:
    if name == "report_province_city":
        return count_report(df, ["province", "city"])
    if name == "report_device":
        return device_report(df)
    return funnel_report(df, REPORT_DIMS[name])


def report_from_log(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read only the columns the report needs from the log (pruned joins)."""
    if name == "report_province_city":
        cols = ["province", "city"]
    else:
        cols = list(REPORT_DIMS[name]) + list(FUNNEL_INPUT)
    return report(ad_log(spark, sf_dir, cols), name)


def all_reports(ods: DataFrame) -> dict[str, DataFrame]:
    """All seven reports over one ODS frame (pass a persisted/materialised ODS)."""
    names = ["report_province_city", *REPORT_DIMS]
    return {n: report(ods, n) for n in names}


def reports_one_pass(ods: DataFrame) -> dict[str, DataFrame]:
    """All seven reports from a single scan of the ODS (GROUPING SETS).

    One ``Expand`` feeds one partial/final aggregation; each report is a
    filter on ``grouping_id`` of the shared result, which is written once as
    a table so the seven readers do not recompute it.  Returns the same rows
    as :func:`all_reports`.
    """
    from ..session import materialize

    sets = list(REPORT_DIMS.values())
    dims = [d for ds_ in sets for d in ds_ if d]
    dims = list(dict.fromkeys(dims))
    grouped = ods.groupingSets(sets, *dims).agg(
        *funnel_aggregates(), F.count(F.lit(1)).alias("n"), F.grouping_id(*dims).alias("_gid"))
    cube = materialize(grouped, "funnel-cube")

    def gid(cols):
        # grouping_id bit i (from the left, most significant first) is 1 when dims[i] is aggregated away
        return sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in cols)

    out = {}
    for name, cols in REPORT_DIMS.items():
        part = cube.where(F.col("_gid") == gid(cols))
        if name == "report_device":
            out[name] = device_labels(with_ratios(part, cols))
        else:
            out[name] = with_ratios(part, cols)
    region = cube.where(F.col("_gid") == gid(REPORT_DIMS["report_region"]))
    out["report_province_city"] = region.select("province", "city", "n")
    return out
