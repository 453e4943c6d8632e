"""Request → bid → show → click funnel metrics.

All metrics are conditional counts and exact money sums, so they aggregate
partially on the map side (``HashAggregate`` partial + final): a hot group —
one city holding a third of the log — costs one row per map task in the
shuffle, never a hot reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Output names.  The reference misspells three of them; this is the one place
# that maps its spelling to ours.
REFERENCE_SPELLING = {
    "consumption_number": "consumtion_number",
    "province": "proviceName",
    "geohash": "genhash",
}

METRIC_COLUMNS = ("org_num", "valid_num", "ad_num", "bid_num", "bid_success_num",
                  "bid_success_rat", "show_num", "click_num", "click_rat",
                  "media_show_num", "media_click_num", "consumption_number", "cost_number")

PRICE_SCALE = 10


def _flags():
    c = F.col
    a = c("adplatformproviderid") >= 100000
    e = c("iseffective") == 1
    b = c("isbilling") == 1
    w = c("iswin") == 1
    return c, a, e, b, w


def _money(cond: Column, column: str) -> Column:
    """Exact, order-independent money sum, reported in thousands as double.

    Prices are summed as decimals with ``PRICE_SCALE`` digits behind the point, far below
    any price's precision, so nothing is cut per row and the total does not depend on the
    order of the rows; only the total becomes a double.
    """
    price = F.col(column).cast(f"decimal(28,{PRICE_SCALE})")
    total = F.sum(F.when(cond, price))
    return F.coalesce(total.cast("double"), F.lit(0.0)) / F.lit(1000.0)


def funnel_aggregates() -> list[Column]:
    """The eleven additive funnel metrics as aggregate expressions."""
    c, a, e, b, w = _flags()
    mode, node = c("requestmode"), c("processnode")
    paid = a & e & b & w & (c("adorderid") > 200000) & (c("adcreativeid") > 200000)
    return [
        F.count_if((mode == 1) & (node >= 1)).alias("org_num"),
        F.count_if((mode == 1) & (node >= 2)).alias("valid_num"),
        F.count_if((mode == 1) & (node == 3)).alias("ad_num"),
        F.count_if(a & e & b & (c("isbid") == 1) & (c("adorderid") != 0)).alias("bid_num"),
        F.count_if(e & w & b & a).alias("bid_success_num"),
        F.count_if((mode == 2) & e).alias("show_num"),
        F.count_if((mode == 3) & e).alias("click_num"),
        F.count_if((mode == 2) & e & b).alias("media_show_num"),
        F.count_if((mode == 3) & e & b).alias("media_click_num"),
        _money(paid, "winprice").alias("consumption_number"),
        _money(paid, "adpayment").alias("cost_number"),
    ]


def with_ratios(agg: DataFrame, dims: list[str]) -> DataFrame:
    """Add the two ratios; a zero denominator gives NULL (ANSI-safe)."""
    c = F.col
    return agg.select(
        *dims, "org_num", "valid_num", "ad_num", "bid_num", "bid_success_num",
        F.try_divide(c("bid_success_num"), c("bid_num")).alias("bid_success_rat"),
        "show_num", "click_num",
        F.try_divide(c("click_num"), c("show_num")).alias("click_rat"),
        "media_show_num", "media_click_num", "consumption_number", "cost_number",
    )


def funnel_report(df: DataFrame, dims: list[str]) -> DataFrame:
    """Group the log by ``dims`` and compute the 13 funnel columns."""
    return with_ratios(df.groupBy(*dims).agg(*funnel_aggregates()), list(dims))


def client_label(col: Column) -> Column:
    """1 → 'android ' (trailing space kept), 2 → 'ios', 3 → 'wp', else 'other'."""
    return (F.when(col == 1, F.lit("android ")).when(col == 2, F.lit("ios"))
            .when(col == 3, F.lit("wp")).otherwise(F.lit("other")))


def device_labels(rep: DataFrame) -> DataFrame:
    """Label the raw client of a (client, device) report, keeping the raw value as ``client_id``."""
    return rep.select(client_label(F.col("client")).alias("client"),
                      F.col("client").alias("client_id"),
                      *[c for c in rep.columns if c != "client"])


def device_report(df: DataFrame) -> DataFrame:
    """A4: grouped on the raw ``client`` (so 4, 5 and NULL stay separate rows)."""
    return device_labels(funnel_report(df, ["client", "device"]))


def count_report(df: DataFrame, dims: list[str]) -> DataFrame:
    """A1: plain row count per group."""
    return df.groupBy(*dims).agg(F.count(F.lit(1)).alias("n"))
