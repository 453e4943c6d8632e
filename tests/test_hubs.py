"""Hot keys: the final plans split a hub's partition, and money keeps its small change."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from adsphere.operators import components as cc
from adsphere.operators.funnel import funnel_report
from adsphere.operators.tag_agg import component_members
from adsphere.session import materialize

SKEW = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_star_joins_split_a_hub(skewed):
    # a hub in the middle of the ids holds two thirds of the edges
    hub = skewed.range(40_000).select(F.format_string("z%07d", "id").alias("src"), F.lit("m0").alias("dst"))
    rest = skewed.range(20_000).select(F.format_string("a%07d", "id").alias("src"),
                                       F.format_string("b%07d", F.col("id") % 5000).alias("dst"))
    edges = materialize(hub.unionByName(rest).repartition(8), "hub-edges")
    assert "SortMergeJoin(skew=true)" in final_plan(cc._large_star(edges))
    assert "SortMergeJoin(skew=true)" in final_plan(cc._small_star(
        edges.select(F.greatest("src", "dst").alias("dst"), F.least("src", "dst").alias("src"))
        .union(hub.select(F.lit("zz").alias("dst"), F.col("src")))))
    comps = cc.connected_components(edges)
    assert comps.where("id = 'm0' or id like 'z%'").select("component").distinct().count() == 1
    assert "skew=true" in final_plan(component_members(comps.repartition(8)))


def test_money_is_not_cut_to_cents(spark):
    row = dict(requestmode=1, processnode=1, iseffective=1, isbilling=1, isbid=1, iswin=1, adplatformproviderid=100000,
               adorderid=200001, adcreativeid=200001, winprice=0.004, adpayment=1.2345)
    log = spark.createDataFrame([{**row, "city": "x"}] * 1000)
    r = funnel_report(log, ["city"]).first()
    assert (r.consumption_number, r.cost_number) == (0.004, 1.2345)


def test_rebalanced_write_spreads_a_hot_key(skewed, tmp_path):
    from adsphere.sources.snapshots import write_snapshot
    rows = skewed.range(60_000).select(F.when(F.col("id") % 4 > 0, "hub").otherwise(F.col("id").cast("string")).alias("person"),
                                       F.sha2(F.col("id").cast("string"), 256).alias("id"))
    path = write_snapshot(rows, str(tmp_path), "IDS", "20240101", keys=["person"])
    files = skewed.read.parquet(path).where("person = 'hub'").select(F.input_file_name().alias("f")).distinct().count()
    assert files > 4 and skewed.read.parquet(path).count() == 60_000
