"""Bucketed tables, sorted files with point lookups, heavy hitters from stored sketches."""

import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from adsphere.operators.sketch import candidates, counters, day_sketches, hot_keys_from_sketches
from adsphere.operators.skew import SALT, hot_keys
from adsphere.sources.layout import bucketed_join, point_lookup, salted_pair, write_bucketed, write_sorted


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_bucketed_join_needs_no_exchange_and_spreads_a_hot_key(spark, tmp_path):
    big = spark.range(6000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), (F.col("id") % 500).cast("string")))
                                   .alias("key"), F.col("id").alias("v"))
    small = big.where("key IS NOT NULL").select("key").distinct().where("key <> 'k1'").withColumn("w", F.concat(F.lit("w"), "key"))
    left, right = salted_pair(big, small, "key", ["v"], salts=8)
    name = "t" + uuid.uuid4().hex
    for side, df in (("l", left), ("r", right)):
        write_bucketed(df, f"{name}{side}", str(tmp_path / side), ["key", SALT], 8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = bucketed_join(spark, f"{name}l", f"{name}r", "key")
        plan = final_plan(joined)
        assert "Exchange" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan
        assert rows(joined.select("key", "v", "w")) == rows(big.join(small, "key", "left").select("key", "v", "w"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    per_salt = left.where("key = 'hot'").groupBy(SALT).count().collect()
    assert len(per_salt) == 8 and max(r["count"] for r in per_salt) < 2000 / 8 * 1.5
    assert left.where("key <> 'hot'").select(SALT).distinct().count() == 1


def test_point_lookup_reads_one_row_group(spark, tmp_path):
    df = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), F.col("id").alias("v"))
    path = write_sorted(df, str(tmp_path / "t"), "k", group_bytes=64 << 10)
    files = [pq.ParquetFile(f) for f in (tmp_path / "t").glob("*.parquet")]
    groups = [f.metadata.row_group(i).num_rows for f in files for i in range(f.metadata.num_row_groups)]
    assert len(groups) > 20
    key = df.where("v = 77").first()["k"]
    hit = point_lookup(spark, path, "k", key)
    assert [r.v for r in hit.collect()] == [77]
    stack, read = [hit._jdf.queryExecution().executedPlan()], None
    while stack:
        node = stack.pop()
        if node.nodeName().startswith("Scan parquet"):
            read = node.metrics().apply("numOutputRows").value()
        stack += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
    assert 0 < read <= max(groups)
    assert point_lookup(spark, path, "k", "no such key").isEmpty()


@pytest.mark.parametrize("share", [0.02, 0.1])
def test_sketched_hot_keys_are_exact(spark, share):
    # a hot key of all days, one of a single day, one just under and one just at the share, NULLs, a long tail
    n = 5000
    key = (F.when(F.col("id") % 7 == 0, 1).when(F.col("id") < n // 8, 2).when(F.col("id").between(n // 8, n // 8 + int(n * share) - 1), 3)
           .when(F.col("id") % 11 == 0, None).otherwise(F.col("id") + 1000))
    facts = spark.range(n).select(key.alias("k"), (F.col("id") % 5).alias("d"))
    sketches = day_sketches(facts, "k", "d", share)
    got = hot_keys_from_sketches(facts, sketches, "k", share)
    assert rows(got) == rows(hot_keys(facts, "k", min_share=share))
    assert candidates(sketches, "k", share).count() <= counters(share)
    two = sketches.where("day < 2")
    assert rows(hot_keys_from_sketches(facts.where("d < 2"), two, "k", share)) == rows(hot_keys(facts.where("d < 2"), "k", min_share=share))
    with pytest.raises(ValueError):
        counters(1e-9)
