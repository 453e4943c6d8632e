import os
import tempfile

from adsphere.operators.funnel import funnel_report
from adsphere.sources.adlog import FUNNEL_INPUT, ad_log
from adsphere.streaming.reports import funnel_snapshot, read_log_stream, streaming_funnel
from conftest import SF001, sorted_rows


def test_streaming_funnel_equals_batch(spark):
    root = tempfile.mkdtemp(prefix="adsphere-stream-")
    src = os.path.join(root, "in")
    log = ad_log(spark, SF001, ["channelid", *FUNNEL_INPUT])
    log.repartition(3).write.parquet(src)
    stream = read_log_stream(spark, src, log.schema, max_files_per_trigger=1)
    q = (streaming_funnel(stream, ["channelid"]).writeStream.outputMode("complete")
         .format("memory").queryName("funnel_running")
         .option("checkpointLocation", os.path.join(root, "ckpt")).start())
    q.processAllAvailable()
    q.stop()
    got = funnel_snapshot(spark.table("funnel_running"), ["channelid"])
    want = funnel_report(log, ["channelid"])
    assert sorted_rows(got.collect()) == sorted_rows(want.select(*got.columns).collect())


def test_streaming_enrichment_then_region_funnel(spark):
    from adsphere.plans.ods import build_ods
    from adsphere.sources.dims import ip_ranges
    from adsphere.streaming.reports import streaming_ods
    root = tempfile.mkdtemp(prefix="adsphere-stream-ods-")
    src = os.path.join(root, "in")
    cols = ["ip", *FUNNEL_INPUT]
    ad_log(spark, SF001, cols).repartition(2).write.parquet(src)
    stream = read_log_stream(spark, src, spark.read.parquet(src).schema)
    ods = streaming_ods(stream, ip_ranges(spark, SF001))
    q = (streaming_funnel(ods, ["province", "city"]).writeStream.outputMode("complete")
         .format("memory").queryName("region_running")
         .option("checkpointLocation", os.path.join(root, "ckpt")).start())
    q.processAllAvailable()
    q.stop()
    got = funnel_snapshot(spark.table("region_running"), ["province", "city"])
    want = funnel_report(build_ods(spark, SF001, [*cols, "province", "city"]), ["province", "city"])
    assert sorted_rows(got.collect()) == sorted_rows(want.select(*got.columns).collect())
