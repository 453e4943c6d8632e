import json
import os
import tempfile

from pyspark.sql import functions as F

import __spark_entry__ as entry
from adsphere.functions.codec import decode_map, decode_pairs, malformed_entries
from adsphere.operators.incremental import persons
from adsphere.operators.tag_agg import as_doubles
from adsphere.plans.daily import json_input, run_day
from adsphere.plans.feed import apply_feed
from adsphere.plans.tagging import TAG_SCHEMA, merged_in_one_pass, merged_profile
from adsphere.sources.adlog import HISTORY_DS, TODAY_DS
from adsphere.sources.dims import ip_ranges
from adsphere.sources.person_store import PersonStore
from adsphere.sources.range_file import write_range_file
from adsphere.sources.snapshots import read_snapshot
from conftest import SF001, sorted_rows


def _scratch_tables(spark):
    from adsphere.session import scratch_path
    base = os.path.dirname(scratch_path(spark, "x"))
    return set(os.listdir(base)) if os.path.isdir(base) else set()


def test_two_days_equal_the_merge_query(spark):
    root = tempfile.mkdtemp(prefix="adsphere-daily-")
    before = _scratch_tables(spark)
    run_day(spark, SF001, root, HISTORY_DS)
    assert _scratch_tables(spark) <= before   # intermediates removed
    paths = run_day(spark, SF001, root, TODAY_DS)
    got = as_doubles(read_snapshot(spark, root, "TAG", TODAY_DS, TAG_SCHEMA))
    want = entry.queries()["tag_merge"](spark, SF001)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))  # to the last bit
    ods = read_snapshot(spark, root, "ODS", TODAY_DS,
                        spark.read.parquet(paths["ODS"]).drop("ds").schema)
    assert ods.count() == entry.queries()["snapshot_read"](spark, SF001).count()
    n_people = got.select("person").distinct().count()
    assert spark.read.text(paths["profile_docs"]).count() == n_people
    # a re-run replaces the day instead of appending to it
    n_rows = got.count()
    run_day(spark, SF001, root, TODAY_DS)
    assert read_snapshot(spark, root, "TAG", TODAY_DS, TAG_SCHEMA).count() == n_rows


def test_one_pass_merge_equals_staged(spark):
    a, _ = merged_profile(spark, SF001)
    b, _ = merged_in_one_pass(spark, SF001)
    assert sorted_rows(as_doubles(a).collect()) == sorted_rows(as_doubles(b).select(*a.columns).collect())


def test_three_days_of_json_logs(spark, tmp_path):
    """JSON log and dictionary files in, any days, documents out; weights decay twice."""
    days = {"20240101": [dict(ip="16.0.0.1", appid="a1", client=1, ispname="移动", imei="me", sex="f", keywords="x,y")],
            "20240102": [dict(ip="17.0.1.1", appid="a2", client=2, mac="other", sex="m")],
            "20240103": [dict(ip="16.0.0.1", appname="named", imei="me", mac="m1", sex="f"), dict(ip="9.9.9.9", imei="me")]}
    apps, devices = tmp_path / "apps.txt", tmp_path / "devices.txt"
    apps.write_text("a1##First app\na2##Old\na2##Second app\n")
    devices.write_text("1##D00010001\n移动##D00030001\n")
    ranges = ip_ranges(spark, SF001)
    lon, lat = ranges.where("start_ip = 268435456").select("longitude", "latitude").first()
    body = json.dumps({"regeocode": {"addressComponent": {"businessAreas": [{"name": "Old town"}]}}})
    responses = spark.createDataFrame([(lon, lat, body)], "longitude float, latitude float, response string")
    root = str(tmp_path / "warehouse")
    for ds, rows in days.items():
        log = tmp_path / f"{ds}.json"
        log.write_text("\n".join(json.dumps(r) for r in rows) + "\n{broken\n")
        paths = run_day(spark, json_input(spark, str(log), ranges, responses, str(apps), str(devices)), root, ds)
    tags = {(r.person, r.tag): r.weight for r in as_doubles(read_snapshot(spark, root, "TAG", "20240103", TAG_SCHEMA)).collect()}
    assert tags["m1", "APP_First app"] == 0.81 if ("m1", "APP_First app") in tags else tags["me", "APP_First app"] == 0.81
    me = "m1" if ("m1", "SEX_f") in tags else "me"
    assert tags[me, "SEX_f"] == 1.81 and tags[me, "KW_x"] == 0.81 and tags[me, "BA_Old town"] == 1.81
    assert tags[me, "CB_D00010001"] == 0.81 and tags["other", "APP_Second app"] == 0.9
    docs = {d["_id"]: d for d in map(json.loads, (r.value for r in spark.read.text(paths["profile_docs"]).collect()))}
    assert {"value": "Old town", "weight": 1.81} in docs[me]["businessArea"]
    ods = spark.read.parquet(paths["ODS"]).where("ds = '20240103'")
    assert len(ods.columns) == 90 and ods.where("ip = '9.9.9.9'").first().longitude is None
    assert spark.read.parquet(paths["unknown_tags"]).where("ds = '20240103'").first().unknown_tags == 0


def test_days_that_write_only_what_they_touch(spark, tmp_path):
    """A range file, spoilt lines, no snapshots: feeds and metrics; the store holds what the snapshots would."""
    days = {"20240101": [dict(ip="16.0.0.1", client=1, mac="b", sex="f"), dict(mac="z", sex="m", new=1), "{broken", "[]"],
            "20240102": [dict(ip="17.0.1.1", imei="a", mac="b", keywords="x")], "20240103": [dict(imei="q", mac="q2", client="odd")]}
    apps = tmp_path / "apps.txt"
    apps.write_text("a1##First app\n")
    ranges = write_range_file(spark, ip_ranges(spark, SF001), str(tmp_path / "ranges.dat"))
    responses = spark.createDataFrame([], "longitude float, latitude float, response string")
    roots = {True: str(tmp_path / "full"), False: str(tmp_path / "touched")}
    docs = spark.createDataFrame([], "_id string, doc string")
    metrics, ops = {}, {}
    for ds, rows in days.items():
        log = tmp_path / f"{ds}.json"
        log.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n")
        for snapshot, root in roots.items():
            paths = run_day(spark, json_input(spark, str(log), ranges, responses, str(apps)), root, ds, snapshot=snapshot)
        metrics[ds] = {r.metric: r.value for r in spark.read.parquet(paths["metrics"]).where(F.col("ds") == ds).collect()}
        feed = spark.read.parquet(paths["document_feed"]).where(F.col("ds") == ds).drop("ds")
        ops[ds] = {r._id: r.op for r in feed.collect()}
        docs = apply_feed(docs, feed)
    assert "TAG" not in paths and metrics["20240101"] == {
        "lines": 4, "quarantined": 2, "rescued": 1, "ods_rows": 2, "unlocated": 0, "records": 2, "app_misses": 2, "unknown_tags": 0}
    assert ops == {"20240101": {"b": "insert", "z": "insert"}, "20240102": {"a": "insert", "b": "delete"}, "20240103": {"q": "insert"}}
    bad = spark.read.parquet(f"{roots[False]}/quarantine").where("ds = '20240101'")
    assert {r.line: r.reason for r in bad.collect()} == {"{broken": "malformed", "[]": "not an object"}
    rescued = spark.read.parquet(f"{roots[True]}/rescued").select("ds", F.to_json("rescued").alias("r")).collect()
    assert {(str(r.ds), r.r) for r in rescued} == {("20240101", '{"new":1}'), ("20240103", '{"client":"odd"}')}
    ods = spark.read.parquet(f"{roots[True]}/ODS")
    assert ods.count() == 4 and ods.where("ip IS NULL AND mac IS NULL").isEmpty()
    assert ods.where("ip = '16.0.0.1'").first().province == "P0省" and ods.where("longitude IS NOT NULL").isEmpty()
    # the same persons, weights and documents as with snapshots
    full = read_snapshot(spark, roots[True], "TAG", "20240103", TAG_SCHEMA)
    tags, ids = persons(PersonStore(spark, roots[False]), "20240103")
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, tags.select(*full.columns).collect()))
    texts = [json.loads(r.value) for r in spark.read.text(f"{roots[True]}/profile_docs/ds=20240103").collect()]
    got = {r._id: json.loads(r.doc) for r in docs.collect()}
    assert set(got) == {d["_id"] for d in texts}
    assert got["q"] == next(d for d in texts if d["_id"] == "q")  # touched today: today's weights
    # the full feeds lead to the full documents
    state = spark.createDataFrame([], "_id string, doc string")
    for ds in days:
        state = apply_feed(state, spark.read.parquet(f"{roots[True]}/document_feed").where(F.col("ds") == ds).drop("ds"))
    assert sorted(r.doc for r in state.collect()) == sorted(r.value for r in spark.read.text(f"{roots[True]}/profile_docs/ds=20240103").collect())


def test_snapshot_read_prunes_partitions(spark):
    plan = entry.queries()["snapshot_read"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan and TODAY_DS in plan


def test_codec_edge_cases(spark):
    rows = [(1, "(a,1.0),(a,2.0),(b,0.5)"), (2, ""), (3, "(APP_x,y,1.0)"), (4, "(broken),(t,x),(k,3.0)"), (5, None)]
    df = spark.createDataFrame(rows, "i int, t string").select(
        "i", decode_pairs(F.col("t")).alias("p"), decode_map(F.col("t")).alias("m"), malformed_entries(F.col("t")).alias("bad"))
    got = {r.i: r for r in df.collect()}
    assert got[1].m == {"a": 2.0, "b": 0.5} and len(got[1].p) == 3
    assert got[2].p == [] and got[2].m == {}
    assert got[3].m == {"APP_x,y": 1.0}
    assert got[4].m == {"k": 3.0} and got[4].bad == 2
    assert got[5].m is None
