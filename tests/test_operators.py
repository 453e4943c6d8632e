"""Operator properties: components, range join, skew joins, decay/merge, snapshots, sinks."""

import json
import os
import random
import tempfile

from pyspark.sql import Row
from pyspark.sql import functions as F

from adsphere.operators import skew
from adsphere.operators.components import connected_components
from adsphere.operators.joins import range_join
from adsphere.operators.tag_agg import as_doubles, merge_history, person_profile
from adsphere.plans import profile
from adsphere.sources import jsonlog, snapshots
from adsphere.sources.dims import ip_ranges
from conftest import SF01


def _union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in list(parent)}


def test_graph_fixture(spark):
    # people 1-7, 9-11; edges to hubs 133, 155, 188; hubs are dropped by the join back
    edges = [(str(s), "133") for s in (1, 2, 3, 4, 5)] + [(str(s), "155") for s in (4, 5, 6, 7)] \
        + [(str(s), "188") for s in (9, 10, 11)]
    comps = connected_components(spark.createDataFrame(edges, "src string, dst string"))
    people = spark.createDataFrame([(str(i),) for i in (1, 2, 3, 4, 5, 6, 7, 9, 10, 11)], "id string")
    groups = {}
    for r in people.join(comps, "id").collect():
        groups.setdefault(r.component, set()).add(int(r.id))
    assert sorted(groups.values(), key=min) == [{1, 2, 3, 4, 5, 6, 7}, {9, 10, 11}]


def test_components_long_chain_and_random(spark):
    chain = [(f"n{i:04d}", f"n{i + 1:04d}") for i in range(300)]
    rnd = random.Random(3)
    rand_edges = [(f"r{rnd.randrange(400):03d}", f"r{rnd.randrange(400):03d}") for _ in range(300)]
    edges = chain + rand_edges
    want = _union_find([(a, b) for a, b in edges if a != b])
    got = {r.id: r.component for r in
           connected_components(spark.createDataFrame(edges, "src string, dst string")).collect()}
    assert got == {k: v for k, v in want.items() if k in got}
    assert set(got) == {x for e in edges if e[0] != e[1] for x in e}


def test_components_stable_under_shuffle(spark):
    edges = [(f"a{i}", f"a{(i * 7) % 50}") for i in range(50)]
    df = spark.createDataFrame(edges, "src string, dst string")
    one = sorted(connected_components(df).collect())
    two = sorted(connected_components(df.repartition(7).orderBy(F.rand(1))).collect())
    assert one == two


def test_range_join_equals_between_join(spark):
    ranges = ip_ranges(spark, SF01)
    rnd = random.Random(11)
    probes = [(rnd.randrange(16 << 24, 41 << 24),) for _ in range(2000)]
    p = spark.createDataFrame(probes, "n long")
    fast = range_join(p, F.col("n"), ranges, "start_ip", "end_ip").select("n", "country")
    slow = p.join(ranges, (p.n >= ranges.start_ip) & (p.n <= ranges.end_ip), "left").select("n", "country")
    assert sorted(fast.collect()) == sorted(slow.collect())


STUDENTS = [("1", "s1", 18, "class_01"), ("2", "s2", 19, "class_01"), ("3", "s3", 29, "class_01"),
            ("4", "s4", 21, "class_01"), ("5", "s5", 22, "class_01"), ("6", "s6", 23, "class_01"),
            ("7", "s7", 24, "class_02"), ("8", "s8", 25, "class_01"), ("9", "s9", 26, "class_04"),
            ("10", "s10", 27, "class_05")]
CLASSES = [("class_01", "c1"), ("class_02", "c2"), ("class_03", "c3"), ("class_04", "c4"), ("class_05", "c5")]


def _frames(spark, students=STUDENTS):
    s = spark.createDataFrame(students, "id string, name string, age int, classId string")
    c = spark.createDataFrame(CLASSES, "classId string, cname string")
    return s, c


def test_filter_join(spark):
    rows = [(str(i), f"s{i}", 20, "") for i in range(1, 8)] + \
        [(str(i), f"s{i}", 20, "class_01") for i in (8, 9, 10)]
    s, c = _frames(spark, rows)
    c2 = c.withColumnRenamed("classId", "cid")
    dropped = skew.filter_null_keys_join(s, c2, "classId", "cid", preserve=False)
    assert dropped.count() == 3
    kept = skew.filter_null_keys_join(s, c2, "classId", "cid", preserve=True)
    assert kept.count() == 10 and kept.where("cname is null").count() == 7


def test_salted_equals_plain(spark):
    s, c = _frames(spark)
    plain = sorted(s.join(c, "classId", "left").collect())
    assert sorted(skew.broadcast_join(s, c, "classId").collect()) == plain
    hot = skew.hot_keys(s, "classId", min_count=5)
    assert [r.classId for r in hot.collect()] == ["class_01"]
    iso = skew.isolate_hot_keys_join(s, c, "classId", hot, ["id"], 10)
    plain_cols = sorted(s.join(c, "classId", "left").select(*s.columns, "cname").collect())
    assert sorted(iso.select(*s.columns, "cname").collect()) == plain_cols
    exp = skew.expand_join(s, c, "classId", ["id"], 10)
    assert sorted(exp.select(*s.columns, "cname").collect()) == plain_cols
    counts = {r.classId: r.n for r in skew.two_phase_count(s, "classId", ["id"], 10).collect()}
    assert counts == {"class_01": 7, "class_02": 1, "class_04": 1, "class_05": 1}
    assert skew.hot_keys(s, "classId", min_share=0.5).count() == 1
    assert skew.rows_per_partition(s).agg(F.sum("n")).collect()[0][0] == 10


def _records(spark, rows):
    return spark.createDataFrame(rows, "main_id string, ids array<string>, tags array<string>")


def test_decay_and_merge(spark):
    hist = _records(spark, [("u1", ["u1", "x"], ["t"])])
    today = _records(spark, [("x", ["x", "u2"], ["t", "s"])])
    h_tags, h_ids = person_profile(hist)
    tags, ids = merge_history(h_tags, h_ids, today, 0.9)
    got = {(r.person, r.tag): r.weight for r in as_doubles(tags).collect()}
    assert got == {("u1", "t"): 1.9, ("u1", "s"): 1.0}
    assert sorted(r.id for r in ids.collect()) == ["u1", "u2", "x"]
    # coefficient 0 keeps today only; coefficient 1 is the plain sum
    t0, _ = merge_history(h_tags, h_ids, today, 0.0)
    assert {(r.person, r.tag): r.weight for r in t0.collect()}[("u1", "t")] == 1.0
    t1, _ = merge_history(h_tags, h_ids, today, 1.0)
    assert {(r.person, r.tag): r.weight for r in t1.collect()}[("u1", "t")] == 2.0


def test_profile_documents(spark):
    tags = spark.createDataFrame([("p", "CB_D00010002", 2.0), ("p", "KW_blue", 1.0), ("p", "XX_odd", 1.0)],
                                 "person string, tag string, weight double")
    assert profile.unknown_tag_count(tags).collect()[0][0] == 1
    tags = tags.unionByName(spark.createDataFrame([("q", "XX_odd", 1.0)], tags.schema))
    rows = profile.profile_rows(profile.classify_tags(tags))
    docs = sorted(profile.profile_documents(rows).collect())
    assert len(docs) == 2 and json.loads(docs[1].doc)["keyword"] == []   # only unknown tags: still a document
    doc = json.loads(docs[0].doc)
    assert doc["_id"] == "p" and len(doc) == 15
    assert doc["client"] == [{"value": "ios", "weight": 2.0}]
    assert doc["keyword"] == [{"value": "blue", "weight": 1.0}]
    assert doc["sex"] == []
    out = tempfile.mkdtemp(prefix="adsphere-docs-")
    profile.write_documents(profile.profile_documents(rows), os.path.join(out, "docs"))
    assert spark.read.text(os.path.join(out, "docs")).count() == 2


def test_snapshots(spark):
    root = tempfile.mkdtemp(prefix="adsphere-snap-")
    schema = "person string, tag string, weight double"
    day1 = spark.createDataFrame([("a", "t", 1.0)], schema)
    day2 = spark.createDataFrame([("b", "t", 2.0), ("c", "t", 1.0)], schema)
    snapshots.write_snapshot(day1, root, "TAG", "20240101", keys=["person"])
    snapshots.write_snapshot(day2, root, "TAG", "20240102", keys=["person"])
    snapshots.write_snapshot(day2, root, "TAG", "20240102", keys=["person"])  # rerun is idempotent
    st = day1.schema
    assert snapshots.read_snapshot(spark, root, "TAG", "20240101", st).count() == 1
    assert snapshots.read_snapshot(spark, root, "TAG", "20240102", st).count() == 2
    missing = snapshots.read_snapshot(spark, root, "TAG", "20231231", st)
    assert missing.count() == 0 and missing.schema == st
    assert snapshots.read_snapshot(spark, root, "NOPE", "20240101", st).count() == 0
    assert snapshots.previous_ds("20240301") == "20240229"
    dup = snapshots.duplicate_keys(day2.unionByName(day2), ["person"])
    assert dup.count() == 2
    d = spark.createDataFrame([Row(d="2024-03-01")]).select(F.to_date("d").alias("d"))
    r = d.select(snapshots.day_suffix(F.col("d")).alias("a"),
                 snapshots.previous_day_suffix(F.col("d")).alias("b")).collect()[0]
    assert (r.a, r.b) == ("20240301", "20240229")


def test_json_log_scan(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="adsphere-json-"), "log.json")
    with open(path, "w") as f:
        f.write(json.dumps({"ip": "16.0.0.1", "requestmode": 1, "appname": "x", "age": "20"}) + "\n")
        f.write("{not json\n")
    df = jsonlog.read_json_log(spark, path, keep_corrupt=True).cache()
    assert df.count() == 2
    assert df.where(F.col(jsonlog.CORRUPT).isNotNull()).count() == 1
    from adsphere.plans.ods import full_ods
    ods = full_ods(df.drop(jsonlog.CORRUPT), ip_ranges(spark, SF01))
    assert len(ods.columns) == 89
    r = ods.where("ip is not null").first()
    assert r.province == "P0省" and r.longitude is not None and r.appname == "x"
    assert ods.where("ip is null").first().longitude is None
    assert df.schema["requestmode"].dataType.simpleString() == "bigint"


def test_views_for_sql(spark):
    from adsphere.sources.views import register_views
    from conftest import SF001
    names = register_views(spark, SF001)
    assert "ods" in names
    n = spark.sql("SELECT count(*) FROM ods WHERE ds = '19980701'").collect()[0][0]
    assert n > 0
    assert spark.sql("SELECT count(*) FROM device_dict").collect()[0][0] == 13


def test_text_dictionary_later_key_wins(spark):
    from adsphere.sources.dictionary import read_kv_dictionary
    path = os.path.join(tempfile.mkdtemp(prefix="adsphere-dict-"), "dict.txt")
    with open(path, "w") as f:
        f.write("1##D00010001\nWIFI##D00020001\nbroken line\n1##D00019999\n")
    got = {r.key: r.value for r in read_kv_dictionary(spark, path).collect()}
    assert got == {"1": "D00019999", "WIFI": "D00020001"}


def test_graph_summary(spark):
    from adsphere.operators.components import graph_summary
    e = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c")], "src string, dst string")
    r = graph_summary(e).collect()[0]
    assert (r.nodes, r.edges) == (3, 2)


def test_checked_broadcast_limits(spark):
    from adsphere.operators.joins import checked_broadcast, measure
    df = spark.createDataFrame([("abc", 1), ("de", None)], "s string, n int")
    n, b = measure(df)
    assert n == 2 and b == (3 + 8 + 1 + 8) + (2 + 8 + 0 + 8)
    small = checked_broadcast(df)
    big = checked_broadcast(df, max_bytes=10)
    probe = spark.range(5).selectExpr("cast(id as string) as s")

    def plan(df):
        import contextlib
        import io
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        return buf.getvalue()
    assert "BroadcastHashJoin" in plan(probe.join(small, "s"))
    assert probe.join(big, "s").count() == 0


def test_enrich_edge_cases(spark):
    from adsphere.plans.ods import enrich
    log = spark.createDataFrame(
        [("16.0.0.1", 1), ("40.0.0.1", 2), ("16.0.4.10", 3), ("1.2.3", 4), (None, 5), ("", 6)],
        "ip string, k int")
    got = {r.k: (r.province, r.city) for r in enrich(log, ip_ranges(spark, SF01)).collect()}
    assert got[1] == ("P0省", "C0_0")                 # block 0 of nation 0
    assert got[2] == ("未知国家", "未知国家")          # nation 24 has no ranges
    assert got[3] == ("未知国家", "未知国家")          # offsets 1024-1099 match nothing
    assert got[4] == ("未知国家", "未知国家")          # malformed text
    assert got[5] == (None, None) and got[6] == (None, None)   # no IP: row kept, no location
    assert len(got) == 6


def test_hub_identifier_holding_a_third_of_records(spark):
    # 900 records; every third one carries the same hub id next to its own id
    rows = []
    for i in range(900):
        ids = [f"A{i:04d}"] + (["HUB"] if i % 3 == 0 else [])
        rows.append((ids[0], ids, ["t"]))
    recs = _records(spark, rows).repartition(6)
    tags, ids = person_profile(recs)
    got = {r.person: r.weight for r in tags.collect()}
    # the hub joins 300 records into one person; the other 600 stay alone
    assert got["A0000"] == 300.0
    assert sum(1 for w in got.values() if w == 1.0) == 600
    assert ids.where(F.col("person") == "A0000").count() == 301
