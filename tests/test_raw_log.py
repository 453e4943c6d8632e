"""Rescue and quarantine of log lines, keyed inserts, the tag text, SQL functions, document feeds."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adsphere.functions.codec import decode_pairs, encode_pairs, malformed_entries
from adsphere.functions.geo import geohash8
from adsphere.functions.ip import ip_to_number
from adsphere.functions.sql import register_functions
from adsphere.plans.feed import apply_feed, change_feed
from adsphere.session import materialize
from adsphere.sources.jsonlog import AD_LOG_FIELDS, read_json_lines
from adsphere.sources.keyed import insert_keyed, runtime_filter, stored_hits


def test_lines_are_records_or_quarantined(spark, tmp_path):
    lines = ['{"ip":"1.2.3.4","client":2,"new":{"a":[1,2]},"other":null}', '{"client":"many","sex":"f"}', "{broken", "[1,2]", "7",
             '"text"', "null", "", "   ", '{"ip":null}', "{}", '{"winprice":1}', '{"client":3,"client":4}']
    (tmp_path / "log.json").write_text("\n".join(lines) + "\n")
    df = read_json_lines(spark, str(tmp_path))
    assert df.columns == [n for n, _ in AD_LOG_FIELDS] + ["rescued", "reason", "line"]
    got = {r.line: r for r in df.select("line", "reason", "ip", "client", "sex", "winprice", F.to_json("rescued").alias("rescued")).collect()}
    assert len(got) == len(lines) - 2
    assert {k: r.reason for k, r in got.items() if r.reason} == {
        "{broken": "malformed", "[1,2]": "not an object", "7": "not an object", '"text"': "not an object", "null": "not an object",
        '{"client":3,"client":4}': "malformed"}
    first, second = got[lines[0]], got[lines[1]]
    assert first.ip == "1.2.3.4" and first.client == 2 and json.loads(first.rescued) == {"new": {"a": [1, 2]}}
    assert second.client is None and second.sex == "f" and json.loads(second.rescued) == {"client": "many"}
    assert got['{"winprice":1}'].winprice == 1.0 and all(got[x].rescued is None for x in ('{"ip":null}', "{}", '{"winprice":1}'))


def outcome(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_keyed_insert(spark, tmp_path):
    schema = "k string, j long, v string"
    one = [("a", 1, "y"), ("a", 1, "x"), ("a", 1, "x"), ("a", 2, None), ("b", 1, None), ("b", 1, "z"), (None, 1, "n"), (None, 1, "n"), ("c", None, "n")]
    two = [("a", 1, "later"), ("d", 4, "new"), ("b", 1, None)]
    root = str(tmp_path)
    accepted, rejected = insert_keyed(spark.createDataFrame(one, schema), root, "T", "20240101", ["k", "j"])
    assert outcome(accepted) == [("a", 1, "x"), ("a", 2, None), ("b", 1, None)]
    assert outcome(rejected) == sorted([("a", 1, "x", "repeated key", 1), ("a", 1, "y", "repeated key", 1), ("b", 1, "z", "repeated key", 1),
                                        (None, 1, "n", "null key", 2), ("c", None, "n", "null key", 1)], key=str)
    accepted, rejected = insert_keyed(spark.createDataFrame(two, schema), root, "T", "20240101", ["k", "j"])
    assert outcome(accepted) == [("d", 4, "new")]
    assert outcome(rejected) == [("a", 1, "later", "stored key", 1), ("b", 1, None, "stored key", 1)]
    stored = spark.read.schema(schema + ", ds string").parquet(f"{root}/T")
    assert outcome(stored.drop("ds")) == sorted([("a", 1, "x"), ("a", 2, None), ("b", 1, None), ("d", 4, "new")], key=str)
    assert spark.read.parquet(f"{root}/T_rejects").where("ds = '20240101'").agg(F.sum("n")).first()[0] == 8
    # another day holds no keys yet, and a table of keys alone works as well
    accepted, rejected = insert_keyed(spark.createDataFrame([("a",), ("a",)], "k string"), root, "K", "20240102", ["k"])
    assert outcome(accepted) == [("a",)] and outcome(rejected) == [("a", "repeated key", 1)]


def test_stored_day_is_filtered_by_the_batch(spark, tmp_path):
    day = spark.range(100_000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    day.write.parquet(str(tmp_path / "day"))
    batch = materialize(spark.range(0, 200_000, 5000).select(F.col("id").alias("k")), "batch")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    with runtime_filter(spark):
        hits = stored_hits(spark.read.parquet(str(tmp_path / "day")), batch, ["k"])
        plan = hits._jdf.queryExecution().executedPlan().toString()
        assert hits.count() == 20
    assert "might_contain" in plan and "bloom_filter_agg" in plan
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == before


TAG = st.text(alphabet=st.sampled_from(list("a9\\n),(s\n\r ,")), max_size=8)


def test_any_tag_comes_back_from_its_text(spark):
    tags = []

    @settings(max_examples=300, deadline=None, database=None)
    @given(st.lists(TAG, min_size=1, max_size=4, unique=True))
    def collect(some):
        tags.append(some)
    collect()
    tags += [["KW_a\nb", "KW_c),(d", "x\\", "\\),(", "),(", "(", ")", ","]]
    df = spark.createDataFrame([(i, [(t, 1.5) for t in some]) for i, some in enumerate(tags)],
                               "i int, p array<struct<tag string, weight double>>")
    rows = df.select("p", encode_pairs(F.col("p")).alias("t")).select("p", "t", decode_pairs(F.col("t")).alias("q"), malformed_entries(F.col("t")).alias("bad"))
    for r in rows.collect():
        assert sorted(r.p) == sorted(r.q) and r.bad == 0 and "\n" not in r.t


def test_sql_functions_equal_the_columns_and_run_no_python(spark):
    assert register_functions(spark) == ["geohash8", "ip_number", "ip_text", "salt", "unsalt"]
    rows = [(57.64911, 10.40744, "1.2.3.4"), (90.0, 180.0, "255.255.255.255"), (-90.0, -180.0, "256.1.1.1"), (None, 1.0, "1.2.3"), (0.0, 0.0, None)]
    df = spark.createDataFrame(rows, "latitude double, longitude double, ip string")
    got = spark.sql("SELECT geohash8(latitude, longitude) AS g, ip_number(ip) AS n, ip_text(ip_number(ip)) AS t, "
                    "unsalt(salt(CAST(latitude AS BIGINT), 7, 'a@b')) AS u, salt(5, 3, 'k') = salt(5, 3, 'k') AS same FROM {df}", df=df)
    want = df.select(geohash8(F.col("latitude"), F.col("longitude")).alias("g"), ip_to_number(F.col("ip")).alias("n"))
    assert [r[:2] for r in got.collect()] == [tuple(r) for r in want.collect()]
    assert got.first().g == "u4pruydq" and [r.t for r in got.collect()] == ["1.2.3.4", "255.255.255.255", None, None, None]
    assert [r.u for r in got.collect()] == ["a@b"] * 5 and got.where("same").count() == 5
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "geohash8(" not in plan


def test_feed_leads_from_one_day_to_the_next(spark):
    def docs(d):
        return spark.createDataFrame(list(d.items()), "_id string, doc string")
    days = [{}, {"a": "1", "b": "2", "c": "3"}, {"a": "1", "b": "9", "d": "4"}, {}]
    state = docs(days[0])
    for before, after in zip(days, days[1:], strict=False):
        feed = change_feed(docs(before), docs(after))
        ops = {r._id: r.op for r in feed.collect()}
        assert ops == {k: "insert" if k not in before else "delete" if k not in after else "update"
                       for k in {*before, *after} if before.get(k) != after.get(k)}
        state = apply_feed(state, feed)
        assert {r._id: r.doc for r in state.collect()} == after
