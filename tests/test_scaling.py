"""What keeps large runs cheap: code short enough to be compiled, one shuffle per step, no needless parsing."""

import contextlib
import io
import json
import re

from pyspark.sql import functions as F

import __spark_entry__ as entry
from adsphere.functions.codec import decode_pairs
from adsphere.operators.tag_agg import tags_per_person
from adsphere.plans import profile as pf
from adsphere.session import materialize
from adsphere.sources.jsonlog import parse_json_log
from adsphere.sources.person_store import PersonStore, state
from conftest import SF001

JIT_LIMIT = 8000  # bytes of bytecode beyond which HotSpot leaves a method interpreted


def explained(df, mode="simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def exchanges(df) -> int:
    return len(re.findall(r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", explained(df)))


def test_ods_build_is_compiled(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = re.findall(r"maxMethodCodeSize:(\d+)", explained(entry.queries()["ods_build"](spark, SF001), "codegen"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sizes and max(map(int, sizes)) <= JIT_LIMIT


def test_persons_and_documents_take_one_shuffle_of_the_tags(spark, tmp_path):
    store = PersonStore(spark, str(tmp_path))
    store.write("IDS", spark.createDataFrame([("i1", "p1"), ("i2", "p2")], "id string, person string"), "20240101")
    store.write("TAGS", spark.createDataFrame([("p1", "AT_a"), ("p2", "AT_a"), ("p2", "CN_b")], "person string, tag string")
                .withColumn("weight", F.lit(1).cast("decimal(28,18)")), "20240101")
    store.write("MERGED", spark.createDataFrame([("p2", "p1")], "person string, into string"), "20240102")
    tags, _ = state(store, "20240102", 0.5)
    assert exchanges(tags) == 1  # before a run, whose plan would be printed twice
    assert {(r.person, r.tag): float(r.weight) for r in tags.collect()} == {("p1", "AT_a"): 1.0, ("p1", "CN_b"): 0.5}
    rows = pf.profile_rows(pf.classify_tags(materialize(tags, "t").withColumn("weight", F.col("weight").cast("double"))))
    assert exchanges(rows) == 1
    row = rows.first()
    assert ([tuple(x) for x in row.adType], [tuple(x) for x in row.channel], row.age) == ([("a", 1.0)], [("b", 0.5)], [])


def test_a_person_without_known_tags_keeps_a_document(spark):
    tags = spark.createDataFrame([("p", "??", 1.0), ("q", "AGE_3", 2.0), ("q", "AGE_3", 1.0)], "person string, tag string, weight double")
    docs = {r._id: r for r in pf.document_texts(pf.profile_rows(pf.classify_tags(tags))).collect()}
    assert set(docs["p"][1:]) == {""} and docs["q"].age == "(3,1.0),(3,2.0)"


def test_records_meet_their_label_before_their_tags_are_rows(spark):
    recs = materialize(spark.createDataFrame([("m1", ["a", "b"]), ("m2", ["a"]), ("m3", [])], "main_id string, tags array<string>"), "recs")
    labels = materialize(spark.createDataFrame([("m1", "m0"), ("m2", "m0")], "id string, component string"), "labels")
    out = tags_per_person(recs, labels)
    assert {(r.person, r.tag): int(r.weight) for r in out.collect()} == {("m0", "a"): 2, ("m0", "b"): 1}
    plan = explained(out)
    assert plan.index("Generate explode") < plan.index("Join")  # above the join


def test_only_odd_lines_are_parsed_into_maps(spark):
    lines = ['{"client": 1}', ' {"client": "x"}', '{"client": null, "extra": 2}', '[{"a": 1}]', '"{"', '{"client": 1',
             '{"client": 99999999999999999999}', '{"client": null}', '{"client": 1, "client": 2}', "{}"]
    out = parse_json_log(spark.createDataFrame([(x,) for x in lines], "value string"))
    got = {r.line: (r.client, r.reason, r.j) for r in out.select("line", "client", "reason", F.to_json("rescued").alias("j")).collect()}
    assert got[lines[0]] == (1, None, None) and got[lines[7]] == got[lines[9]] == (None, None, None)
    assert got[lines[1]][:2] == (None, None) and json.loads(got[lines[1]][2]) == {"client": "x"}
    assert json.loads(got[lines[2]][2]) == {"extra": 2} and json.loads(got[lines[6]][2]) == {"client": 99999999999999999999}
    assert [got[lines[i]][1] for i in (3, 4, 5, 8)] == ["not an object", "not an object", "malformed", "malformed"]
    assert "schema_of_variant" not in explained(out, "extended").split("Optimized Logical Plan")[1]


def test_entries_split_at_their_last_comma(spark):
    text = "(a,b,1.5),(,2.0),(x),(y\nz,1e3)"
    got = spark.range(1).select(decode_pairs(F.lit(text)).alias("p")).first().p
    assert [tuple(x) for x in got] == [("a,b", 1.5), ("", 2.0), ("y\nz", 1000.0)]
