"""What a step leaves on the disk: shuffle files and scratch tables go when nothing needs them any more."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from adsphere import session
from adsphere.operators import incremental
from adsphere.operators import tag_agg as ta
from adsphere.plans import tagging
from adsphere.sources.person_store import PersonStore
from conftest import SF001

RECORDS = "main_id string, ids array<string>, tags array<string>"


def scratch_tables(spark):
    """The tables in the scratch folder."""
    root = session.scratch_path(spark, "").replace("file:", "")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def shuffle_files(spark):
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f.getName() for f in spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(local.getAllFiles())
            if f.getName().startswith("shuffle_")}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    table = session.materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "sevens")
    assert not shuffle_files(spark) - before
    assert {r["count"] for r in table.collect()} == {142, 143}
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert spark.conf.get(key) == "false"


def test_scopes_may_be_nested(spark):
    with session.scratch_scope(spark):
        with session.scratch_scope(spark):
            inner = session.materialize(spark.range(3), "inner")
            outer = session.materialize(spark.range(4), "outer", outlives=True)
            paths = [df.inputFiles()[0].replace("file://", "") for df in (inner, outer)]
        assert [os.path.exists(p) for p in paths] == [False, True] and outer.count() == 4
    assert not os.path.exists(paths[1])


def test_records_leave_no_ods(spark):
    before = scratch_tables(spark)
    assert tagging.records_for(spark, SF001).count() > 0
    assert {n.rsplit("-", 1)[0] for n in scratch_tables(spark) - before} == {"tagged-records"}


def test_a_person_store_leaves_no_records(spark):
    before = scratch_tables(spark)
    store = tagging.two_days(spark, SF001)
    assert {n.split("-")[0] for n in scratch_tables(spark) - before} == {"warehouse"}
    assert not store.deltas("TAGS", tagging.TODAY_DS).isEmpty()


@pytest.mark.parametrize("limit", [100, 1])
def test_dealt_tags_are_written_where_they_are(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(ta, "HOT_RECORDS", limit)  # with 1, every person is hot
    rows = [(f"m{i % 40}", [f"m{i % 40}", f"x{i % 20}"], ["a", f"t{i % 3}"]) for i in range(400)] + [(None, [], ["a"])] * 2
    records = session.materialize(spark.createDataFrame(rows, RECORDS), "records")
    store = PersonStore(spark, str(tmp_path), buckets=4)
    before, hints, hint = scratch_tables(spark), [], DataFrame.hint
    monkeypatch.setattr(DataFrame, "hint", lambda df, name, *args: hints.append(name) or hint(df, name, *args))
    incremental.add_day(store, records, "20240101")
    assert scratch_tables(spark) == before
    assert hints.count("rebalance") == (2 if limit == 100 else 3)  # the ids, the merges and the hot persons' tags
    tags = store.deltas("TAGS", "20240101")
    bucket = F.regexp_extract(F.input_file_name(), "bucket=([0-9]+)", 1).cast("int")
    assert tags.where(bucket != store.bucket(F.col("person"), "20240101")).isEmpty()
    got = {(r.person, r.tag): int(r.weight) for r in tags.collect()}
    want = {}
    for main, _, ts in rows:
        p = main and min(main, f"m{int(main[1:]) % 20}", f"m{int(main[1:]) % 20 + 20}")
        for t in ts:
            want[p, t] = want.get((p, t), 0) + 1
    assert tags.count() == len(got) and got == want
