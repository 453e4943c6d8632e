"""Plan-level guards: the physical plans keep the properties the design relies on."""

import contextlib
import io

import pytest

import __spark_entry__ as entry
from adsphere.plans.ods import build_ods
from conftest import SF001

FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython")


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", ["ods_build", "ip_geo", "report_region", "report_app", "area_library",
                                  "ods_with_areas", "skew_isolate_join", "skew_expand_join"])
def test_no_forbidden_operators(spark, name):
    p = plan(entry.queries()[name](spark, SF001))
    assert not [op for op in FORBIDDEN if op in p]


def test_range_join_is_a_hash_join_and_the_day_reaches_the_scan(spark):
    p = plan(build_ods(spark, SF001, ["ip", "requestmode"], ds="19980701"))
    assert "BroadcastHashJoin" in p and "LeftOuter" in p
    assert "GreaterThanOrEqual(l_shipdate" in p
    lineitem = [b for b in p.split("\n\n") if "lineitem.parquet" in b][0]
    read = lineitem.split("ReadSchema: struct<")[1].split(">")[0]
    assert len(read.split(",")) <= 3          # only the columns the two outputs need


def test_report_reads_only_its_columns(spark):
    p = plan(entry.queries()["report_province_city"](spark, SF001))
    lineitem = [b for b in p.split("\n\n") if "lineitem.parquet" in b][0]
    assert "ReadSchema: struct<l_orderkey:bigint>" in lineitem
