import pytest
from pyspark.sql import Row

from conftest import assert_matches_oracle
from adsphere.operators.funnel import device_report, funnel_report

REPORTS = ["report_province_city", "report_region", "report_app", "report_device",
           "report_network", "report_operator", "report_channel"]
EXPECTED_ROWS = {"report_province_city": 100, "report_region": 100, "report_app": 1413,
                 "report_device": 125, "report_network": 5, "report_operator": 5,
                 "report_channel": 20}


@pytest.mark.parametrize("name", REPORTS)
def test_report_matches_oracle(spark, duck, name):
    rows = assert_matches_oracle(spark, duck, name)
    assert len(rows) == EXPECTED_ROWS[name]


def _log_row(**kw):
    base = dict(requestmode=1, processnode=1, iseffective=1, isbilling=1, isbid=1, iswin=1,
                adplatformproviderid=100000, adorderid=300000, adcreativeid=300000,
                winprice=1000.0, adpayment=500.0, client=1, device="d")
    base.update(kw)
    return Row(**base)


def test_zero_show_gives_null_click_rate(spark):
    df = spark.createDataFrame([_log_row(requestmode=1)])
    r = funnel_report(df, ["device"]).collect()[0]
    assert r.show_num == 0 and r.click_rat is None
    assert r.bid_num == 1 and r.bid_success_rat == 1.0
    assert r.consumption_number == 1.0 and r.cost_number == 0.5


def test_device_report_keeps_raw_client_groups(spark):
    schema = "requestmode long, processnode long, iseffective long, isbilling long, isbid long, " \
             "iswin long, adplatformproviderid long, adorderid long, adcreativeid long, " \
             "winprice double, adpayment double, client long, device string"
    rows = [_log_row(client=4), _log_row(client=5), _log_row(client=None), _log_row(client=1)]
    out = device_report(spark.createDataFrame(rows, schema)).collect()
    labels = sorted(r.client for r in out)
    assert labels == ["android ", "other", "other", "other"]


def test_one_pass_reports_equal_separate(spark):
    from adsphere.plans.reports import all_reports, reports_one_pass
    from adsphere.sources.adlog import ad_log
    from conftest import SF001, sorted_rows
    ods = ad_log(spark, SF001)
    sep, one = all_reports(ods), reports_one_pass(ods)
    assert set(sep) == set(one)
    for name, df in sep.items():
        got = one[name].select(*df.columns).collect()
        assert sorted_rows(got) == sorted_rows(df.collect()), name
