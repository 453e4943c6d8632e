"""Records are dealt by their key before their tags become rows: one shuffle of short texts instead of one of long rows."""

import collections
import re

import pytest
from pyspark.sql import functions as F

from adsphere.operators import tag_agg as ta
from adsphere.session import materialize
from test_scaling import explained

TAGS = {"m1": [["a", "b"], ["a", "b"], ["a"]], "m2": [["a\x01b", "c"], ["\x01"], [""], ["", ""], [None], ["x", None], []], None: [["n"], ["n"]]}


@pytest.fixture
def records(spark):
    rows = [(k, tags) for k, lists in TAGS.items() for tags in lists]
    return materialize(spark.createDataFrame(rows, "main_id string, tags array<string>"), "records")


def expected():
    return collections.Counter((k, t) for k, lists in TAGS.items() for tags in lists for t in tags)


@pytest.mark.parametrize("limit", [10, 2])
def test_tags_of_records_are_counted(records, monkeypatch, limit):
    monkeypatch.setattr(ta, "HOT_RECORDS", limit)  # with 2, m1 and m2 are hot
    out = ta.tags_per_main_record(records)
    rows = [((r.main_id, r.tag), r.n) for r in out.collect()]
    assert len(rows) == len(dict(rows)) and dict(rows) == expected()
    assert out.columns == ["main_id", "tag", "n"] and [t for _, t in out.dtypes] == ["string", "string", "bigint"]


def test_long_rows_are_not_shuffled(records):
    plan = explained(ta.tags_per_main_record(records))
    # above the only exchange of the rows, with the sums in the same tasks
    assert len(re.findall("Exchange", plan)) == 1 and plan.index("Generate explode") < plan.index("Exchange")


@pytest.mark.parametrize("limit", [10, 2])
def test_tags_of_persons_are_counted(spark, records, monkeypatch, limit):
    monkeypatch.setattr(ta, "HOT_RECORDS", limit)
    labels = materialize(spark.createDataFrame([("m1", "p"), ("m2", "p")], "id string, component string"), "labels")
    out = ta.tags_per_person(records, labels)
    rows = [((r.person, r.tag), int(r.weight)) for r in out.collect()]
    want = collections.Counter()
    for (k, t), n in expected().items():
        want[k and "p", t] += n
    assert len(rows) == len(dict(rows)) and dict(rows) == want
    assert dict(out.dtypes)["weight"] == ta.WEIGHT
