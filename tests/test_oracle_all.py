"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from conftest import SF001, assert_matches_oracle

from adsphere import catalog  # noqa: E402

NAMES = sorted(catalog.oracle())


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(NAMES)
    assert set(entry.queries()) >= set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck_small, name):
    assert_matches_oracle(spark, duck_small, name, SF001)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "org_num" in df.columns
