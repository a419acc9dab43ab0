"""Every registered query equals its SQL on the smallest tables."""

import pytest

import check
from __spark_entry__ import entry
from catalog.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, name):
    text, good = check.compare(spark, name, SF)
    assert good, text


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    found = entry(spark)
    assert found.columns == ["video_key", "bucket_size", "kind", "x", "rgb", "width", "height"]
    assert found.count() > 0
