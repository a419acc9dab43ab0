import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tintflow.functions import colour, naming
from tintflow.functions.requests import kind_choice


@pytest.mark.parametrize("index,plain,compat", [
    (9, "0000009", "0000009"), (999, "0000999", "0000999"), (1000, "0001000", "001000"),
    (100000, "0100000", "100000"), (1234567, "1234567", "1234567"), (12345678, "12345678", "12345678")])
def test_padded_index(spark, index, plain, compat):
    row = spark.createDataFrame([(index,)], "i long").select(
        naming.padded_index("i"), naming.padded_index("i", compat=True)).first()
    assert tuple(row) == (plain, compat)


@pytest.mark.parametrize("url,whole,path", [
    ("https://h/a/b/Some_clip.ogg", "Some_clip.ogg", "Some_clip.ogg"),
    ("http://h/a/v.ogg?x=1/2", "2", "v.ogg"), ("http://h/a/", "a", "a"), ("http://h/x.y.ogv#t", "x.y.ogv#t", "x.y.ogv")])
def test_basename(spark, url, whole, path):
    row = spark.createDataFrame([(url,)], "u string").select(
        naming.url_basename("u"), naming.url_basename("u", path_only=True)).first()
    assert tuple(row) == (whole, path)


def test_stem_ends_at_the_first_dot(spark):
    row = spark.createDataFrame([("x.y.ogv", "plain")], "a string, b string").select(
        naming.stem(F.col("a")), naming.stem(F.col("b"))).first()
    assert tuple(row) == ("x", "plain")


@pytest.mark.parametrize("micros,slug", [(0, "2024-05-06-07-08-09-0"), (120000, "2024-05-06-07-08-09-12"),
                                         (7000, "2024-05-06-07-08-09-007")])
def test_slug(spark, micros, slug):
    at = datetime.datetime(2024, 5, 6, 7, 8, 9, micros)
    assert spark.createDataFrame([(at,)], "t timestamp_ntz").select(naming.timestamp_slug("t")).first()[0] == slug


def test_kind(spark):
    kinds = spark.createDataFrame([("average",), ("domiant",), ("dominant",), (None,)], "k string")
    assert [r[0] for r in kinds.select(kind_choice("k")).collect()] == ["average"] + ["dominant"] * 3


@pytest.mark.parametrize("size", [1, 2, 7, 40, 128, 255])
def test_bucket_is_the_lower_bound(spark, size):
    found = spark.range(256).select("id", colour.bucketize("id", size).alias("b")).collect()
    assert all(r["b"] <= r["id"] < r["b"] + size and r["b"] % size == 0 for r in found)


def test_channels_survive_packing(spark):
    levels = spark.range(0, 1 << 24, 9973).selectExpr("cast(id as int) as rgb")
    again = levels.select("rgb", *[c.alias(n) for n, c in colour.unpack_rgb("rgb").items()])
    assert again.filter(colour.pack_rgb() != F.col("rgb")).count() == 0
    alpha = spark.createDataFrame([(-1,)], "rgb int").select(*colour.unpack_rgb("rgb").values()).first()
    assert tuple(alpha) == (255, 255, 255)
