import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from tintflow import session
from tintflow.operators.ordering import CHUNK, across_chunks, cut_into_chunks, frame_ordinals, number_rows, ordered_frames
from tintflow.plans.strips import prefix_scan


@pytest.fixture(scope="module")
def lopsided(spark):
    """One group holds most rows, so that it lies in many chunks."""
    rng = random.Random(7)
    data = [("hot", n) for n in range(900)] + [(f"g{n % 40}", n) for n in range(300)] + [(None, n) for n in range(200)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "g string, n long")


@pytest.mark.parametrize("chunks", [1, 7, 23])
def test_number_rows_equals_window(lopsided, chunks):
    by = Window.partitionBy("g")
    expected = (lopsided.withColumn("row_no", F.row_number().over(by.orderBy("n")).cast("long"))
                .withColumn("all", F.count("*").over(by)))
    found = number_rows(lopsided, ["g"], ["n"], total="all", chunks=chunks)
    assert rows(found, "g", "n", "row_no", "all") == rows(expected)


def test_hot_group_is_split_and_carried_table_is_bounded(lopsided):
    chunked = cut_into_chunks(lopsided, ["g"], ["n"], 12)
    per_chunk = {r[0]: r[1] for r in chunked.groupBy(CHUNK).count().collect()}
    assert max(per_chunk.values()) < 300
    carried = across_chunks(chunked, ["g"], F.count("*").alias("c"))
    assert 0 < carried.count() <= 2 * len(per_chunk)
    assert chunked.filter("g = 'hot'").select(CHUNK).distinct().count() > 5


def test_descending_order(lopsided):
    expected = lopsided.withColumn("row_no", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("n"))).cast("long"))
    assert rows(number_rows(lopsided, ["g"], [F.desc("n")], chunks=9), "g", "n", "row_no") == rows(expected)


def test_frame_ordinals_start(lopsided):
    assert frame_ordinals(lopsided, ["g"], ["n"], first=0, chunks=5).agg(F.min("frame_index")).first()[0] == 0
    assert frame_ordinals(lopsided, ["g"], ["n"], chunks=5).agg(F.min("frame_index")).first()[0] == 1


def test_empty_input(spark):
    assert number_rows(spark.createDataFrame([], "g string, n long"), ["g"], ["n"]).count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_only_hot_keys_are_dealt(spark, how):
    data = [("hot", n) for n in range(300)] + [(f"k{n}", n) for n in range(600)] + [(None, n) for n in range(50)]
    rows_, groups = spark.createDataFrame(data, "k string, n int"), spark.createDataFrame([("hot", 1), ("k3", 2), (None, 3), ("x", 4)], "k string, g int")
    dealt = session.join_on_group(rows_, groups, "k", ["n"], how, salts=8, small=False)
    assert rows(dealt) == rows(rows_.join(groups, "k", how))
    assert rows(session.hot_keys(rows_, ["k"], 8)) == [("hot", True)]


def test_ordered_scans_come_in_order(spark):
    stored = spark.createDataFrame([(f"v{n % 7}", n * 37 % 100) for n in range(300)], "video_key string, frame_index long").repartition(5)
    found = [tuple(r) for r in ordered_frames(stored).collect()]
    assert found == sorted(found) and len(found) == 300
    scanned = [tuple(r) for r in prefix_scan(stored, "video_key", "v1", "frame_index").collect()]
    assert scanned == [r for r in found if r[0] == "v1"]
