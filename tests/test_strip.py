import pytest
from pyspark.sql import functions as F

from conftest import rows
from tintflow.operators.strip import color_strip, explode_range, gradient, strip_raster, strip_scale
from tintflow.plans.strips import prefix_scan, video_strip

FRAME = "video_key string, bucket_size int, kind string, frame_index long, r int, g int, b int"


def video(n, key="v"):
    return [(key, 40, "dominant", k + 1, k, 0, 255) for k in range(n)]


@pytest.mark.parametrize("frames,width,height", [
    (1, 200, 200), (4, 800, 200), (5, 1000, 200), (7, 1400, 200), (8, 1280, 320), (11, 1760, 320), (12, 1920, 480),
    (16, 2560, 640), (17, 17, 4)])
def test_sizes(spark, frames, width, height):
    found = strip_scale(color_strip(spark.createDataFrame(video(frames), FRAME), chunks=3))
    assert rows(found, "width", "height") == [(width, height)] * width
    scale = width // frames
    assert rows(found.filter("x = 0"), "rgb") == [(255,)]
    assert sorted(r[0] for r in rows(found, "x")) == list(range(width))
    assert {(x // scale << 16) | 255 for x in range(width)} == {r[0] for r in rows(found, "rgb")}


def test_no_frames_no_strip(spark):
    assert color_strip(spark.createDataFrame([], FRAME)).count() == 0


@pytest.mark.parametrize("chunks", [1, 5])
def test_incomplete_frames_leave_a_black_tail(spark, chunks):
    frames = [("v", 40, "average", k, k, k if k % 3 else None, 0) for k in range(1, 31)]
    found = color_strip(spark.createDataFrame(frames, FRAME), chunks=chunks)
    complete = [(k << 16) | (k << 8) for k in range(1, 31) if k % 3]
    assert [r[1] for r in sorted(rows(found, "x", "rgb"))] == complete + [0] * 10
    assert rows(found.select("width", "height").distinct()) == [(30, 7)]


def test_keys_that_begin_alike_are_separate(spark):
    frames = spark.createDataFrame(video(20, "http://v/a") + video(24, "http://v/ab"), FRAME)
    assert rows(video_strip(frames, video_key="http://v/a").select("width").distinct()) == [(20,)]
    assert prefix_scan(frames, "video_key", "http://v/a", "frame_index").count() == 44
    assert video_strip(frames, kind="average").count() == 0


def test_raster_rows_repeat(spark):
    found = strip_raster(color_strip(spark.createDataFrame(video(20), FRAME)))
    assert found.count() == 20 * 5
    assert rows(found.groupBy("x").agg(F.count_distinct("rgb").alias("c")).select("c").distinct()) == [(1,)]


def test_explode_range_in_runs(spark):
    counts = spark.createDataFrame([("a", 1), ("b", 10), ("c", 11)], "k string, n int")
    found = explode_range(counts, "i", "n", run=5)
    assert rows(found, "k", "i") == sorted([(k, i) for k, n in (("a", 1), ("b", 10), ("c", 11)) for i in range(n)], key=repr)


def test_gradient_of_the_documented_size(spark):
    found = gradient(spark.createDataFrame([(400, 100)], "width int, height int"))
    assert found.count() == 40_000
    corner = rows(found.filter("x = 399 and y in (0, 99)"), "r", "g", "b", "rgb")
    assert corner == [(0, 255, 128, 65408), (255, 255, 128, 16777088)]
    assert rows(found.filter("x = 200 and y = 50"), "r", "g") == [(128, 127)]
