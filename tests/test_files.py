import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tintflow.operators import history
from tintflow.plans.analyze import save
from tintflow.session import new_folder
from tintflow.sources import images, files, manifests
from tintflow.sources import requests as request_files


def frames(spark, sizes):
    return spark.createDataFrame([(v, k, f"Frames/{v}/{k}.png") for v, n in sizes.items() for k in range(n)],
                                 "video_key string, frame_no long, path string")


@pytest.mark.parametrize("chunks", [1, 6])
def test_manifest_written_and_read_back(spark, chunks):
    made = frames(spark, {"a": 1, "b": 12, "hot": 500})
    folder = new_folder(spark, "manifests")
    manifests.write_manifests(made, folder)
    found = manifests.read_manifests(spark, folder, per_directory=True, chunks=chunks)
    expected = rows(made.select("video_key", (F.col("frame_no") + 1).alias("line_no"), "path"))
    assert rows(found, "video_key", "line_no", "path") == expected


def test_long_manifest_is_several_files(spark):
    folder = new_folder(spark, "manifests")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifests.write_manifests(frames(spark, {"hot": 3000}), folder)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    place = folder.removeprefix("file:")
    place += "/" + next(name for name in os.listdir(place) if name.startswith("manifest="))
    parts = sorted(os.listdir(place))
    assert len([p for p in parts if p.endswith(".txt")]) > 1
    first = open(place + "/" + [p for p in parts if p.endswith(".txt")][0]).read()
    assert first.split("\n")[:2] == ["hot", "Frames/hot/0.png"]
    found = manifests.read_manifests(spark, folder, per_directory=True, chunks=5)
    assert rows(found, "line_no", "path") == sorted(((k + 1, f"Frames/hot/{k}.png") for k in range(3000)), key=repr)


def test_manifest_files(spark, tmp_path):
    (tmp_path / "one.txt").write_text("http://v/1\nx/Frames/0.png\nother\nx/Frames/1.png\n")
    (tmp_path / "two.txt").write_text("http://v/Frames/2\r\ny/Frames/0.png")
    (tmp_path / "key-only.txt").write_text("http://v/3\n")
    found = manifests.read_manifests(spark, str(tmp_path))
    assert rows(found, "video_key", "line_no", "path") == [
        ("http://v/1", 1, "x/Frames/0.png"), ("http://v/1", 2, "other"), ("http://v/1", 3, "x/Frames/1.png"),
        ("http://v/Frames/2", 1, "y/Frames/0.png")]


def test_request_files(spark, tmp_path):
    (tmp_path / "form.txt").write_text("getVideoRecord\nhttp://v/a.ogg\n1\naverage\n")
    (tmp_path / "sampled.txt").write_text("1\nhttp://v/a.ogg\na\naverage")
    form = request_files.read_requests(spark, str(tmp_path / "form.txt")).first()
    assert tuple(form) == ("getVideoRecord", "http://v/a.ogg", "1", "average")
    sampled = request_files.read_requests(spark, str(tmp_path / "sampled.txt"), "sampled")
    assert rows(sampled, "video_key", "bucket_size", "kind") == [("http://v/a.ogg", "1", "average")]
    short = request_files.parse_requests(spark.createDataFrame([("getVideoRecord\nu",)], "value string")).first()
    assert short["kind"] is None


def test_videos_and_latest_file(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name, size, at in (("a.ogg", 3, 100), ("b.ogg", 5, 200), ("c.ogg", 2, 200), ("sub/d.ogg", 7, 900)):
        (tmp_path / name).write_bytes(b"x" * size)
        os.utime(tmp_path / name, (at, at))
    videos = files.read_videos(spark, str(tmp_path))
    assert rows(videos, "name", "size") == [("a.ogg", 3), ("b.ogg", 5), ("c.ogg", 2), ("d.ogg", 7)]
    assert {r["name"]: bytes(r["content"]) for r in videos.collect()}["b.ogg"] == b"xxxxx"
    assert files.latest_file(files.list_files(spark, str(tmp_path))).first()["path"].endswith("d.ogg")
    top = files.latest_file(files.list_files(spark, str(tmp_path), recursive=False)).first()
    assert top["path"].endswith("b.ogg") and top["modified_us"] == 200_000_000
    assert files.latest_file(files.list_files(spark, str(tmp_path)).filter("path = ''")).count() == 0


def test_metadata_history(spark):
    path = new_folder(spark, "vmd")
    layout = ("video_key string, name string, hyperlink string, path string, byte_offset long, filesize long, "
              "recorded_at timestamp, seq long")
    batch = spark.createDataFrame([("v", "a", "l", "p0", 0, 5, None, 1)], layout)
    for seq, place, size in ((1, "p0", 5), (2, "p1", None)):
        history.upsert_video_metadata(
            batch.withColumn("seq", F.lit(seq).cast("long")).withColumn("path", F.lit(place))
            .withColumn("filesize", F.lit(size).cast("long"))
            .withColumn("recorded_at", F.lit("2020-01-01").cast("timestamp")), path)
    assert rows(history.read_video_metadata(spark, path), "video_key", "path", "filesize") == [("v", "p1", 5)]


def test_frame_colors_keep_bucket_sizes_apart(spark):
    colors, blocks = new_folder(spark, "colors"), new_folder(spark, "blocks")
    layout = "video_key string, frame_index long, bucket_size int, kind string, r int, g int, b int"
    for value in (1, 2):
        save(spark.createDataFrame([("v", 1, 40, "average", value, 0, 0), ("v", 1, 10, "average", 9, 0, 0)], layout),
             colors, blocks)
    found = history.read_frame_colors(spark, colors)
    assert rows(found, "bucket_size", "r") == [(10, 9), (40, 2)]
    assert rows(spark.read.parquet(blocks).select("bucket_size").distinct()) == [(10,), (40,)]


def test_replaced_partitions_leave_others(spark):
    path = new_folder(spark, "colors")
    layout = "video_key string, frame_index long, bucket_size int, kind string, r int"
    history.replace_partitions(spark.createDataFrame(
        [("v", 1, 40, "average", 1), ("v", 2, 40, "average", 1), ("v", 1, 10, "average", 1)], layout),
        path, partition_by=history.FRAME_PARTITIONS)
    history.replace_partitions(spark.createDataFrame([("v", 1, 40, "average", 7)], layout), path,
                               partition_by=history.FRAME_PARTITIONS)
    assert rows(spark.read.parquet(path), "frame_index", "bucket_size", "r") == [(1, 10, 1), (1, 40, 7)]


def test_triples_of_each_kind_come_from_their_own_text(spark):
    found = history.split_addressed_triples(
        spark.createDataFrame([(1, "1;2;3", "4;5;6")], "frame_index int, average string, dominant string"))
    assert rows(found, "kind", "r", "g", "b") == [("average", 1, 2, 3), ("dominant", 4, 5, 6)]


def test_kept_versions(spark):
    writes = spark.range(1000).selectExpr("if(id < 900, 'hot', concat('k', id % 10)) as video_key",
                                          "cast(id as timestamp) as recorded_at", "id as seq")
    kept = history.last_versions(writes, ["video_key"])
    assert rows(kept.groupBy("video_key").count().filter("video_key = 'hot'"), "count") == [(20,)]
    assert kept.filter("video_key = 'hot'").agg(F.min("seq")).first()[0] == 880


def test_writing_manifests_leaves_those_of_other_videos(spark):
    folder, long = new_folder(spark, "manifests"), "http://v/" + "x" * 300
    manifests.write_manifests(frames(spark, {"a": 3, long: 2}), folder)
    manifests.write_manifests(frames(spark, {"b": 2}), folder)
    manifests.write_manifests(frames(spark, {"a": 1}), folder)
    found = rows(manifests.read_manifests(spark, folder, per_directory=True).groupBy("video_key").count())
    assert found == sorted([("a", 1), ("b", 2), (long, 2)])


@pytest.mark.parametrize("location", ["/u/Frames/a.png", "file:/u/Frames/a.png", "file:///u/Frames/a.png", "hdfs://nn:8020/u/Frames/a.png",
                                      "s3a://bucket/u/Frames/a.png"])
def test_locations_share_their_path(spark, location):
    assert rows(spark.createDataFrame([(location,)], "path string").select(images.path_only("path"))) == [("/u/Frames/a.png",)]
