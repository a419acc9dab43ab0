"""Stored files of any size: ranges, digests and containers."""

import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from tintflow.operators.packing import pack_containers
from tintflow.session import new_folder
from tintflow.sources import files, ranges


def digest(content, size):
    parts = [content[at:at + size] for at in range(0, max(len(content), 1), size)]
    return hashlib.sha256("".join(hashlib.sha256(p).hexdigest() for p in parts).encode()).hexdigest()


@pytest.fixture(scope="module")
def stored(tmp_path_factory):
    rng, folder = random.Random(4), tmp_path_factory.mktemp("videos")
    contents = {"large.mp4": rng.randbytes(300_000), "exact.mp4": rng.randbytes(4096), "one.mp4": b"x", "a%20b ü.mp4": rng.randbytes(1025)}
    (folder / "deeper").mkdir()
    for name, content in contents.items():
        (folder / "deeper" / name).write_bytes(content)
    return str(folder), contents


@pytest.mark.parametrize("size", [1024, 1000, 1 << 20])
def test_files_in_ranges(spark, stored, size):
    folder, contents = stored
    found = ranges.read_files(spark, folder, range_bytes=size)
    assert rows(found, "name", "bytes", "ranges", "digest") == sorted(
        (n, len(c), max(1, -(-len(c) // size)), digest(c, size)) for n, c in contents.items())


def test_listing_opens_no_file_and_deals_the_ranges(spark, stored):
    folder, contents = stored
    listed = ranges.list_ranges(spark, folder, range_bytes=1024, tasks=7)
    assert "content" not in plan(listed) and listed.rdd.getNumPartitions() == 7
    per_task = listed.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) == 7 and max(r["count"] for r in per_task) < 80
    spans = listed.filter("name = 'large.mp4'").orderBy("part").select("offset", "length").collect()
    assert [r["offset"] for r in spans] == list(range(0, 300_000, 1024)) and sum(r["length"] for r in spans) == 300_000


def test_a_task_holds_a_piece(stored, monkeypatch):
    folder, contents = stored
    monkeypatch.setattr(ranges, "PIECE", 1000)
    pieces = list(ranges.stream(f"{folder}/deeper/large.mp4", 500, 250_000))
    assert max(map(len, pieces)) == 1000 and b"".join(pieces) == contents["large.mp4"][500:250_500]
    assert list(ranges.stream(f"file:{folder}/deeper/one.mp4", 0, 0)) == []
    with pytest.raises(EOFError):
        list(ranges.stream(f"file://{folder}/deeper/one.mp4", 0, 2))


def test_rows_without_bytes_and_files_that_are_replaced(spark):
    folder = new_folder(spark, "joined")
    first = spark.createDataFrame([("a", 1, bytearray(b"old")), ("b", 1, None)], "name string, seq int, content binary")
    assert rows(ranges.write_joined(first, folder, order=["seq"]), "name", "bytes", "rows") == [("a", 3, 1), ("b", 0, 1)]
    parts = [("a", n, bytearray(bytes([n]) * 100) if n % 3 else None) for n in range(200)] + [("c", 0, bytearray())]
    again = spark.createDataFrame(parts, "name string, seq int, content binary").repartition(5)
    assert rows(ranges.write_joined(again, folder, order=["seq"]), "name", "bytes", "rows") == [("a", 13_300, 200), ("c", 0, 1)]
    place = folder.removeprefix("file:")
    assert sorted(n for n in os.listdir(place) if not n.startswith(".")) == ["a", "b", "c"]
    assert open(f"{place}/a", "rb").read() == b"".join(bytes([n]) * 100 for n in range(200) if n % 3)


def test_containers_are_filled_and_read_back(spark, stored):
    """Files are placed, their containers written, and each file read back from its place."""
    folder, contents = stored
    listed = files.read_videos(spark, folder, with_content=False)
    placed = pack_containers(listed.selectExpr("'videos' as volume", "video_key as source", "size", "name as seq"), cap=4_200)
    placed = placed.withColumn("name", F.format_string("video_%d.mp4", "container_id"))
    out = new_folder(spark, "containers")
    sizes = placed.groupBy("name").agg(F.sum("size").alias("bytes"))
    assert rows(ranges.fill_containers(placed, out), "name", "bytes") == rows(sizes)
    places = placed.withColumn("path", F.concat(F.lit(out + "/"), "name"))
    found = ranges.fold_ranges(ranges.range_digests(ranges.split_ranges(places, range_bytes=999)), ["seq"])
    assert rows(found, "seq", "bytes", "digest") == sorted((n, len(c), digest(c, 999)) for n, c in contents.items())


def test_no_file(spark, tmp_path):
    empty = spark.createDataFrame([], "path string, name string, size long")
    assert ranges.fold_ranges(ranges.range_digests(ranges.split_ranges(empty)), ["path"]).collect() == []
    assert ranges.write_joined(spark.createDataFrame([], "name string, seq int, content binary"), new_folder(spark, "none"), order=["seq"]).collect() == []
