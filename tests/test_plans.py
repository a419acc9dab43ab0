"""The plans are those the operators were written for."""

import pytest

from catalog import inputs, registry
from conftest import plan
from tintflow.functions.requests import accepted
from tintflow.operators import color, history, lookup, ordering, sampling
from tintflow.plans.strips import prefix_scan, video_strip

SF = "/root/testdata/sf0.001"
PYTHON = ("MapInPandas", "FlatMapGroupsInPandas", "ArrowEvalPython", "BatchEvalPython")
USES_PYTHON = {"strip_png", "frame_image_scan", "image_pixels", "image_colors",
               "video_ingest", "container_read", "pack_containers", "append_containers", "ingest_videos", "sample_frames_stream"}


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - USES_PYTHON))
def test_no_python_in_the_plan(spark, name):
    text = plan(registry.QUERIES[name](spark, SF))
    assert not any(node in text for node in PYTHON)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_buckets_are_counted_before_the_shuffle(spark):
    wanted = accepted(inputs.color_requests(spark, SF))
    text = plan(color.count_observations(inputs.pixels(spark, SF), wanted, color.derived_sizes(wanted), True))
    lines = [line.strip(" +-:") for line in text.split("\n")]
    # The pixels' only shuffle carries counted levels and buckets.
    shuffles = [k for k, line in enumerate(lines) if line.startswith("Exchange hashpartitioning") and "seen" in line]
    assert len(shuffles) == 1 and ("partial_count" in lines[shuffles[0] + 1])
    assert "BroadcastHashJoin" in text


def test_averages_of_all_sizes_come_from_one_shuffle_of_levels(spark):
    found = color.requested_colors(inputs.pixels(spark, SF), inputs.color_requests(spark, SF).filter("kind = 'average'"))
    exchanged = [line for line in plan(found).split("\n") if "Exchange hashpartitioning" in line]
    assert sum("pixels" in line or "slot" in line for line in exchanged) == 0  # the buckets lie where the levels do
    assert "SortAggregate" not in plan(found)


def test_versions_are_cut_before_the_shuffle(spark):
    text = plan(history.last_versions(inputs.video_blocks(spark, SF), ["video_key"]))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_lookups_are_semi_and_anti_joins(spark):
    asked, blocks = inputs.requests(spark, SF), inputs.video_blocks(spark, SF)
    assert "LeftSemi" in plan(lookup.known_requests(asked, blocks))
    assert "LeftAnti" in plan(lookup.unknown_requests(asked, blocks))


def test_scan_reads_what_the_query_needs(spark, tmp_path):
    path = str(tmp_path / "colors")
    layout = "video_key string, frame_index long, bucket_size int, kind string, r int, g int, b int"
    made = spark.createDataFrame([("http://v", 1, 40, k, 1, 2, 3) for k in ("average", "dominant")], layout)
    history.append_history(made, path, partition_by=history.FRAME_PARTITIONS)
    stored = spark.read.parquet(path)
    assert "StringStartsWith(video_key,http)" in plan(prefix_scan(stored, "video_key", "http", "frame_index"))
    chosen = plan(stored.filter("kind = 'average'").select("r"))
    assert "PartitionFilters: [isnotnull(kind" in chosen and "ReadSchema: struct<r:int>" in chosen
    assert video_strip(stored, kind="average").select("width").distinct().first()[0] == 200


def exchanges(df):
    """The exchanges that the rows of ``df`` go through: those below a broadcast carry the small table."""
    lines, small, found = plan(df).split("\n"), None, []
    for line in lines:
        depth = len(line) - len(line.lstrip(" +-:|"))
        if small is not None and depth > small:
            continue
        small = depth if "BroadcastExchange" in line or "BroadcastQueryStage" in line else None
        if "Exchange " in line and "Broadcast" not in line:
            found.append(line.strip(" +-:"))
    return found


@pytest.mark.parametrize("chunks", [1, 8])
def test_ordered_rows_are_exchanged_once(spark, chunks):
    """With and without groups that are cut, numbering shuffles the rows once; nothing is sorted into ranges."""
    data = spark.range(4000).selectExpr("if(id % 3 = 0, -1, id % 500) as video_key", "0 as stream_index", "id * 977 % 4001 as pts_us", "id as seq")
    numbered = ordering.number_rows(data, ["video_key"], ["pts_us", "seq"], total="n", chunks=chunks)
    found = exchanges(numbered)
    assert len(found) == 1 and "hashpartitioning(video_key" in found[0] and (chunks == 1 or "_chunk" in found[0])
    assert "rangepartitioning" not in plan(numbered)
    assert len(exchanges(sampling.sample_frames(data, interval_us=100, chunks=1))) == 1
    # With a cut group, the windows are written once and only read again.
    assert len(exchanges(sampling.sample_frames(data, interval_us=100, chunks=8))) == 0


def test_only_large_groups_are_cut_and_evenly(spark):
    data = spark.range(9000).selectExpr("if(id % 3 = 0, null, id % 700) as g", "id * 977 % 9001 as n")
    chunked, cut = ordering.cut_hot_groups(data, ["g"], "n", 12)
    sizes = chunked.groupBy("g", ordering.CHUNK).count().collect()
    assert cut and {r["g"] for r in sizes if r[ordering.CHUNK] > 0} == {None}
    pieces = [r["count"] for r in sizes if r["g"] is None]
    assert len(pieces) == 4 and max(pieces) < 900
    edges = chunked.filter("g is null").groupBy(ordering.CHUNK).agg({"n": "max"}).orderBy(ordering.CHUNK).collect()
    assert [r[1] for r in edges] == sorted(r[1] for r in edges)


def test_equal_values_cannot_be_cut(spark):
    data = spark.range(900).selectExpr("1 as g", "5 as n", "id as k")
    found = ordering.number_rows(data, ["g"], ["n", "k"], chunks=9)
    assert [r["row_no"] for r in found.orderBy("k").collect()] == list(range(1, 901))
