import pytest

from conftest import plan, rows
from tintflow.operators import color, lookup
from tintflow.operators.history import read_frame_colors, read_video_metadata
from tintflow.plans import analyze as analyze_plan
from tintflow.plans import store
from tintflow.plans.analyze import analyze, save
from tintflow.schemas import VIDEO_METADATA

SECOND = 1_000_000


@pytest.fixture
def tables(spark):
    """``seen`` was analysed at 40, ``known`` has only metadata, ``new`` has none; each has 4 pictures 6 s apart."""
    keys = ("seen", "known", "new", "idle")
    events = [(k, n % 2, n // 2 * 6 * SECOND, n) for k in keys for n in range(8)]
    return {
        "requests": spark.createDataFrame(
            [("seen", "40", "average"), ("known", "40", "dominant"), ("new", "10", "average"), ("new", "0", "average")],
            "video_key string, bucket_size string, kind string"),
        "videos": spark.createDataFrame([("seen",), ("known",)], "video_key string"),
        "blocks": spark.sql("select 'seen' as video_key, 40 as bucket_size, 'average' as kind, timestamp'2020-01-01' as recorded_at, 1L as seq"),
        "events": spark.createDataFrame(events, "video_key string, stream_index int, pts_us long, seq long"),
        "pixels": spark.createDataFrame(
            [(k, n, n * 10 + p, 5, 250) for k, _, _, n in events for p in range(3)],
            "video_key string, seq long, r int, g int, b int"),
        "stored": spark.createDataFrame(
            [("seen", n, 40, "average", 9, 9, n) for n in range(1, 18)] + [("seen", 1, 10, "average", 1, 1, 1)],
            "video_key string, frame_index long, bucket_size int, kind string, r int, g int, b int"),
    }


def test_routes_and_results(tables):
    done = analyze(**tables)
    assert rows(done.routed) == [("known", 40, "dominant", "analyze"), ("new", 10, "average", "ingest"),
                                 ("seen", 40, "average", "show")]
    assert rows(done.fresh.filter("video_key = 'known'"), "frame_index", "r", "g", "b") == [
        (1, 0, 0, 240), (2, 0, 0, 240), (3, 40, 0, 240), (4, 40, 0, 240)]
    assert {r[0] for r in rows(done.fresh, "video_key")} == {"known", "new"}
    strips = rows(done.strips.groupBy("video_key", "width", "height").count())
    assert strips == [("known", 800, 200, 800), ("new", 800, 200, 800), ("seen", 17, 4, 17)]


def test_forced_analysis_replaces_stored_colors(tables):
    done = analyze(**tables, force=True)
    assert rows(done.routed, "video_key", "action") == [("known", "analyze"), ("new", "ingest"), ("seen", "analyze")]
    assert rows(done.strips.groupBy("video_key", "width").count()) == [
        ("known", 800, 800), ("new", 800, 800), ("seen", 800, 800)]


def test_all_streams(tables):
    done = analyze(**tables, first_stream_only=False)
    # Two pictures at each time: the first closes the open deadline, the second comes before the next one.
    assert done.fresh.filter("video_key = 'known'").count() == 4


def test_the_other_kind_is_computed_and_shown(spark, tables):
    asked = [("seen", "40", "dominant"), ("seen", "40", "average"), ("seen", "10", "average")]
    tables["requests"] = spark.createDataFrame(asked, "video_key string, bucket_size string, kind string")
    done = analyze(**tables)
    # Colours at 10 are stored, but no block record says that they are complete.
    assert rows(done.routed) == [("seen", 10, "average", "analyze"), ("seen", 40, "average", "show"), ("seen", 40, "dominant", "analyze")]
    assert rows(done.strips.select("bucket_size", "kind").distinct()) == [(10, "average"), (40, "average"), (40, "dominant")]


def test_blocks_without_colours_are_computed_again(spark, tables):
    done = analyze(**{**tables, "stored": tables["stored"].filter("video_key = 'none'")})
    assert rows(done.routed.filter("video_key = 'seen'"), "action") == [("analyze",)]
    assert done.strips.filter("video_key = 'seen'").count() > 0


def test_every_request_ends_in_a_strip_or_a_reason(spark, tables):
    tables["requests"] = spark.createDataFrame(
        [(k, s, "average") for k in ("seen", "known", "new", "no pictures") for s in ("40", "41")], "video_key string, bucket_size string, kind string")
    done = analyze(**tables)
    asked = {r[:3] for r in rows(done.routed)}
    drawn = {r for r in rows(done.strips, "video_key", "bucket_size", "kind")}
    without = {r for r in rows(done.unserved, "video_key", "bucket_size", "kind")}
    assert drawn | without == asked and not drawn & without and {r[0] for r in without} == {"no pictures"}
    assert {r[0] for r in rows(done.unserved, "reason")} == {"no usable picture"}


def test_second_run_shows_all_and_a_shorter_rerun_leaves_no_stale_frame(spark, tables, tmp_path):
    colors, blocks, metadata = (str(tmp_path / n) for n in ("colors", "blocks", "metadata"))
    keys = [("seen",), ("known",), ("new",)]
    arrivals = spark.createDataFrame([(k, k, 10, 1) for k, in keys * 2], "video_key string, name string, size long, at long").selectExpr(
        "video_key", "name", "size", "timestamp_seconds(at) as recorded_at")
    none = {"videos": spark.createDataFrame([], VIDEO_METADATA), "blocks": tables["blocks"].filter("false"), "stored": tables["stored"].filter("false")}
    first = analyze(**{**tables, **none}, arrivals=arrivals)
    assert rows(first.routed, "action") == [("ingest",)] * 3
    save(first.fresh, colors, blocks, ingested=first.ingested, metadata_path=metadata)

    def again(**more):
        return analyze(**{**tables, "videos": read_video_metadata(spark, metadata), "blocks": spark.read.parquet(blocks),
                          "stored": read_frame_colors(spark, colors).drop("recorded_at", "seq")} | more.pop("tables", {}), **more)

    second = again(arrivals=arrivals)
    assert rows(second.routed, "action") == [("show",)] * 3 and second.fresh.count() == 0 and second.ingested.count() == 0
    assert rows(second.strips) == rows(first.strips)
    shorter = again(force=True, tables={"events": tables["events"].filter("seq < 4")})
    save(shorter.fresh, colors, blocks)
    assert rows(again().strips) == rows(shorter.strips) != rows(first.strips)
    assert rows(read_video_metadata(spark, metadata), "video_key") == sorted(keys)


def test_a_run_that_ends_before_its_record_is_not_seen(spark, tables, tmp_path, monkeypatch):
    folder = str(tmp_path / "store")
    given = {k: tables[k] for k in ("requests", "events", "pixels")}
    arrivals = spark.createDataFrame([(k, k, 10, 1) for k in ("seen", "known", "new")], "video_key string, name string, size long, at long").selectExpr(
        "video_key", "name", "size", "timestamp_seconds(at) as recorded_at")
    empty = store.load(spark, folder)
    assert [t.count() for t in empty.values()] == [0, 0, 0]
    fewer = {**given, "events": tables["events"].filter("seq < 4")}

    def stopped(*_, **__):
        raise InterruptedError

    # The very first run ends between its colours and its records: videos are known, nothing counts as analysed.
    first = analyze(**given, **empty, arrivals=arrivals)
    with monkeypatch.context() as patch:
        patch.setattr(analyze_plan, "append_history", stopped)
        with pytest.raises(InterruptedError):
            store.commit(first, folder)
    half = store.load(spark, folder)
    assert half["stored"].count() == 0 and half["blocks"].count() == 0
    again = analyze(**given, **half, arrivals=arrivals)
    assert rows(again.routed, "action") == [("analyze",)] * 3 and again.ingested.count() == 0
    store.commit(again, folder)

    # A later one ends there too: the run before it is still shown, whole.
    shorter = analyze(**fewer, **store.load(spark, folder), force=True)
    with monkeypatch.context() as patch:
        patch.setattr(analyze_plan, "append_history", stopped)
        with pytest.raises(InterruptedError):
            store.commit(shorter, folder)
    shown = analyze(**given, **store.load(spark, folder))
    assert rows(shown.routed, "action") == [("show",)] * 3
    assert rows(shown.strips) == rows(again.strips) != rows(shorter.strips)

    # Stored whole, it replaces them.
    store.commit(shorter, folder)
    assert rows(analyze(**given, **store.load(spark, folder)).strips) == rows(shorter.strips)


@pytest.mark.parametrize("kind", ["long", "int", "string"])
def test_key_filter_drops_nothing_that_is_wanted(spark, kind):
    wanted = spark.range(0, 3000, 7).selectExpr(f"cast(id as {kind}) as video_key").unionByName(
        spark.sql(f"select cast(null as {kind}) as video_key"))
    history = spark.range(30000).selectExpr(f"cast(id % 10000 as {kind}) as video_key", "id as _word", "id as seq", "id as bits")
    found = lookup.may_be_wanted(history, wanted, lookup.key_bits(wanted))
    assert found.columns == history.columns
    kept = {r[0] for r in rows(found, "seq")}
    right = {n for n in range(30000) if n % 10000 % 7 == 0 and n % 10000 < 3000}
    assert right <= kept and len(kept - right) < 30
    shown = plan(found)
    assert "BroadcastHashJoin" in shown and "SortMergeJoin" not in shown


def test_key_filter_of_unlike_keys_and_of_no_keys(spark):
    history = spark.createDataFrame([("5",), ("05",), (None,)], "video_key string")
    numbers = spark.createDataFrame([(5,)], "video_key long")
    assert lookup.may_be_wanted(history, numbers, lookup.key_bits(numbers)).count() == 3
    none = history.filter("false")
    assert lookup.may_be_wanted(history, none, lookup.key_bits(none)).count() == 0


def test_pixels_are_weighed_once_where_many_pictures_become_frames(spark, monkeypatch):
    pixels = spark.range(60).selectExpr("id % 6 as video_key", "id % 12 as seq", "cast(id % 2 as int) as r", "1 as g", "2 as b")
    frames = spark.range(12).selectExpr("id % 6 as video_key", "id as seq", "id + 1 as frame_index")
    monkeypatch.setattr(color, "is_small", lambda df: False)
    found = color.attach_frames(pixels, frames)
    assert "Aggregate" not in plan(found)  # the counts are read, not made again
    assert found.groupBy("frame_index").sum("weight").select("sum(weight)").distinct().collect() == [(5,)]
