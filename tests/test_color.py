import random
from collections import Counter

import pytest

from conftest import plan, rows
from tintflow import session
from tintflow.functions.requests import accepted, validate_requests
from tintflow.operators import color
from tintflow.plans.colors import frame_colors

PIXEL = "video_key string, frame_index long, r int, g int, b int"


def frame(spark, levels):
    return spark.createDataFrame([("v", 1, *p) for p in levels], PIXEL)


def average(pixels, size, rounding):
    def of(channel):
        counts = Counter(p[channel] // size * size for p in pixels)
        if rounding == "exact":
            return sum(n * v for v, n in counts.items()) // len(pixels)
        return sum(n * v // len(pixels) for v, n in counts.items())
    return tuple(of(c) for c in range(3))


def dominant(pixels, size):
    counts = Counter(tuple(c // size * size for c in p) for p in pixels)
    return max(counts, key=lambda k: (counts[k], "R %d,G %d,B %d" % k))


@pytest.mark.parametrize("rounding,expected", [("truncate", 50), ("exact", 51)])
def test_fraction_of_each_share_is_dropped(spark, rounding, expected):
    levels = [(100,) * 3] * 3 + [(20,) * 3] * 3 + [(0,) * 3]
    found = color.average_color(frame(spark, levels), 10, rounding=rounding)
    assert rows(found, "r", "g", "b") == [(expected,) * 3]


@pytest.mark.parametrize("rounding,expected", [("truncate", 0), ("exact", 127)])
def test_even_ramp(spark, rounding, expected):
    found = color.average_color(frame(spark, [(v,) * 3 for v in range(256)]), 1, rounding=rounding)
    assert rows(found, "r", "g", "b") == [(expected,) * 3]


def test_ties_take_the_greatest_text(spark):
    levels = [(100, 0, 0)] * 3 + [(20, 0, 0)] * 3 + [(0, 0, 0)]
    assert rows(color.dominant_color(frame(spark, levels), 10), "r", "g", "b") == [(20, 0, 0)]


def test_random_frames(spark):
    rng = random.Random(5)
    frames = {(f"v{n % 3}", n): [tuple(rng.choice([0, 7, 39, 40, 99, 100, 200, 255]) for _ in range(3))
                                 for _ in range(rng.randrange(1, 60))] for n in range(12)}
    pixels = spark.createDataFrame([(*k, *p) for k, ps in frames.items() for p in ps], PIXEL)
    for size in (1, 10, 40, 255):
        for rounding in color.ROUNDINGS:
            found = color.average_color(pixels, size, rounding=rounding)
            assert rows(found, *color.FRAME, "r", "g", "b") == sorted(
                ((*k, *average(ps, size, rounding)) for k, ps in frames.items()), key=repr)
        assert rows(color.dominant_color(pixels, size), *color.FRAME, "r", "g", "b") == sorted(
            ((*k, *dominant(ps, size)) for k, ps in frames.items()), key=repr)


def test_weighed_pixels_count_as_many(spark):
    rng = random.Random(6)
    pixels = spark.createDataFrame(
        [("v", rng.randrange(3), *(rng.choice([10, 50, 250]) for _ in range(3))) for _ in range(200)], PIXEL)
    weighed = color.weigh(pixels, color.FRAME)
    assert weighed.count() < 100
    for found in (color.average_color, color.dominant_color):
        assert rows(found(weighed, 16)) == rows(found(pixels, 16))


@pytest.fixture
def asked(spark):
    rng = random.Random(8)
    pixels = spark.createDataFrame(
        [(rng.choice("abbbbb"), rng.randrange(4), *(rng.randrange(256) for _ in range(3))) for _ in range(400)], PIXEL)
    requests = spark.createDataFrame(
        [("a", "40", "average"), ("b", "16", "domiant"), ("b", "16", "dominant"), ("b", "16", "average"),
         ("b", "1", "average"), ("b", "300", "average"), ("a", "x", "average"), ("c", "5", "average")],
        "video_key string, bucket_size string, kind string")
    return pixels, requests


def test_requests_choose_videos_sizes_and_kinds(asked):
    pixels, requests = asked
    found = frame_colors(pixels, requests)
    assert {tuple(r) for r in found.select("video_key", "bucket_size", "kind").distinct().collect()} == {
        ("a", 40, "average"), ("b", 16, "dominant"), ("b", 16, "average"), ("b", 1, "average")}
    one = color.average_color(pixels.filter("video_key = 'b'"), 16)
    assert rows(found.filter("bucket_size = 16 and kind = 'average'")) == rows(one)


def test_many_requests_give_the_same(asked, monkeypatch):
    """Dealing pixels and counted rows to the requests changes nothing."""
    pixels, requests = asked
    expected = rows(frame_colors(pixels, requests))
    monkeypatch.setattr(color, "is_small", lambda *_: False)
    assert rows(frame_colors(pixels, requests), *color.FRAME, "bucket_size", "kind", "r", "g", "b") == expected


def test_sizes_follow_from_their_largest_divisor(spark):
    wanted = spark.createDataFrame([("a", s, "dominant") for s in (6, 12, 24, 4, 30, 255)] + [("b", s, "dominant") for s in (2, 3, 5, 7, 11, 44)]
                                   + [("b", 9, "average")], "video_key string, bucket_size int, kind string")
    assert rows(color.derived_sizes(wanted)) == sorted([
        ("a", 4, None, 0, True), ("a", 6, None, 0, True), ("a", 12, 6, 1, True), ("a", 24, 12, 2, True), ("a", 30, 6, 1, True),
        ("a", 255, None, 0, True), ("b", 1, None, 0, False), *[("b", s, 1, 1, True) for s in (2, 3, 5, 7, 11)], ("b", 44, 11, 2, True)], key=repr)


@pytest.mark.parametrize("sizes,small", [((1, 40), True), ((16, 40), True), ((1, 2, 8, 64), True), ((6, 12, 24, 255), False), (range(2, 256, 21), True)])
def test_chains_of_sizes_equal_each_size_alone(spark, monkeypatch, sizes, small):
    """Colours that are nearly all distinct, ties, and a frame of one colour, in two videos that ask for other sizes."""
    rng = random.Random(21)
    frames = {(v, n): [tuple(rng.randrange(256) if n else 77 for _ in range(3)) for _ in range(40 + 60 * n)] for v in "ab" for n in range(3)}
    pixels = spark.createDataFrame([(*k, *p) for k, ps in frames.items() for p in ps], PIXEL)
    wanted = [(v, s, kind) for v in "ab" for s in sizes for kind in ("average", "dominant") if v == "a" or s % 2 == 0]
    if not small:
        monkeypatch.setattr(color, "is_small", lambda *_: False)
    found = color.requested_colors(pixels, spark.createDataFrame(wanted, "video_key string, bucket_size int, kind string"))
    expected = [(v, n, s, kind, *(average(ps, s, "truncate") if kind == "average" else dominant(ps, s)))
                for (v, n), ps in frames.items() for w, s, kind in wanted if v == w]
    assert rows(found, *color.FRAME, "bucket_size", "kind", "r", "g", "b") == sorted(expected, key=repr)


def test_no_requests_no_colors(spark):
    none = spark.createDataFrame([], "video_key string, bucket_size int, kind string")
    assert rows(color.requested_colors(frame(spark, [(1, 2, 3)]), none)) == []


def test_pixels_of_frames_broadcast_or_dealt(spark, monkeypatch):
    rng = random.Random(9)
    pixels = spark.createDataFrame(
        [("v", rng.randrange(5), *(rng.choice([0, 99]) for _ in range(3))) for _ in range(200)],
        "video_key string, seq long, r int, g int, b int")
    frames = spark.createDataFrame([("v", 1, 1), ("v", 4, 2), ("w", 2, 1)], "video_key string, seq long, frame_index long")
    expected = rows(color.weigh(color.attach_frames(pixels, frames), color.FRAME))
    monkeypatch.setattr(color, "is_small", lambda *_: False)
    dealt = color.weigh(color.attach_frames(pixels, frames), color.FRAME)
    assert rows(dealt, *color.FRAME, "r", "g", "b", "weight") == expected


def test_dealt_join_equals_broadcast_join(spark):
    large = spark.range(500).selectExpr("id % 7 as k", "id")
    small = spark.range(5).selectExpr("id as k", "id * 10 as v")
    for how in ("inner", "left", "left_semi"):
        assert rows(session.join_on_group(large, small, "k", ["id"], how, small=False)) == rows(
            session.join_on_group(large, small, "k", ["id"], how, small=True))


def test_size_check_counts(spark):
    assert session.is_small(spark.range(10), 10)
    assert not session.is_small(spark.range(11), 10)


@pytest.mark.parametrize("text,reason", [
    ("1", None), ("255", None), ("+7", None), ("0", "out of range"), ("-1", "out of range"), ("256", "out of range"),
    ("99999999999999999999", "out of range"), ("abc", "not a number"), (" 5", "not a number"), ("5.5", "not a number"),
    ("", "not a number"), (None, "missing")])
def test_bucket_size_rules(spark, text, reason):
    checked = validate_requests(spark.createDataFrame([("v", text)], "video_key string, bucket_size string")).first()
    assert checked["reject_reason"] == reason
    assert checked["bucket_size"] == (int(text) if reason is None else None)


def test_accepted_are_distinct_and_typed(asked):
    assert dict(accepted(asked[1]).dtypes)["bucket_size"] == "int"
    assert accepted(asked[1]).count() == 5


def test_pixel_layout_is_checked(spark):
    with pytest.raises(ValueError, match="frame_index"):
        color.colors_of(spark.range(1).withColumnRenamed("id", "video_key"))


def test_unusable_pixels_are_no_pixels(spark):
    pixels = spark.createDataFrame([("v", 1, 10, 20, 30), ("v", 1, None, 20, 30), ("v", 1, 300, 20, 30), ("v", 1, 1, -1, 30), ("v", 2, None, None, None)],
                                   "video_key string, frame_index long, r int, g int, b int")
    asked = spark.createDataFrame([("v", 10, "average"), ("v", 10, "dominant"), ("v", 0, "average"), ("v", 300, "dominant")],
                                  "video_key string, bucket_size int, kind string")
    for rounding in color.ROUNDINGS:
        found = rows(color.requested_colors(pixels, asked, rounding=rounding), "frame_index", "bucket_size", "kind", "r", "g", "b")
        assert found == [(1, 10, "average", 10, 20, 30), (1, 10, "dominant", 10, 20, 30)]
        assert rows(color.average_color(pixels, 10, rounding=rounding), "frame_index", "r", "g", "b") == [(1, 10, 20, 30)]


@pytest.mark.parametrize("size", [0, -1, 256])
def test_sizes_are_checked_when_called(spark, size):
    pixels = spark.createDataFrame([("v", 1, 10, 20, 30)], "video_key string, frame_index long, r int, g int, b int")
    for call in (color.average_color, color.dominant_color, color.channel_histogram):
        with pytest.raises(ValueError, match="between 1 and 255"):
            call(pixels, size)


@pytest.mark.parametrize("small_frame,is_small", [(0, True), (0, False), (64, True)])
def test_small_and_large_frames_are_counted_alike(spark, monkeypatch, small_frame, is_small):
    rng = random.Random(21)
    sizes = [1, 2, 4, 12, 36, 3, 5, 7, 11, 13, 255]
    frames = {(v, n): [(rng.randrange(256), rng.randrange(4) * 80, rng.choice([0, 7, 255])) for _ in range(rng.randrange(1, 9))]
              for v, count in (("hot", 90), ("b", 2), ("c", 1)) for n in range(1, count + 1)}
    pixels = spark.createDataFrame([(v, n, *p) for (v, n), ps in frames.items() for p in ps] + [("b", 1, None, 0, 0), ("b", 1, 0, 256, 0), (None, 1, 1, 1, 1)],
                                   "video_key string, frame_index long, r int, g int, b int")
    wanted = [(v, s, kind) for v in ("hot", "b", "none") for s in sizes for kind in ("average", "dominant") if v == "hot" or s % 2]
    monkeypatch.setattr(color, "SMALL_FRAME", small_frame)
    if not is_small:
        monkeypatch.setattr(color, "is_small", lambda *_: False)
    asked = spark.createDataFrame(wanted, "video_key string, bucket_size int, kind string")
    assert color.are_small_frames(pixels)[0] == bool(small_frame)
    for rounding, given in (("truncate", pixels), ("exact", color.weigh(pixels, color.FRAME))):
        expected = [(v, n, s, kind, *(average(ps, s, rounding) if kind == "average" else dominant(ps, s)))
                    for (v, n), ps in frames.items() for w, s, kind in wanted if v == w]
        assert rows(color.requested_colors(given, asked, rounding=rounding), *color.FRAME, "bucket_size", "kind", "r", "g", "b") == sorted(expected, key=repr)


def test_small_frames_store_no_more_rows_than_they_have_pixels(spark, monkeypatch):
    pixels = spark.range(300).selectExpr("id div 3 % 5 as video_key", "id div 3 as frame_index", "cast(id % 256 as int) as r", "cast(id * 7 % 256 as int) as g", "5 as b")
    asked = spark.sql("select v as video_key, cast(s as int) as bucket_size, k as kind from range(5) as t(v), range(1, 9) as u(s), (values ('average'), ('dominant')) as w(k)")
    stored = []

    def recorded(df):
        found = session.staged(df)
        stored.append(found.count())
        return found
    monkeypatch.setattr(color, "staged", recorded)
    found = color.requested_colors(pixels, asked)
    assert found.count() == 100 * 16 and max(stored) <= 300
    exchanged = [line for line in plan(found).split("\n") if "Exchange hashpartitioning" in line]
    assert sum("slot" in line or "bucket_size" in line for line in exchanged) == 0


def test_hot_keys_are_those_of_a_plain_count(spark):
    large = spark.range(3000).selectExpr("if(id % 3 = 0, null, if(id % 5 = 0, -1, id % 900)) as k", "id % 2 as m")
    for keys, share in ((["k"], 8), (["k", "m"], 16), (["m"], 2), (["m"], 1)):
        counts = large.groupBy(*keys).count().filter(f"count > {3000 / share}").select(*keys)
        assert rows(session.hot_keys(large, keys, share), *keys) == rows(counts)
    assert rows(session.hot_keys(large.filter("false"), ["k"], 8)) == []
