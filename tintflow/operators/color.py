"""Colour statistics of frames.

Pixels are a table (video_key, frame_index, r, g, b). Every aggregate first counts equal buckets, which Spark does
before the shuffle: at most 256 rows per channel and frame leave a task, however many pixels a frame has.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tintflow.functions.colour import LARGEST_BUCKET, SMALLEST_BUCKET, bucket_label, bucketize, valid_size
from tintflow.schemas import require
from tintflow.session import hot_keys, is_small, join_on_group, read_again, staged

FRAME = ["video_key", "frame_index"]
ROUNDINGS = ("truncate", "exact")


def pixel_count(pixels: DataFrame) -> DataFrame:
    return pixels.groupBy(*FRAME).agg(F.count("*").alias("pixels"))


def channel_histogram(pixels: DataFrame, bucket_size: int) -> DataFrame:
    """Pixels per frame, channel and bucket."""
    levels = pixels.selectExpr(*FRAME, "stack(3, 'R', r, 'G', g, 'B', b) as (channel, level)")
    return (levels.groupBy(*FRAME, "channel", bucketize("level", bucket_size).alias("bucket"))
            .agg(F.count("*").alias("cnt")))


def bucket_share(pixels: DataFrame, bucket_size: int) -> DataFrame:
    """Each bucket's part of the frame's pixels, and what it adds to the channel's average.

    The pixels are counted from the histogram itself, at most 256 rows per frame and channel.
    """
    of_channel = Window.partitionBy(*FRAME, "channel")
    return (channel_histogram(pixels, bucket_size)
            .withColumn("pixels", F.sum("cnt").over(of_channel))
            .withColumn("share", F.expr("cast(cnt as double) / pixels"))
            .withColumn("contribution", F.expr("cast(cnt as double) / pixels * bucket")))


def joint_histogram(pixels: DataFrame, bucket_size: int) -> DataFrame:
    """Pixels per frame and bucket of all three channels together."""
    buckets = [bucketize(c, bucket_size).alias(f"{c}b") for c in "rgb"]
    return pixels.groupBy(*FRAME, *buckets).agg(F.count("*").alias("cnt"))


def channel_pivot(channel_rows: DataFrame, keys=tuple(FRAME)) -> DataFrame:
    """One row per frame from one row per channel; a missing channel is null."""
    return (channel_rows.groupBy(*keys).pivot("channel", ["R", "G", "B"]).agg(F.first("value"))
            .withColumnsRenamed({"R": "r", "G": "g", "B": "b"}))


def frame_count(frames: DataFrame) -> DataFrame:
    return frames.groupBy("video_key").agg(F.count("*").alias("frames"))


def byte_totals(files: DataFrame, keys: list[str], size: str = "length") -> DataFrame:
    return files.groupBy(*keys).agg(
        F.sum(F.col(size).cast("long")).alias("bytes"), F.count("*").alias("files"))


def pixel_weight(pixels: DataFrame) -> Column:
    """Pixels in a group of rows; a row stands for ``weight`` equal pixels where that column exists."""
    return F.sum("weight") if "weight" in pixels.columns else F.count("*")


def weigh(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """Equal pixels per key counted into one row each."""
    return pixels.groupBy(*keys, "r", "g", "b").agg(pixel_weight(pixels).alias("weight"))


# An observation is one number: the bucket size its value was cut to (0 for a channel's own level), the slot it belongs to, and
# 24 bits that hold a channel's value or all three.
RED, GREEN, BLUE, JOINT = 0, 1, 2, 3
SLOT_SHIFT, SIZE_SHIFT = 24, 32
VALUES = (1 << SLOT_SHIFT) - 1

# A video with more sizes than this that no other asked size divides gets all its sizes from its colours.
FIRST_SIZES = 4
# Counted levels of one task: each meets all its video's sizes there, and their buckets are to fit its memory.
LEVELS_A_TASK = 200_000
# Frames of this many rows on average, or fewer, have fewer colours than all their sizes have buckets.
SMALL_FRAME = 64
# Counted buckets of one task, where small frames are counted, and the pieces that a large video's frames are dealt over.
BUCKETS_A_TASK = 1_000_000
DEALT = 64
# Hashes of frames that rows are counted by.
HASHES = 4096
# A size is at least twice its divisor, so chains up to 255 have fewer steps.
CHAIN = 8

# Levels in the byte order of their decimal text: the order of the labels of equally frequent colours.
BY_TEXT = sorted(range(LARGEST_BUCKET + 1), key=str)
PLACE_BY_TEXT = [BY_TEXT.index(level) for level in range(LARGEST_BUCKET + 1)]


def usable_pixels(pixels: DataFrame) -> DataFrame:
    """Pixels whose channels all lie in 0..255; others, null ones too, are no pixels of their frame."""
    return pixels.filter(F.col("r").between(0, 255) & F.col("g").between(0, 255) & F.col("b").between(0, 255))


def _channels(value: Column) -> list[Column]:
    return [F.shiftright(value, shift).bitwiseAND(F.lit(255)).cast("int") for shift in (16, 8, 0)]


def _pack(red: Column, green: Column, blue: Column) -> Column:
    return F.shiftleft(red.cast("int"), 16).bitwiseOR(F.shiftleft(green.cast("int"), 8)).bitwiseOR(blue.cast("int"))


def _cut(channels: list[Column], size: Column) -> Column:
    """A packed colour, each channel at the lower bound of its bucket."""
    return _pack(*[channel - channel % size for channel in channels])


def _seen(size: Column, slot: int, value: Column) -> Column:
    return (F.shiftleft(size.cast("long"), SIZE_SHIFT).bitwiseOR(F.lit(slot << SLOT_SHIFT).cast("long"))
            .bitwiseOR(value.cast("long")))


def _counted(observed: DataFrame, pixels: Column) -> DataFrame:
    """Equal observations (an array ``seen`` per row, null for none) of a frame counted, taken apart into bucket_size, slot and value."""
    seen = F.col("seen")
    return (observed.withColumn("seen", F.explode("seen")).filter(seen.isNotNull()).groupBy(*FRAME, "seen").agg(pixels.alias("cnt"))
            .select(*FRAME, F.shiftright(seen, SIZE_SHIFT).cast("int").alias("bucket_size"),
                    F.shiftright(seen, SLOT_SHIFT).bitwiseAND(F.lit(JOINT)).cast("int").alias("slot"),
                    seen.bitwiseAND(F.lit(VALUES)).cast("int").alias("value"), "cnt"))


def _with_pixels(levels: DataFrame, *keys: str) -> DataFrame:
    of_red = F.when(F.col("slot") == RED, F.col("cnt"))
    return levels.withColumn("pixels", F.sum(of_red).over(Window.partitionBy(*keys)))


def _averages(buckets: DataFrame, rounding: str, frame=tuple(FRAME)) -> DataFrame:
    """Average colours from counted buckets (frame, bucket_size, pixels, slot, value, cnt).

    ``truncate`` drops the fraction of every bucket's contribution to an average, ``exact`` only that of the sum.
    """
    def average(slot):
        part = F.when(F.col("slot") == slot, F.col("cnt") * F.col("value"))
        if rounding == "truncate":
            return F.sum(F.call_function("div", part, F.col("pixels")))
        return F.call_function("div", F.sum(part), F.max("pixels"))

    return buckets.groupBy(*frame, "bucket_size").agg(F.lit("average").alias("kind"), *[
        average(slot).cast("int").alias(name) for slot, name in ((RED, "r"), (GREEN, "g"), (BLUE, "b"))])


def _dominants(joint: DataFrame, frame=tuple(FRAME)) -> DataFrame:
    """The most frequent joint bucket (frame, bucket_size, value, cnt); of equally frequent ones the greatest label in byte order.

    Count and place of the label make one number, so that its maximum is kept in place and one row per frame and size leaves a task.
    """
    def looked_up(value, levels):
        table = F.expr(f"array({', '.join(map(str, levels))})")
        return [F.get(table, channel) for channel in _channels(value)]

    place = _pack(*looked_up(F.col("value"), PLACE_BY_TEXT)).cast("long")
    top = joint.groupBy(*frame, "bucket_size").agg(
        F.max(F.shiftleft(F.col("cnt").cast("long"), SLOT_SHIFT).bitwiseOR(place)).alias("top"))
    return top.select(*frame, "bucket_size", F.lit("dominant").alias("kind"), *[
        level.cast("int").alias(name) for name, level in zip("rgb", looked_up(F.col("top").bitwiseAND(F.lit(VALUES)), BY_TEXT))])


def _valid_rounding(rounding: str) -> None:
    if rounding not in ROUNDINGS:
        raise ValueError(f"rounding is one of {ROUNDINGS}")


def colors_of(pixels: DataFrame, *, rounding: str = "truncate") -> DataFrame:
    """One colour per frame, bucket size and kind, from pixels that carry distinct ``bucket_size`` and ``kind``.

    At most 3 x 256 counted channel buckets of a frame leave a task.
    """
    require(pixels, *FRAME, "r", "g", "b", "bucket_size", "kind")
    _valid_rounding(rounding)
    usable, size, channels = usable_pixels(pixels), F.col("bucket_size"), [F.col(c) for c in "rgb"]
    levels = [_seen(size, slot, c - c % size) for slot, c in zip((RED, GREEN, BLUE), channels)]
    of_average = usable.filter(F.col("kind") == "average").withColumn("seen", F.array(*levels))
    of_dominant = usable.filter(F.col("kind") != "average").withColumn("seen", F.array(_seen(size, JOINT, _cut(channels, size))))
    buckets = _with_pixels(_counted(of_average, pixel_weight(pixels)), *FRAME, "bucket_size")
    return _averages(buckets, rounding).unionByName(_dominants(_counted(of_dominant, pixel_weight(pixels))))


def average_color(pixels: DataFrame, bucket_size: int, *, rounding: str = "truncate") -> DataFrame:
    asked = pixels.withColumn("bucket_size", valid_size(bucket_size)).withColumn("kind", F.lit("average"))
    return colors_of(asked, rounding=rounding)


def dominant_color(pixels: DataFrame, bucket_size: int) -> DataFrame:
    asked = pixels.withColumn("bucket_size", valid_size(bucket_size)).withColumn("kind", F.lit("dominant"))
    return colors_of(asked)


def _divisor(size: Column, sizes: Column) -> Column:
    """The largest of ``sizes`` that ``size`` is a multiple of, other than itself; null if there is none."""
    return F.array_max(F.filter(sizes, lambda s: (s < size) & (size % s == 0)))


def derived_sizes(wanted: DataFrame) -> DataFrame:
    """How a video's joint histograms follow from one another: (video_key, bucket_size, from_size, step, asked).

    Buckets of a multiple are unions of a divisor's buckets, so a size follows from the largest asked size that divides it; ``step``
    is the length of its chain. Sizes without a divisor (``from_size`` null, step 0) are counted from pixels. Where these are more
    than ``FIRST_SIZES``, only size 1 is, which divides all; it is not ``asked`` if nobody asked for it.
    """
    per_video = wanted.filter(F.col("kind") != "average").groupBy("video_key").agg(F.collect_set("bucket_size").alias("own"))
    first = F.filter("own", lambda s: _divisor(s, F.col("own")).isNull())
    one = F.array(F.lit(1))
    sizes = per_video.select("video_key", "own", F.when(F.size(first) <= FIRST_SIZES, F.col("own")).otherwise(
        F.array_union(one, "own")).alias("sizes"))
    each = sizes.withColumn("bucket_size", F.explode("sizes"))
    start = F.struct(F.col("bucket_size").alias("at"), F.lit(0).alias("step"))

    def follow(chain, _):
        divisor = _divisor(chain["at"], F.col("sizes"))
        return F.struct(divisor.alias("at"), (chain["step"] + divisor.isNotNull().cast("int")).alias("step"))

    return each.select("video_key", "bucket_size", _divisor(F.col("bucket_size"), F.col("sizes")).alias("from_size"),
                       F.aggregate(F.sequence(F.lit(1), F.lit(CHAIN)), start, follow)["step"].alias("step"),
                       F.array_contains("own", F.col("bucket_size")).alias("asked"))


def count_observations(pixels: DataFrame, wanted: DataFrame, sizes: DataFrame, small: bool, first_sizes: int = FIRST_SIZES) -> DataFrame:
    """Counted observations of the requested videos' frames: levels for averages, joint buckets of the first sizes.

    No video has more than ``first_sizes`` of these.
    """
    first = sizes.filter("step = 0").groupBy("video_key").agg(F.collect_list("bucket_size").alias("_first"))
    videos = (wanted.groupBy("video_key").agg(F.max(F.col("kind") == "average").alias("_averages"))
              .join(first, "video_key", "left"))
    used = join_on_group(usable_pixels(pixels), videos, "video_key", [*FRAME, "r", "g", "b"], small=small)
    channels = [F.col(c) for c in "rgb"]
    levels = [F.when(F.col("_averages"), _seen(F.lit(0), slot, c)) for slot, c in zip((RED, GREEN, BLUE), channels)]
    of_size = (F.get("_first", F.lit(k)) for k in range(first_sizes))
    joints = [F.when(size.isNotNull(), _seen(size, JOINT, _cut(channels, size))) for size in of_size]
    return _counted(used.withColumn("seen", F.array(*levels, *joints)), pixel_weight(pixels))


def are_small_frames(pixels: DataFrame) -> tuple[bool, int]:
    """Whether frames have few rows on average and none has many, and the number of rows."""
    sizes = pixels.groupBy(F.pmod(F.xxhash64(*FRAME), F.lit(HASHES)).alias("_bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(F.xxhash64(*FRAME)).alias("frames"))
    rows, frames, most = sizes.agg(F.sum("rows"), F.sum("frames"), F.max("rows")).first()
    return (rows or 0) <= SMALL_FRAME * (frames or 0) and (most or 0) <= max(LEVELS_A_TASK, (rows or 0) // DEALT), rows or 0


def small_frame_colors(pixels: DataFrame, wanted: DataFrame, rows: int, *, rounding: str = "truncate") -> DataFrame:
    """``requested_colors`` where frames have few pixels: their colours are exchanged, once, and all sizes counted where they lie.

    A video's frames lie together, those of a video with more than one in ``DEALT`` of the rows in as many places.
    """
    video, frame = ["video_key", "_deal"], ["video_key", "_deal", "frame_index"]
    of_kind = {"_averages": F.col("kind") == "average", "_dominants": F.col("kind") != "average"}
    per_video = wanted.groupBy("video_key").agg(*[
        F.collect_set(F.when(which, F.col("bucket_size"))).alias(name) for name, which in of_kind.items()])
    pairs = wanted.count() // max(1, wanted.select("video_key").distinct().count()) + 1
    parts = -(-3 * rows * pairs // BUCKETS_A_TASK) or 1

    weight = F.col("weight") if "weight" in pixels.columns else F.lit(1).cast("long")
    colors = usable_pixels(pixels).select(*FRAME, _pack(*map(F.col, "rgb")).alias("value"), weight.alias("cnt"))
    hot = F.broadcast(hot_keys(colors, ["video_key"], DEALT))
    deal = F.pmod(F.xxhash64("frame_index"), F.lit(DEALT)).cast("int")
    every = F.sequence(F.lit(0), F.lit(DEALT - 1))
    dealt = colors.join(hot, "video_key", "left").withColumn("_deal", F.when(F.col("_hot"), deal).otherwise(0)).drop("_hot")
    repeated = per_video.join(hot, "video_key", "left").withColumn(
        "_deal", F.explode(F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0))))).drop("_hot")
    asked = dealt.repartition(parts, *video).join(repeated.repartition(parts, *video), video)

    levels = (asked.withColumn("pixels", F.sum("cnt").over(Window.partitionBy(*frame)))
              .select(*frame, "value", "cnt", "pixels", F.explode("_averages").alias("bucket_size"))
              .select(*frame, "bucket_size", "pixels", "cnt", F.posexplode(F.array(*_channels(F.col("value")))).alias("slot", "level")))
    buckets = (levels.groupBy(*frame, "bucket_size", "pixels", "slot", bucketize("level", "bucket_size").alias("value"))
               .agg(F.sum("cnt").alias("cnt")))
    joint = (asked.select(*frame, "value", "cnt", F.explode("_dominants").alias("bucket_size"))
             .groupBy(*frame, "bucket_size", _cut(_channels(F.col("value")), F.col("bucket_size")).alias("value")).agg(F.sum("cnt").alias("cnt")))
    return _averages(buckets, rounding, frame).unionByName(_dominants(joint, frame)).drop("_deal")


def requested_colors(pixels: DataFrame, requests: DataFrame, *, rounding: str = "truncate") -> DataFrame:
    """Colours of the requested videos' frames, for each (bucket size, kind) asked of their video.

    The pixels are read and counted once: levels per channel (at most 768 rows a frame, which serve the averages of all
    sizes) and joint buckets of the sizes that no other asked size divides, cut before anything is exchanged. The counts are
    staged. A frame's levels come together once and give all its averages; every other size is counted from the buckets
    of its largest divisor, step by step. Frames of few pixels have fewer colours than that, and take ``small_frame_colors``.
    Sizes outside 1..255 get no colour.
    """
    _valid_rounding(rounding)
    asked = ["video_key", "bucket_size", "kind"]
    wanted = staged(requests.filter(F.col("bucket_size").between(SMALLEST_BUCKET, LARGEST_BUCKET)).select(*asked).distinct())
    pixels = read_again(pixels)
    few, rows = are_small_frames(pixels)
    if few:
        return small_frame_colors(pixels, wanted, rows, rounding=rounding)
    small = is_small(wanted)
    sizes = staged(derived_sizes(wanted))
    per_video = sizes.groupBy("video_key").agg(F.max("step").alias("steps"), F.max(~F.col("asked")).alias("added"),
                                               F.count_if(F.col("step") == 0).alias("firsts"))
    steps, added, firsts = per_video.agg(F.max("steps"), F.max("added"), F.max("firsts")).first()
    counted = staged(count_observations(pixels, wanted, sizes, small, firsts or 0))

    levels = counted.filter(F.col("slot") != JOINT).drop("bucket_size")
    parts = -(-levels.count() // LEVELS_A_TASK)
    levels = _with_pixels(levels.repartition(parts, *FRAME) if parts > 1 else levels, *FRAME)
    averaged = wanted.filter(F.col("kind") == "average").select("video_key", "bucket_size")
    buckets = (join_on_group(levels, averaged, "video_key", ["frame_index", "slot", "value"], small=small)
               .groupBy(*FRAME, "bucket_size", "pixels", "slot", bucketize("value", "bucket_size").alias("value"))
               .agg(F.sum("cnt").alias("cnt")))
    found = _averages(buckets, rounding)

    joint = counted.filter(F.col("slot") == JOINT).drop("slot")
    reached = joint
    for step in range(1, (steps or 0) + 1):
        following = sizes.filter(F.col("step") == step).select(
            "video_key", F.col("from_size").alias("bucket_size"), F.col("bucket_size").alias("_size"))
        spread = join_on_group(reached, following, ["video_key", "bucket_size"], ["frame_index", "value"], small=small)
        reached = (spread.groupBy(*FRAME, F.col("_size").alias("bucket_size"), _cut(_channels(F.col("value")), F.col("_size")).alias("value"))
                   .agg(F.sum("cnt").alias("cnt")))
        if step < steps:
            reached = staged(reached)
        joint = joint.unionByName(reached)
    if added:
        joint = join_on_group(joint, sizes.filter("asked").select("video_key", "bucket_size"), ["video_key", "bucket_size"],
                              ["frame_index", "value"], "left_semi", small=small)
    return found.unionByName(_dominants(joint))


def attach_frames(pixels: DataFrame, frames: DataFrame) -> DataFrame:
    """Pixels of picture events (video_key, seq) that became frames, with their frame index."""
    event = ["video_key", "seq"]
    places = staged(frames.select(*event, "frame_index"))
    if is_small(places):
        return pixels.join(F.broadcast(places), event).drop("seq")
    # Stored, because the join reads its large side three times, and the pixels may themselves come from a join.
    weighed = staged(weigh(pixels, event))
    return join_on_group(weighed, places, event, ["r", "g", "b"], salts=8, small=False).drop("seq")
