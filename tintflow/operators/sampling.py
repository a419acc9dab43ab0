"""Fixed-interval sampling of picture events."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tintflow.operators.ordering import CHUNK, HOT, across_chunks, cut_hot_groups, earlier_chunks, with_carried
from tintflow.schemas import require
from tintflow.session import join_on_group, read_again, staged

# Time between two sampled pictures: 5.5 seconds in microseconds (fixed value).
DEFAULT_INTERVAL_US = 5_500_000


def first_stream(events: DataFrame) -> DataFrame:
    """Keep the events of the stream that each video's first event (by arrival) belongs to."""
    events = read_again(events)
    chosen = events.groupBy("video_key").agg(F.min_by("stream_index", "seq").alias("_stream"))
    return (join_on_group(events, chosen, "video_key", ["seq"])
            .filter("stream_index = _stream").drop("_stream"))


def sample_frames(events: DataFrame, *, interval_us: int = DEFAULT_INTERVAL_US,
                  chunks: int | None = None) -> DataFrame:
    """Pictures a fixed-interval sampler writes, with their ``frame_no`` from 0.

    The first picture opens a grid of deadlines, one interval apart. A picture is written when it has reached
    the next open deadline, and closes just that one, so pictures after a gap are all written until the grid has
    caught up. With ``c`` the number of deadlines reached at the i-th picture, ``e(i) = min(e(i-1) + 1, c(i))``
    pictures are written so far. Hence ``e(i) - i`` is the running minimum of the slack ``c - i``, and
    the i-th picture is written exactly when its slack is not below the smallest slack before it.

    Along the video only ``v = pts - i * interval`` is compared: with the video's start taken away and divided by the interval it is
    the slack less one, whatever the start and the count of pictures before a chunk add to it. So a chunk keeps the running
    minimum of its own ``v``, and the chunks before it add theirs.
    """
    require(events, "video_key", "pts_us", "seq")
    keys, order, interval = ["video_key"], ["pts_us", "seq"], F.lit(int(interval_us)).cast("long")
    chunked, cut = cut_hot_groups(read_again(events), keys, "pts_us", chunks)
    here = Window.partitionBy("video_key", CHUNK).orderBy(*order)
    local = (
        chunked.withColumn("_i", F.row_number().over(here).cast("long"))
        .withColumn("_start", F.min("pts_us").over(here))
        .withColumn("_v", F.col("pts_us") - F.col("_i") * interval)
        .withColumn("_low", F.min("_v").over(here.rowsBetween(Window.unboundedPreceding, -1)))
    )
    if cut:
        local = staged(local)
        earlier = earlier_chunks(keys)
        carried = (
            across_chunks(local.filter(HOT), keys, F.count("*").alias("_rows"), F.min("pts_us").alias("_from"), F.min("_v").alias("_least"))
            .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
            .withColumn("_floor", F.min(F.col("_least") - F.col("_before") * interval).over(earlier))
            .withColumn("_first", F.min("_from").over(Window.partitionBy("video_key")))
            .select("video_key", CHUNK, "_before", "_floor", "_first")
        )
        moved = F.coalesce("_before", F.lit(0))
        local = (
            with_carried(local, carried, keys)
            .withColumn("_low", F.least(F.col("_low") - moved * interval, "_floor"))
            .withColumn("_v", F.col("_v") - moved * interval)
            .withColumn("_i", F.col("_i") + moved)
            .withColumn("_start", F.coalesce("_first", "_start"))
        )

    def slack(value):
        above = F.col(value) - F.col("_start")
        return F.call_function("div", above - F.pmod(above, interval), interval) + 1

    return (
        local.withColumn("_lowest", slack("_low")).filter(F.col("_low").isNull() | (slack("_v") >= F.col("_lowest")))
        .withColumn("frame_no", F.col("_i") + F.coalesce("_lowest", F.lit(0)) - 1)
        .select(*events.columns, "frame_no")
    )
