"""Row filters."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Path segment that marks a manifest line as a frame (fixed value).
FRAME_TOKEN = "Frames"


def is_valid_image(width: str = "width", height: str = "height") -> Column:
    return (F.col(width) > 1) & (F.col(height) > 1)


def valid_images(frames: DataFrame) -> DataFrame:
    """Images wider and taller than one pixel; the others leave a gap in the numbering given before."""
    return frames.filter(is_valid_image())


def manifest_filter(lines: DataFrame, *, path: str = "path", token: str = FRAME_TOKEN) -> DataFrame:
    """Lines with the token inside one of the path's segments."""
    if "/" in token:
        raise ValueError("a token lies within one path segment")
    return lines.filter(F.col(path).contains(token))


def kind_filter(frame_colors: DataFrame, kind: str) -> DataFrame:
    return frame_colors.filter(F.col("kind") == kind)


def complete_frames(channel_rows: DataFrame, keys=("video_key", "frame_index")) -> DataFrame:
    """Frames that have a value for all three channels, given one row per channel."""
    return (channel_rows.filter("value is not null").groupBy(*keys)
            .agg(F.count_distinct("channel").alias("channels")).filter("channels = 3").drop("channels"))


def has_all_channels() -> Column:
    return F.col("r").isNotNull() & F.col("g").isNotNull() & F.col("b").isNotNull()
