"""Strips of stored frame colours."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tintflow.operators.strip import color_strip, strip_scale


def prefix_scan(rows: DataFrame, column: str, prefix: str, *then: str) -> DataFrame:
    """Rows whose key starts with a prefix, in key order; the filter reaches the scan."""
    return rows.filter(F.col(column).startswith(prefix)).orderBy(column, *then)


def video_strip(frame_colors: DataFrame, *, video_key: str | None = None, kind: str | None = None,
                chunks: int | None = None) -> DataFrame:
    """Strip columns, enlarged for short videos, of every (video, bucket size, kind) or of the named ones."""
    chosen = frame_colors
    if video_key is not None:
        chosen = chosen.filter(F.col("video_key") == video_key)
    if kind is not None:
        chosen = chosen.filter(F.col("kind") == kind)
    return strip_scale(color_strip(chosen, chunks=chunks))
