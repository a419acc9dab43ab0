"""From stored video files to container places and metadata records."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tintflow.operators.history import VIDEO_CELLS, WRITTEN
from tintflow.operators.ordering import number_rows
from tintflow.operators.packing import CONTAINER_CAP, open_containers, pack_containers

# Containers are named by this pattern (fixed value).
CONTAINER_NAME = "video_%d.mp4"


def placed_files(metadata: DataFrame) -> DataFrame:
    """Container and size of every file that metadata records place."""
    return metadata.select(
        F.lit("videos").alias("volume"), F.col("filesize").alias("size"),
        F.regexp_extract("path", r"video_(\d+)\.mp4$", 1).cast("long").alias("container_id"))


def ingest(videos: DataFrame, metadata: DataFrame, *, folder: str = "videos",
           cap: int = CONTAINER_CAP) -> DataFrame:
    """Metadata records of new videos, appended to the containers that ``metadata`` records, in arrival order.

    ``videos`` has video_key, name, size and recorded_at; no history is a normal case. Videos that are already
    placed are left out, and of a key that arrives more than once the earliest is placed.
    """
    first = F.min_by(F.struct("name", "size", "recorded_at"), F.struct("recorded_at", "name", "size")).alias("first")
    new = (videos.groupBy("video_key").agg(first).select("video_key", "first.*")
           .join(metadata.select("video_key").distinct(), "video_key", "left_anti"))
    arrived = number_rows(
        new.select("video_key", "name", "size", "recorded_at").withColumn("volume", F.lit("videos")),
        ["volume"], ["recorded_at", "video_key"], number="seq")
    placed = pack_containers(arrived, cap=cap, opened=open_containers(placed_files(metadata)))
    return placed.select(
        "video_key", "name", F.col("video_key").alias("hyperlink"),
        F.concat(F.lit(f"{folder}/"), F.format_string(CONTAINER_NAME, "container_id")).alias("path"),
        "byte_offset", F.col("size").alias("filesize"), "recorded_at", "seq",
    ).select("video_key", *VIDEO_CELLS, *WRITTEN)
