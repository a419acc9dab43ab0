"""A folder that keeps what analyses found: video metadata, frame colours and block records."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tintflow.operators.history import WRITTEN, latest_cells, read_frame_colors
from tintflow.plans.analyze import Analysis, save
from tintflow.schemas import FRAME_COLORS, VIDEO_BLOCKS, VIDEO_METADATA

METADATA, COLORS, BLOCKS = "videos", "frame_colors", "video_blocks"
NOTHING_STORED = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def stored_or_empty(spark: SparkSession, path: str, layout: StructType, key_type: str = "string") -> DataFrame:
    """The table at ``path``; an empty one of ``layout`` if nothing, or nothing whole, was written there yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in NOTHING_STORED:
            raise
    empty = StructType()
    for field in layout:
        empty.add(field.name, key_type if field.name == "video_key" else field.dataType)
    return spark.createDataFrame([], empty)


def load(spark: SparkSession, folder: str, *, key_type: str = "string") -> dict[str, DataFrame]:
    """What ``analyze`` takes as ``videos``, ``blocks`` and ``stored``.

    The block records are read first and say which runs count: frames of a run that ended before its record was written
    are not seen, and the run before it still is. A folder without tables is a normal case.
    """
    blocks = stored_or_empty(spark, f"{folder}/{BLOCKS}", VIDEO_BLOCKS, key_type)
    videos = latest_cells(stored_or_empty(spark, f"{folder}/{METADATA}", VIDEO_METADATA, key_type), ["video_key"])
    try:
        stored = read_frame_colors(spark, f"{folder}/{COLORS}", runs=blocks).drop(*WRITTEN)
    except AnalysisException as error:
        if error.getCondition() not in NOTHING_STORED:
            raise
        stored = stored_or_empty(spark, f"{folder}/{COLORS}", FRAME_COLORS, key_type)
    return {"videos": videos, "blocks": blocks, "stored": stored}


def commit(done: Analysis, folder: str) -> None:
    """Store a run: metadata, then colours, and last the block records that make the colours count."""
    save(done.fresh, f"{folder}/{COLORS}", f"{folder}/{BLOCKS}", ingested=done.ingested, metadata_path=f"{folder}/{METADATA}")
