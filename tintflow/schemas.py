"""Row layouts of every table the operators read or write."""

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    BinaryType, IntegerType, LongType, StringType, StructField, StructType, TimestampType,
)


def _layout(**fields):
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


REQUESTS = _layout(video_key=StringType(), bucket_size=IntegerType(), kind=StringType())
VIDEO_METADATA = _layout(
    video_key=StringType(), name=StringType(), hyperlink=StringType(), path=StringType(),
    byte_offset=LongType(), filesize=LongType(), recorded_at=TimestampType(), seq=LongType(),
)
VIDEO_BLOCKS = _layout(
    video_key=StringType(), bucket_size=IntegerType(), kind=StringType(), recorded_at=TimestampType(), seq=LongType(),
)
FRAME_EVENTS = _layout(
    video_key=StringType(), stream_index=IntegerType(), pts_us=LongType(), seq=LongType(),
)
PIXELS = _layout(
    video_key=StringType(), frame_index=LongType(), r=IntegerType(), g=IntegerType(), b=IntegerType(),
)
FRAME_COLORS = _layout(
    video_key=StringType(), frame_index=LongType(), bucket_size=IntegerType(), kind=StringType(),
    r=IntegerType(), g=IntegerType(), b=IntegerType(),
)
STRIPS = _layout(
    video_key=StringType(), bucket_size=IntegerType(), kind=StringType(), x=LongType(),
    rgb=IntegerType(), width=LongType(), height=LongType(),
)
PNG_TILES = _layout(
    video_key=StringType(), bucket_size=IntegerType(), kind=StringType(), tile_x=LongType(),
    tile_y=LongType(), name=StringType(), width=IntegerType(), height=IntegerType(), png=BinaryType(),
)


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Fail early, by name, when an operator is given a table without the columns it reads."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing column(s) {missing}; got {df.columns}")
    return df
