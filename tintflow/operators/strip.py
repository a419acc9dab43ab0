"""Colour strips: one column per frame of a video."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tintflow.functions.colour import pack_rgb
from tintflow.operators.filters import has_all_channels
from tintflow.operators.ordering import number_rows

STRIP = ["video_key", "bucket_size", "kind"]


def color_strip(frames: DataFrame, keys=tuple(STRIP), *, chunks: int | None = None) -> DataFrame:
    """Columns of each strip: complete frames in frame order, then a black one per incomplete frame."""
    keys = list(keys)
    blank = ~has_all_channels()
    marked = frames.select(*keys, "frame_index", blank.alias("_blank"), F.when(blank, F.lit(0)).otherwise(pack_rgb()).alias("rgb"))
    after = F.col("frame_index").cast("long") + F.when(F.col("_blank"), F.lit(1 << 61)).otherwise(0)
    numbered = number_rows(marked, keys, ["_blank", "frame_index"], number="_n", total="width", along=after, chunks=chunks)
    return numbered.select(
        *keys,
        (F.col("_n") - 1).alias("x"),
        "rgb",
        "width",
        F.greatest(F.lit(1).cast("long"), F.expr("width div 4")).alias("height"),
    )


def scale_factor(width: str = "width") -> Column:
    """Enlargement by the strip's size in pixels: below 8, below 50, or none (fixed values)."""
    area = F.expr(f"{width} * ({width} div 5)")
    return F.when(area < 8, 200).when(area < 50, 160).otherwise(1)


def strip_scale(strip: DataFrame) -> DataFrame:
    """Enlarge short strips: every column is repeated, and the height grows alike."""
    scaled = strip.withColumn("_scale", scale_factor())
    return (
        scaled.withColumn("_k", F.explode(F.expr("sequence(0, _scale - 1)")))
        .withColumn("x", F.expr("x * _scale + _k"))
        .withColumn("width", F.expr("width * _scale"))
        .withColumn("height", F.expr("height * _scale"))
        .drop("_scale", "_k")
    )


def explode_range(df: DataFrame, name: str, count: str, *, run: int = 4096) -> DataFrame:
    """One row per ``name`` in 0..count-1, in two steps, so that no array is longer than a run or a list of runs."""
    return (
        df.withColumn("_from", F.explode(F.expr(f"sequence(0L, cast({count} as long) - 1, {run}L)")))
        .withColumn(name, F.explode(F.expr(f"sequence(_from, least(_from + {run - 1}, cast({count} as long) - 1))")))
        .drop("_from")
    )


def strip_raster(strip: DataFrame) -> DataFrame:
    """Every pixel of the strips: all rows of a strip are equal. For export and inspection only."""
    return explode_range(strip, "y", "height")


def gradient(rasters: DataFrame) -> DataFrame:
    """Test raster of the given ``width`` and ``height``: red grows downwards, green to the right, blue is 128."""
    pixels = explode_range(explode_range(rasters, "y", "height"), "x", "width")
    ramp = {"r": "cast(y * 255 div greatest(height - 1, 1) as int)",
            "g": "cast(x * 255 div greatest(width - 1, 1) as int)"}
    return (pixels.withColumns({name: F.expr(rule) for name, rule in ramp.items()})
            .withColumn("b", F.lit(128)).withColumn("rgb", pack_rgb()))
