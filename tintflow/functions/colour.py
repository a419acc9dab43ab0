"""Column expressions on colour channels."""

from pyspark.sql import Column
from pyspark.sql import functions as F

CHANNELS = ("R", "G", "B")
SMALLEST_BUCKET, LARGEST_BUCKET = 1, 255


def valid_size(bucket_size: int) -> Column:
    if not SMALLEST_BUCKET <= bucket_size <= LARGEST_BUCKET:
        raise ValueError(f"a bucket size lies between {SMALLEST_BUCKET} and {LARGEST_BUCKET}, not {bucket_size}")
    return F.lit(bucket_size)


def bucketize(channel, bucket_size) -> Column:
    """Lower bound of the interval of width ``bucket_size`` that holds the channel value."""
    value = F.col(channel) if isinstance(channel, str) else channel
    size = F.col(bucket_size) if isinstance(bucket_size, str) else valid_size(bucket_size)
    return value - value % size


def unpack_rgb(rgb) -> dict[str, Column]:
    """The three channels of a packed pixel; bits above 24 (alpha) are ignored."""
    return {
        "r": F.shiftright(rgb, 16).bitwiseAND(F.lit(255)),
        "g": F.shiftright(rgb, 8).bitwiseAND(F.lit(255)),
        "b": F.col(rgb).bitwiseAND(F.lit(255)) if isinstance(rgb, str) else rgb.bitwiseAND(F.lit(255)),
    }


def pack_rgb(r="r", g="g", b="b") -> Column:
    blue = F.col(b) if isinstance(b, str) else b
    return F.shiftleft(r, 16).bitwiseOR(F.shiftleft(g, 8)).bitwiseOR(blue)


def parse_triple(triple: str) -> dict[str, Column]:
    """``"R;G;B"`` text to three integers."""
    part = F.split(triple, ";")
    return {name: F.get(part, F.lit(i)).cast("int") for i, name in enumerate("rgb")}


def bucket_label(r, g, b) -> Column:
    """Text form of a joint bucket; its byte order decides between equally frequent colours."""
    columns = [F.col(c) if isinstance(c, str) else c for c in (r, g, b)]
    return F.concat_ws(",", *[F.concat(F.lit(f"{name} "), c.cast("string")) for name, c in zip(CHANNELS, columns)])


def parse_bucket_label(label: str) -> dict[str, Column]:
    parts = F.split(label, ",")
    return {
        name: F.get(F.split(F.get(parts, F.lit(i)), " "), F.lit(1)).cast("int")
        for i, name in enumerate("rgb")
    }
