"""Keys, file names and paths."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def padded_index(index: str, *, compat: bool = False) -> Column:
    """Frame number as 7 characters; ``compat`` gives 6 characters from 1,000 on, as older stores hold."""
    text = F.col(index).cast("string")
    width = F.lit(7)
    if compat:
        width = F.when(F.col(index) < 1000, 7).otherwise(6)
    return F.when(F.length(text) >= width, text).otherwise(
        F.concat(F.repeat(F.lit("0"), (width - F.length(text)).cast("int")), text))


def frame_key(video_key: str, index: str, *, compat: bool = False) -> Column:
    return F.concat_ws("_", F.col(video_key).cast("string"), padded_index(index, compat=compat))


def last_part(path: Column) -> Column:
    return F.element_at(F.split(F.rtrim(path, F.lit("/")), "/"), -1)


def url_basename(url: str, *, path_only: bool = False) -> Column:
    """Text after the last slash of the whole URL, or of its path without query and fragment."""
    return last_part(F.try_parse_url(F.col(url), F.lit("PATH")) if path_only else F.col(url))


def stem(name: Column) -> Column:
    """A file name up to its first dot."""
    return F.substring_index(name, ".", 1)


def timestamp_slug(ts: str) -> Column:
    """Wall-clock time usable in a directory name: at least one, no trailing zero, fraction digits."""
    text = F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS")
    return F.translate(F.regexp_replace(text, r"(\.\d+?)0*$", "$1"), ": .", "---")


def clean_name(name: str) -> Column:
    return F.translate(name, "()%", "")


def frame_path(folder, stem_col: str, slug: str, index: str) -> Column:
    """``<folder>/<stem>-<slug>/<stem><index>.png``"""
    return F.concat(F.lit(folder), F.lit("/"), F.col(stem_col), F.lit("-"), F.col(slug), F.lit("/"),
                    F.col(stem_col), F.col(index).cast("string"), F.lit(".png"))
