"""Analysis requests stored as short text files with one field per line."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LINE_BREAK = "\r\n|\n|\r"

# Meaning of the lines at each step a request can have reached (fixed values).
LAYOUTS = {
    "form": ("command", "video_key", "bucket_size", "kind"),
    "known": ("command", "video_key", "bucket_size", "kind"),
    "ingested": ("video_key", "name", "bucket_size", "kind"),
    "sampled": ("bucket_size", "video_key", "stem", "kind"),
    "analyzed": ("command", "video_key", "stem", "kind"),
}


def lines_of(text: Column) -> Column:
    """The lines of a text; a line break at its end opens no further line."""
    ending = F.when(text.endswith("\r\n"), 2).when(text.endswith("\n") | text.endswith("\r"), 1).otherwise(0)
    whole = F.left(text, F.length(text) - ending)
    return F.when(text.contains("\r"), F.split(whole, LINE_BREAK)).otherwise(F.split(whole, "\n"))


def parse_requests(texts: DataFrame, layout: str = "form", *, text: str = "value") -> DataFrame:
    """The lines of each text as named columns; a line that is not there is null."""
    lines = lines_of(F.col(text))
    fields = [F.get(lines, F.lit(i)).alias(name) for i, name in enumerate(LAYOUTS[layout])]
    return texts.select(*[c for c in texts.columns if c != text], *fields)


def read_requests(spark: SparkSession, path: str, layout: str = "form") -> DataFrame:
    return parse_requests(spark.read.text(path, wholetext=True), layout)
