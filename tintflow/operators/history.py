"""Append-only tables read as latest-wins records."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tintflow.functions.colour import parse_triple
from tintflow.session import join_on_group

KEPT_VERSIONS = 20
WRITTEN = ("recorded_at", "seq")


def last_versions(history: DataFrame, keys: list[str], *, kept: int = KEPT_VERSIONS,
                  written=WRITTEN) -> DataFrame:
    """The newest ``kept`` rows per key. Spark cuts each key down to ``kept`` rows before it shuffles."""
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in written])
    return (history.withColumn("_age", F.row_number().over(newest))
            .filter(F.col("_age") <= kept).drop("_age"))


def latest_record(history: DataFrame, keys: list[str], *, written=WRITTEN) -> DataFrame:
    """The newest row per key, whole."""
    return last_versions(history, keys, kept=1, written=written)


def latest_cells(history: DataFrame, keys: list[str], *, written=WRITTEN) -> DataFrame:
    """The newest non-null value per key and column, when writes may set only some of the columns."""
    cells = [c for c in history.columns if c not in keys and c not in written]
    stamp = F.struct(*written)
    return history.groupBy(*keys).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), stamp)).alias(c) for c in cells])


def append_history(df: DataFrame, path: str, *, partition_by=()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def replace_partitions(df: DataFrame, path: str, *, partition_by) -> None:
    """Overwrite only the partitions that ``df`` has rows for."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


VIDEO_CELLS = ["name", "hyperlink", "path", "byte_offset", "filesize"]
FRAME_KEY = ["video_key", "bucket_size", "kind", "frame_index"]
FRAME_PARTITIONS = ["kind", "bucket_size"]
RUN_KEY = ["video_key", "bucket_size", "kind"]


def upsert_video_metadata(ingested: DataFrame, path: str) -> None:
    append_history(ingested.select("video_key", *VIDEO_CELLS, *WRITTEN), path)


def read_video_metadata(spark: SparkSession, path: str) -> DataFrame:
    return latest_cells(spark.read.parquet(path), ["video_key"])


def merge_video_metadata(*writes: DataFrame) -> DataFrame:
    """One row per video from any number of write batches; each cell holds its last written value."""
    merged = writes[0]
    for batch in writes[1:]:
        merged = merged.unionByName(batch)
    return latest_cells(merged, ["video_key"])


def upsert_frame_colors(colors: DataFrame, path: str) -> None:
    append_history(colors, path, partition_by=FRAME_PARTITIONS)


def latest_runs(colors: DataFrame, *, written=WRITTEN) -> DataFrame:
    """The frames of the newest run per (video, bucket size, kind); a run's rows carry one stamp.

    A rerun with fewer frames thus leaves none of the frames before it. The newest stamps are partial maxima, and the
    rows of a large key are dealt over partitions when they meet them.
    """
    newest = colors.groupBy(*RUN_KEY).agg(F.max(F.struct(*written)).alias("_newest"))
    kept = join_on_group(colors, newest, RUN_KEY, ["frame_index"])
    return kept.filter(F.struct(*written) == F.col("_newest")).drop("_newest")


def recorded_runs(colors: DataFrame, runs: DataFrame, *, written=WRITTEN) -> DataFrame:
    """The frames of the newest run per (video, bucket size, kind) that ``runs``, the block records, has a record of.

    A record is written after the last frame of its run, so a run that ended half-way is not seen. The newest stamps come from the
    records, one row per run, and the frames are read once.
    """
    newest = latest_record(runs.select(*RUN_KEY, *written), RUN_KEY, written=written)
    return join_on_group(colors, newest, [*RUN_KEY, *written], ["frame_index"], "left_semi")


def read_frame_colors(spark: SparkSession, path: str, runs: DataFrame | None = None) -> DataFrame:
    """The newest colours of every frame; with ``runs``, of the runs recorded there only."""
    colors = spark.read.parquet(path)
    return latest_record(latest_runs(colors) if runs is None else recorded_runs(colors, runs), FRAME_KEY)


def merge_frame_colors(*writes: DataFrame) -> DataFrame:
    merged = writes[0]
    for batch in writes[1:]:
        merged = merged.unionByName(batch)
    return latest_record(merged, FRAME_KEY)


def split_addressed_triples(rows: DataFrame) -> DataFrame:
    """``average`` and ``dominant`` text triples of a frame to one typed row per kind, each from its own text."""
    long = rows.selectExpr(
        "* except (average, dominant)",
        "stack(2, 'average', average, 'dominant', dominant) as (kind, triple)")
    return long.select(*[c for c in long.columns if c != "triple"],
                       *[col.alias(name) for name, col in parse_triple("triple").items()])
