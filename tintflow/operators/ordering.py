"""Numbering and running values along ordered groups of any size.

A plain window sorts each group in one task, so a group with a third of all rows would be one task's work. Only the
groups that hold more than a chunk's share of the rows are therefore cut, at quantiles of the column they are ordered by, and
windows run per (group, chunk): that is the only exchange of the rows. What a chunk needs to know about the chunks of its group before
it is carried in a small table, which is broadcast without counting it first: fewer groups than chunks are cut, and all of
them together into less than two pieces per chunk.

Where the order has no such column, and where chunks must be runs of all rows, the rows are range-partitioned by (group, order):
each chunk is a contiguous run, and only its first and its last group can lie in more than one chunk. Those chunks are staged
in the shared folder, because both the carried table and the rows must see the same cuts.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from tintflow.session import hot_keys, read_again, staged

CHUNK = "_chunk"
HOT = "_is_cut"
LEAST_CHUNK = 20_000  # rows that are not worth another chunk, unless a number of chunks is asked for


def cut_into_chunks(df: DataFrame, keys: list[str], order: list, chunks: int | None = None) -> DataFrame:
    count = [chunks] if chunks else []
    return staged(df.repartitionByRange(*count, *keys, *order).withColumn(CHUNK, F.spark_partition_id()))


def across_chunks(chunked: DataFrame, keys: list[str], *measures: Column) -> DataFrame:
    """The measures per (group, chunk), for groups that lie in more than one chunk."""
    return (
        chunked.groupBy(*keys, CHUNK).agg(*measures)
        .withColumn("_pieces", F.count("*").over(Window.partitionBy(*keys)))
        .filter("_pieces > 1").drop("_pieces")
    )


def with_carried(rows: DataFrame, carried: DataFrame, keys: list[str]) -> DataFrame:
    """Give each row what its group carries into its chunk, if anything; rows without a group form one group."""
    place = {name: f"_of_{name}" for name in [*keys, CHUNK]}
    same = [F.col(name).eqNullSafe(F.col(other)) for name, other in place.items()]
    return rows.join(F.broadcast(carried.withColumnsRenamed(place)), same, "left").drop(*place.values())


def earlier_chunks(keys: list[str]):
    """Window over the rows of ``across_chunks`` that belong to earlier chunks of the same group."""
    return Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)


def can_cut(df: DataFrame, along) -> bool:
    """Whether ``along`` has quantiles."""
    kind = df.select(along).schema[0].dataType
    return isinstance(kind, (NumericType, DateType, TimestampType, TimestampNTZType))


def cut_hot_groups(df: DataFrame, keys: list[str], along, chunks: int | None = None) -> tuple[DataFrame, bool]:
    """``df`` with the chunk of each row, and whether any group has more than one.

    A group with more than one in ``chunks`` of the rows (as many as a shuffle has partitions) is cut into as many pieces as that
    share, but into none of fewer than ``LEAST_CHUNK`` rows on average; ``along`` must not fall along the group's order, and rows that are equal in it stay together. The cuts are
    found once, so that every later read has the same. ``HOT`` marks the rows of groups that are cut.
    """
    spark, total = df.sparkSession, df.count()
    count = chunks or min(int(spark.conf.get("spark.sql.shuffle.partitions")), total // LEAST_CHUNK)
    hot = hot_keys(df, keys, count) if count > 1 else None
    if hot is None or hot.isEmpty():
        return df.withColumn(CHUNK, F.lit(0)).withColumn(HOT, F.lit(False)), False
    place = {name: f"_of_{name}" for name in keys}
    same = [F.col(name).eqNullSafe(F.col(other)) for name, other in place.items()]
    grid = [k / count for k in range(1, count)]
    value = F.col(along) if isinstance(along, str) else along
    large = df.join(F.broadcast(hot.drop("_hot").withColumnsRenamed(place)), same, "left_semi")
    # The ends of a group's pieces: the quantiles that share its rows evenly among them.
    pieces = F.least(F.lit(count), F.ceil(F.col("_rows") * count / total).cast("int"))
    ends = F.transform(F.sequence(F.lit(1), pieces - 1), lambda i: F.get("_grid", F.floor(i * count / pieces).cast("int") - 1))
    cuts = (large.groupBy(*keys).agg(F.count("*").alias("_rows"), F.percentile_approx(value, grid, 100 * count).alias("_grid"))
            .select(*keys, F.when(pieces > 1, F.array_sort(F.array_distinct(ends))).otherwise(F.slice("_grid", 1, 0)).alias("_cuts")))
    # Fewer than ``count`` rows, which hold less than two cuts per chunk.
    cuts = F.broadcast(spark.createDataFrame(cuts.collect(), cuts.schema).withColumnsRenamed(place))
    joined = df.join(cuts, same, "left").drop(*place.values())
    # Binary search: how many cuts lie below the value.
    steps = [1 << k for k in range(count.bit_length(), -1, -1)]

    def further(at, step):
        return F.when((at + step <= F.size("_cuts")) & (F.get("_cuts", at + step - 1) < value), at + step).otherwise(at)

    piece = F.when(F.col("_cuts").isNotNull() & value.isNotNull(), F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), further))
    return joined.withColumn(CHUNK, F.coalesce(piece, F.lit(0))).withColumn(HOT, F.col("_cuts").isNotNull()).drop("_cuts"), True


def number_rows(df: DataFrame, keys: list[str], order: list, *, number: str = "row_no",
                total: str | None = None, along=None, chunks: int | None = None) -> DataFrame:
    """Number the rows of each group from 1 in the given order; optionally add the size of the group.

    Sums over chunks give exactly ``row_number()`` and ``count(*)`` per group. ``along`` is a number or a time that does not
    fall in the given order, by which large groups can be cut: by default the first of ``order``, if it is a plain column of that kind.
    """
    if along is None and isinstance(order[0], str) and can_cut(df, order[0]):
        along = order[0]
    if along is None:
        chunked, cut = cut_into_chunks(df, keys, order, chunks).withColumn(HOT, F.lit(True)), True
    else:
        chunked, cut = cut_hot_groups(read_again(df), keys, along, chunks)
    here = Window.partitionBy(*keys, CHUNK)
    counted = chunked.withColumn("_here", F.row_number().over(here.orderBy(*order)).cast("long"))
    if total:
        counted = counted.withColumn("_size_here", F.count("*").over(here))
    if cut:
        carried = (
            across_chunks(chunked.filter(HOT), keys, F.count("*").alias("_rows"))
            .withColumn("_before", F.sum("_rows").over(earlier_chunks(keys)))
            .withColumn("_all", F.sum("_rows").over(Window.partitionBy(*keys)))
            .drop("_rows")
        )
        counted = with_carried(counted, carried, keys)
    else:
        counted = counted.withColumns({"_before": F.lit(0), "_all": F.lit(None)})
    numbered = counted.withColumn(number, F.col("_here") + F.coalesce("_before", F.lit(0)))
    if total:
        numbered = numbered.withColumn(total, F.coalesce("_all", "_size_here"))
    return numbered.drop(CHUNK, HOT, "_here", "_size_here", "_before", "_all")


def frame_ordinals(lines: DataFrame, keys: list[str], order: list, *, first: int = 1,
                   chunks: int | None = None) -> DataFrame:
    """Give usable manifest lines their frame index: from 1 in row keys, from 0 in file names."""
    numbered = number_rows(lines, keys, order, number="frame_index", chunks=chunks)
    return numbered.withColumn("frame_index", F.col("frame_index") + F.lit(first - 1))


def ordered_frames(frames: DataFrame) -> DataFrame:
    return frames.orderBy("video_key", "frame_index")
