"""Stored files of any size: read in byte ranges by many tasks, and written as streams.

A video or a container may hold many gigabytes, more than one row can. Files are therefore listed without their bytes and cut
into ranges; tasks read the ranges in pieces, and what they find is put together per file in range order. Containers are
written the other way round: one task appends the contents of a container, one after the other, to its file.

A range's digest is the SHA-256 of its bytes in hexadecimal. A file's digest is the SHA-256 of its ranges' digests one after
the other, so that it can be computed in parallel; it depends on the size of the ranges.
"""

import hashlib
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tintflow.operators.strip import explode_range
from tintflow.sources.files import read_videos

RANGE_BYTES = 64 << 20
PIECE = 1 << 20  # bytes that a task holds


def place_of(location: str):
    """File system and path of a location with or without a scheme; characters are taken as they are, not as escapes."""
    from pyarrow import fs
    named = re.match(r"([a-zA-Z][a-zA-Z0-9+.-]*):(//[^/]*)?", location)
    system = fs.LocalFileSystem() if not named or named[1] == "file" else fs.FileSystem.from_uri(named[0] + ("" if named[2] else "//"))[0]
    return system, re.sub("^/+", "/", location[named.end() if named else 0:])


def split_ranges(files: DataFrame, *, range_bytes: int = RANGE_BYTES, tasks: int | None = None) -> DataFrame:
    """One row per range of ``files`` (path, size and, for a part of a file, byte_offset): part, offset, length.

    A file without bytes has one range of no bytes. The rows are small and their work is large, so they are dealt over
    ``tasks`` partitions, by default as many as a shuffle has, which are not merged.
    """
    parts = explode_range(files, "part", f"greatest(1, (size + {range_bytes - 1}L) div {range_bytes}L)")
    start = F.col("byte_offset") if "byte_offset" in files.columns else F.lit(0).cast("long")
    ranges = (parts.withColumn("offset", start + F.col("part") * F.lit(range_bytes).cast("long"))
              .withColumn("length", F.least(F.lit(range_bytes).cast("long"), F.col("size") - F.col("part") * F.lit(range_bytes).cast("long"))))
    count = tasks or int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return ranges.repartition(count, "path", "offset")


def list_ranges(spark: SparkSession, path: str, *, glob: str = "*", range_bytes: int = RANGE_BYTES, tasks: int | None = None) -> DataFrame:
    """The ranges of all files below ``path``; no file is opened."""
    files = read_videos(spark, path, with_content=False, glob=glob).withColumnRenamed("video_key", "path")
    return split_ranges(files, range_bytes=range_bytes, tasks=tasks)


def stream(path: str, offset: int, length: int):
    """The bytes of a range, a piece at a time."""
    if not length:
        return
    system, place = place_of(path)
    with system.open_input_file(place) as file:
        file.seek(offset)
        while length:
            piece = file.read(min(PIECE, length))
            if not piece:
                raise EOFError(f"{path} ends {length} bytes before its range does")
            yield piece
            length -= len(piece)


def range_digests(ranges: DataFrame) -> DataFrame:
    """``ranges`` with the digest of each, read where the row lies; a task holds one piece of one file."""
    def run(batches):
        for batch in batches:
            digests = []
            for row in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("path", "offset", "length"))):
                digest = hashlib.sha256()
                for piece in stream(*row):
                    digest.update(piece)
                digests.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.string())], [*batch.schema.names, "digest"])

    return ranges.mapInArrow(run, StructType([*ranges.schema, StructField("digest", StringType())]))


def fold_ranges(digests: DataFrame, keys: list[str]) -> DataFrame:
    """Per file, or whatever ``keys`` name: its bytes, its number of ranges and its digest, in range order.

    A range leaves 64 characters, so that a file of ten terabytes gathers some ten megabytes.
    """
    parts = F.array_sort(F.collect_list(F.struct("part", "digest")))
    return digests.groupBy(*keys).agg(
        F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("ranges"),
        F.sha2(F.concat_ws("", F.transform(parts, lambda p: p["digest"])), 256).alias("digest"))


def read_files(spark: SparkSession, path: str, *, glob: str = "*", range_bytes: int = RANGE_BYTES, tasks: int | None = None) -> DataFrame:
    """One row per stored file of any size: path, name, bytes read, number of ranges and digest."""
    return fold_ranges(range_digests(list_ranges(spark, path, glob=glob, range_bytes=range_bytes, tasks=tasks)), ["path", "name"])


def append_in_order(rows: DataFrame, folder: str, *, name: str, order: list[str], content) -> DataFrame:
    """Write a file per ``name`` from its rows in ``order``: what ``content(batch, row)`` yields, as one stream.

    A file is one task's work, as a file has one writer, and is never held. It appears under its name only when it is whole, and
    replaces an older one; a task that runs again does no harm. Returns name, path, bytes and rows of each file.
    """
    def run(batches):
        target, root = place_of(folder)
        target.create_dir(root, recursive=True)
        open_name, out, unfinished, done, count = None, None, None, 0, 0

        def close():
            out.close()
            if target.get_file_info(f"{root}/{open_name}").type.name != "NotFound":
                target.delete_file(f"{root}/{open_name}")
            target.move(unfinished, f"{root}/{open_name}")
            return pa.RecordBatch.from_pydict({"name": [open_name], "path": [f"{folder.rstrip('/')}/{open_name}"], "bytes": [done], "rows": [count]})

        for batch in batches:
            names = batch.column(batch.schema.get_field_index(name)).to_pylist()
            for i, this in enumerate(names):
                if this != open_name:
                    if out is not None:
                        yield close()
                    open_name, unfinished, done, count = this, f"{root}/_{uuid.uuid4().hex}", 0, 0
                    out = target.open_output_stream(unfinished)
                for piece in content(batch, i):
                    out.write(piece)
                    done += len(piece)
                count += 1
        if out is not None:
            yield close()

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = rows.repartition(parts, name).sortWithinPartitions(name, *order)
    return sorted_rows.mapInArrow(run, "name string, path string, bytes long, rows long")


def write_joined(rows: DataFrame, folder: str, *, name: str = "name", order: list[str], content: str = "content") -> DataFrame:
    """Files made of the bytes in the rows of each name; null is no bytes."""
    def bytes_of(batch, i):
        found = batch.column(batch.schema.get_field_index(content))[i].as_py()
        return [found] if found else []

    return append_in_order(rows, folder, name=name, order=order, content=bytes_of)


def fill_containers(placed: DataFrame, folder: str, *, name: str = "name", order: str = "byte_offset", source: str = "source") -> DataFrame:
    """Containers made of stored files, each copied as a stream to its place; ``placed`` has the container's name, the place,
    the file (``source``) and its ``size``."""
    def copied(batch, i):
        path, size = (batch.column(batch.schema.get_field_index(c))[i].as_py() for c in (source, "size"))
        return stream(path, 0, size)

    return append_in_order(placed, folder, name=name, order=[order], content=copied)
