"""Stored files as rows: videos as opaque bytes, and directory listings.

Spark's file listing leaves out files without bytes and those whose names begin with a dot or an underscore.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tintflow.functions.naming import last_part


def read_videos(spark: SparkSession, path: str, *, with_content: bool = True, glob: str = "*",
                recursive: bool = True) -> DataFrame:
    """One row per stored video: key (its location), name, byte count and, if wanted, the bytes."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", recursive).load(path))
    columns = [F.col("path").alias("video_key"), last_part(F.col("path")).alias("name"),
               F.col("length").alias("size"), F.col("modificationTime").alias("recorded_at")]
    return files.select(*columns, *(["content"] if with_content else []))


def write_files(files: DataFrame, folder: str, *, name: str = "name", content: str = "content") -> DataFrame:
    """Write the bytes of each row as a file of its name, from the executor that has them; the rows without them, with ``path``.

    A file appears under its name only when it is whole, and replaces an older one; a task that runs again does no harm.
    """
    def write(batches):
        from pyarrow import fs
        target, root = fs.FileSystem.from_uri(folder)
        target.create_dir(root, recursive=True)
        for batch in batches:
            for part in batch[[name, content]].itertuples(index=False):
                unfinished = f"{root}/_{uuid.uuid4().hex}"
                with target.open_output_stream(unfinished) as out:
                    out.write(part[1])
                target.move(unfinished, f"{root}/{part[0]}")
            yield batch.drop(columns=[content]).assign(path=[f"{folder.rstrip('/')}/{n}" for n in batch[name]])

    return files.mapInPandas(write, files.drop(content).schema.add("path", "string"))


def remove_files(files: DataFrame, folder: str, *, name: str = "name") -> DataFrame:
    """Remove the files of these names from ``folder`` in the tasks; the names. One that is gone already does no harm."""
    def remove(batches):
        from pyarrow import fs
        target, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for file in batch[name]:
                if target.get_file_info(f"{root}/{file}").type == fs.FileType.File:
                    target.delete_file(f"{root}/{file}")
            yield batch

    return files.select(name).mapInPandas(remove, files.select(name).schema)


def list_files(spark: SparkSession, path: str, *, recursive: bool = True) -> DataFrame:
    """Path and modification time of the files in a directory; no file is opened."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path)
            .select(F.regexp_replace("path", "/[^/]*$", "").alias("directory"), "path",
                    F.col("modificationTime").alias("modified_at")))


def latest_file(files: DataFrame, keys=()) -> DataFrame:
    """The last modified file (per key); of equally old ones the first path."""
    newest = F.min(F.struct((-F.unix_micros("modified_at")).alias("age"), F.col("path").alias("path")))
    return (files.groupBy(*keys).agg(newest.alias("_file")).filter("_file is not null")
            .select(*keys, F.col("_file.path").alias("path"),
                    (-F.col("_file.age")).alias("modified_us")))
