"""What the operators share: staging, gapless numbering, connected components."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tintflow.session import new_folder

# ASCII white space, as the contracts of the word-based operators define it.
WORD = r"[^\x20\x09-\x0D]+"


# Rows that go to a Python task at once. Texts may be long: ten thousand of them, Spark's own bound, may not fit a task.
BATCH_ROWS = 1000


def bound_batches(spark: SparkSession) -> None:
    """Lets the session send no more than ``BATCH_ROWS`` rows to a Python task at once; a smaller number stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, purpose: str, compression: str | None = None) -> DataFrame:
    """Written once as Parquet in the shared folder and read back, so that later reads prune columns and a lost
    executor never changes what was staged."""
    spark = df.sparkSession
    path = new_folder(spark, purpose)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or one made from it that ``df`` has no column of, upper and lower case being the same."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def place_in_files(docs: DataFrame) -> Column | None:
    """Where a row lies, if ``docs`` is a Parquet table read as it is: (hash of the file's path, number in the file).

    The same however a scan is split. The 64-bit hash tells a million files apart, but for a chance of 3 in 100 million.
    """
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        return None
    try:
        file = docs.metadataColumn("_metadata")
        if "row_index" not in docs.select(file).schema[0].dataType.names:
            return None
    except AnalysisException:
        return None
    return F.struct(F.xxhash64(file["file_path"]).alias("file"), file["row_index"].alias("at"))


def with_row(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column that tells its rows apart, and the column's name, which ``docs`` does not have.

    It must be the same in every scan, and files may be split in another way as executors come and go. Rows of a Parquet table are
    known by their place in its files, so that nothing is copied; others are numbered and stored once.
    """
    bound_batches(docs.sparkSession)
    name, place = unused(docs, "row"), place_in_files(docs)
    if place is not None:
        return docs.select("*", place.alias(name)), name
    return staged(docs.withColumn(name, F.monotonically_increasing_id()), "numbered-rows", "zstd"), name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, order_by: list, name: str, purpose: str) -> DataFrame:
    """``df`` staged with a gapless long ``name`` from 0 in the order of ``order_by``.

    Rows are range-partitioned, sorted and numbered inside their partition; the only thing gathered is one row
    per partition with its size. Rows that are equal in ``order_by`` are neighbours in any order.
    """
    spark = df.sparkSession
    parts = shuffle_partitions(spark)
    local = F.monotonically_increasing_id()
    rows = staged(df.repartitionByRange(parts, *order_by).sortWithinPartitions(*order_by)
                  .withColumn("_local", local), purpose)
    rows = (rows.withColumn("_part", F.shiftright("_local", 33))
            .withColumn("_local", F.col("_local").bitwiseAND(F.lit((1 << 33) - 1))))
    sizes = {r["_part"]: r["n"] for r in rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, total = [], 0
    for part in sorted(sizes):
        starts.append((part, total))
        total += sizes[part]
    # One row per partition: bounded by the number of shuffle partitions.
    offsets = spark.createDataFrame(starts, "_part long, _start long")
    return (rows.join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_start") + F.col("_local")).drop("_part", "_start", "_local"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long), component being the smallest node reachable.

    Alternating large and small stars: each round points every node at the smallest neighbour it has seen, and
    the number of rounds grows with the logarithm of the longest path. Each round is staged; the driver sees one
    count. Hubs are reduced by partial minima, and their edges are split by adaptive skew joins.
    """
    now = staged(edges.where("a <> b").selectExpr("greatest(a, b) as u", "least(a, b) as v").distinct(), "edges")
    seen = None
    while True:
        both = now.unionByName(now.selectExpr("v as u", "u as v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = staged(both.join(least, "u").where("v > u").selectExpr("v as u", "m as v").distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        now = staged(large.join(least, "u").selectExpr("v as u", "m as v")
                     .unionByName(least.selectExpr("u", "m as v")).where("u <> v").distinct(), "small-star")
        # The stars are final when a round leaves the same set of edges.
        state = tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if state == seen or not state[0]:
            break
        seen = state
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.selectExpr("u as node", "v as component").unionByName(roots)
