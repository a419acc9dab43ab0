"""Session defaults and the shared folder for staged data."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows a table may have to be broadcast; every use counts the rows first, or states why fewer are certain.
BROADCAST_ROWS = 100_000
# Hashes that rows are counted by for each of the parts that a large key exceeds.
HASHES_A_SHARE = 16

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Pictures and videos are many small files: by Spark's own estimate of 4 MB to open one, a task would read 32 of them.
    "spark.sql.files.openCostInBytes": "65536",
    # A query runs many jobs, and what each one exchanged is not read again once it has ended.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def apply_defaults(spark: SparkSession) -> SparkSession:
    for name, value in DEFAULTS.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor reaches: the one the cluster names, a temporary one only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if not named:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
            named = tempfile.mkdtemp(prefix="tintflow-")
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """Written once as Parquet in the shared folder and read back: lost executors never change what was staged, and
    later reads take only the columns they need."""
    path = new_folder(df.sparkSession, "staged")
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_again(df: DataFrame) -> DataFrame:
    """``df`` itself where it selects from files, which is cheap to do again and gives the same; otherwise staged."""
    node = df._jdf.queryExecution().analyzed()
    while node.getClass().getSimpleName() in ("Project", "Filter", "SubqueryAlias") and node.deterministic():
        node = node.child()
    return df if node.getClass().getSimpleName() == "LogicalRelation" else staged(df)


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    return df.limit(rows + 1).count() <= rows


def join_on_group(rows: DataFrame, per_group: DataFrame, key: str | list[str], spread_by: list[str],
                  how: str = "inner", salts: int = 64, small: bool | None = None) -> DataFrame:
    """Join a large table with few rows per ``key`` value where one key may hold much of the large table.

    The small side is broadcast after its rows were counted (by a caller passing ``small``, or here, staged
    first so that what it was computed from is read once). A semi join needs no more than the engine's own splitting of
    large partitions. Otherwise the keys that hold more than one in ``salts`` of the rows, at most ``salts`` of them, are
    found by a count over the key columns; only their rows are dealt over partitions, and only their rows of the other
    side repeated.
    """
    if small is None:
        per_group = staged(per_group)
        small = is_small(per_group)
    if small:
        return rows.join(F.broadcast(per_group), key, how)
    if how == "left_semi":
        return rows.join(per_group, key, how)
    keys = [key] if isinstance(key, str) else key
    hot = hot_keys(rows, keys, salts)
    any_null = F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))
    spread = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    # Rows without a key meet nothing, so they may lie anywhere.
    dealt = (rows.join(F.broadcast(hot), keys, "left")
             .withColumn("_salt", F.when(F.col("_hot") | any_null, spread).otherwise(0)).drop("_hot"))
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    repeated = (per_group.join(F.broadcast(hot), keys, "left")
                .withColumn("_salt", F.explode(F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0))))).drop("_hot"))
    return dealt.join(repeated, [*keys, "_salt"], how).drop("_salt")


def hot_keys(rows: DataFrame, keys: list[str], share: int) -> DataFrame:
    """The keys that hold more than one in ``share`` of the rows, so fewer than ``share``, marked ``_hot``.

    Rows are counted by a hash of their key first: only keys whose hash holds as many rows are counted themselves.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(HASHES_A_SHARE * share))
    sizes = rows.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_count")).collect()
    least = sum(size["_count"] for size in sizes) / share
    full = [size["_bucket"] for size in sizes if size["_count"] > least]
    counts = rows.filter(bucket.isin(full)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_count"))
    found = counts.filter(F.col("_count") > least).select(*keys).collect() if full else []
    return rows.sparkSession.createDataFrame(found, rows.select(*keys).schema).withColumn("_hot", F.lit(True))
