"""Reproducible shuffling into shards: a Feistel permutation of global row numbers, with cycle walking.

Rows are numbered from 0 in the order of their content, which no partitioning changes. A keyed Feistel network permutes the
smallest range of an even number of bits that holds the numbers; a value that falls outside the table is sent through again
until it falls inside, which keeps the whole a permutation. The new place p of a row gives shard p mod n and slot p div n,
so shards differ by one row at most and their slots have no gaps. Both directions are computed from the number of rows and
the seed alone: ``permuted`` says where a row goes, ``restored`` which row is in a slot.

Defined results: a null text has size 8 and checksum 0; null ids come first; equal rows are numbered one after the other and
get different places; an empty table gives no rows; other columns are not read.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tintflow.llm.common import numbered

ROUNDS = 6
REPEAT = 4096  # copies of a row that are written out in one piece


def mixed(x: np.ndarray, key: int) -> np.ndarray:
    """A round's function: 32 bits that depend on every bit of ``x`` and the key."""
    x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x >> np.uint64(32)


def half_bits(rows: int) -> int:
    return max(1, ((rows - 1).bit_length() + 1) // 2)


def round_keys(seed: int) -> list[int]:
    return [(seed * 0x2545F4914F6CDD1D + i * 0xDA942042E4DD58B5 + 1) % (1 << 64) for i in range(ROUNDS)]


def once(x: np.ndarray, bits: int, keys: list[int]) -> np.ndarray:
    mask, shift = np.uint64((1 << bits) - 1), np.uint64(bits)
    left, right = x >> shift, x & mask
    for key in keys:
        left, right = right, left ^ (mixed(right, key) & mask)
    return (left << shift) | right


def once_back(x: np.ndarray, bits: int, keys: list[int]) -> np.ndarray:
    mask, shift = np.uint64((1 << bits) - 1), np.uint64(bits)
    left, right = x >> shift, x & mask
    for key in reversed(keys):
        left, right = right ^ (mixed(left, key) & mask), left
    return (left << shift) | right


def walked(step, numbers, rows: int, seed: int) -> np.ndarray:
    x, bits, keys = np.asarray(numbers).astype(np.uint64), half_bits(rows), round_keys(seed)
    todo = np.arange(len(x))
    while len(todo):
        x[todo] = step(x[todo], bits, keys)
        todo = todo[x[todo] >= rows]
    return x.astype(np.int64)


def permuted(numbers, rows: int, seed: int) -> np.ndarray:
    return walked(once, numbers, rows, seed)


def restored(places, rows: int, seed: int) -> np.ndarray:
    return walked(once_back, places, rows, seed)


def shard(docs: DataFrame, shards: int = 24, seed: int = 1, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, size, text_crc32, law (``rows``), shard, slot, grown_shard (null under this law), row_number."""
    spark = docs.sparkSession
    binary = F.coalesce(F.col(text_column), F.lit("")).cast("binary")
    light = docs.select(F.col(id_column).alias("id"), (F.length(binary) + 8).cast("long").alias("size"), F.crc32(binary).alias("crc"),
                        F.xxhash64(F.col(text_column)).alias("content"))
    # Equal rows are counted before they move and written out again in pieces, so that many copies are no hot key.
    copies = light.groupBy("id", "size", "crc", "content").agg(F.count(F.lit(1)).alias("n"))
    pieces = copies.withColumn("from", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(REPEAT))))
    spread = pieces.withColumn("copy", F.explode(F.sequence("from", F.least(F.col("from") + REPEAT, F.col("n")) - 1)))
    rows = numbered(spread.drop("n", "from"), ["id", "size", "crc", "content", "copy"], "number", "row-numbers")
    total = rows.count()

    def run(batches):
        for batch in batches:
            places = permuted(batch.column(3).to_numpy(), total, seed)
            none = pa.nulls(batch.num_rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, range(3)), pa.array(["rows"] * batch.num_rows, pa.string()), pa.array(places % shards, pa.int32()),
                 pa.array(places // shards, pa.int64()), none, batch.column(3)],
                [id_column, "size", "text_crc32", "law", "shard", "slot", "grown_shard", "row_number"])

    id_type = docs.schema[id_column].dataType.simpleString()
    return rows.select("id", "size", "crc", "number").mapInArrow(
        run, f"`{id_column}` {id_type}, size long, text_crc32 long, law string, shard int, slot long, grown_shard int, row_number long")
