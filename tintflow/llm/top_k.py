"""Exact top-k search by distributed histogram selection.

Components are scaled and floored to integers, so that scores are exact integers. For a block of queries, every vector is
scored; each partition adds its scores to one histogram per query, the sums tell which bin holds the query's kth best
score, and the next round scores all again into the bins of that bin, until it is one score wide. Then every partition
keeps the scores from the kth value up, at most the k best of them in its own order, and the k best of these are the result.

Queries are taken in blocks of a fixed number of bytes; a block is all that is sent to the executors at once, and whatever
the number of queries, no task holds more than a block and a batch of vectors. Histograms are bounded by a block, too.

Defined results: vectors that are null or hold null or non-finite components take no part; vectors are compared with
those of the same length only; a query's own row is no candidate, but a repeated row is; null ids come last among equal scores and are no
queries; an empty table gives no rows. Scores that do not fit a long are cut to its ends.
"""

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tintflow.llm.common import numbered, staged

BINS = 64
BLOCK_QUERIES, BLOCK_BYTES = 1024, 8_000_000  # of queries that are sent out at once
SLICE = 2048  # vectors scored at once
EXACT = 2.0 ** 53
LONG = (1 << 63) - 1


def vector_rows(vectors: DataFrame, id_column: str, vector_column: str, scale: float) -> DataFrame:
    """id, row, v (array of double, whole numbers), length; row tells repeated rows apart."""
    def usable(c):
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))

    def floored(c):  # beyond 2 ** 52 doubles are whole, and floor() would leave the range of a long
        return F.when(F.abs(c * scale) < 2.0 ** 52, F.floor(c * scale).cast("double")).otherwise(c * scale)

    raw = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("raw"))
    rows = raw.where(F.col("raw").isNotNull() & F.forall("raw", usable)).select("id", F.transform("raw", floored).alias("v"))
    return numbered(rows.withColumn("length", F.size("v")), ["id", F.xxhash64("v")], "row", "vectors")


class Scores:
    """Exact scores of vectors with a block of queries of the same length."""

    def __init__(self, queries: np.ndarray):
        self.queries, self.most = queries, float(np.abs(queries).max(initial=0))

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """queries x vectors, int64."""
        if self.most * float(np.abs(vectors).max(initial=0)) * vectors.shape[1] < EXACT:
            return (self.queries @ vectors.T).astype(np.int64)
        exact = [[sum(int(a) * int(b) for a, b in zip(q, v)) for v in vectors] for q in self.queries]
        return np.clip(np.array(exact, object), -LONG - 1, LONG).astype(np.int64)


def first_bins(ends: pd.DataFrame, k: int) -> dict[int, tuple[int, int, int, int]]:
    """Per query with more than k candidates: the lowest and highest score, the width of a bin, and how many to find. Python integers."""
    return {q: (low, high, -(-(high - low + 1) // BINS), k)
            for q, low, high, n in ends[["q", "low", "high", "n"]].itertuples(index=False) if n > k}


def search_block(vectors: DataFrame, queries: pd.DataFrame, length: int, k: int) -> DataFrame:
    """query_id, rank, vec_id, score of one block of queries; vectors: id, row, v of that length."""
    spark, n = vectors.sparkSession, len(queries)
    q_rows = queries["row"].to_numpy(np.int64)
    q = spark.sparkContext.broadcast(np.array(queries["v"].tolist(), np.float64).reshape(n, length))

    def scored(batches, wanted):
        scores = Scores(q.value[wanted])
        for batch in batches:
            v = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, length)
            rows = batch.column(1).to_numpy()
            for at in range(0, batch.num_rows, SLICE):
                here = slice(at, at + SLICE)
                yield batch.column(0)[here], rows[here], scores.of(v[here]), rows[None, here] != q_rows[wanted][:, None]

    def bounds(batches):
        low, high, count = np.full(n, LONG), np.full(n, -LONG - 1), np.zeros(n, np.int64)
        for _, _, found, other in scored(batches, np.arange(n)):
            low = np.minimum(low, np.where(other, found, LONG).min(axis=1))
            high = np.maximum(high, np.where(other, found, -LONG - 1).max(axis=1))
            count += other.sum(axis=1)
        yield pa.RecordBatch.from_pydict({"q": np.arange(n), "low": low, "high": high, "n": count})

    ends = (vectors.mapInArrow(bounds, "q long, low long, high long, n long").groupBy("q")
            .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).toPandas())
    kth = np.full(n, -LONG - 1)  # queries with k candidates or fewer take all
    bins = first_bins(ends, k)
    while bins:
        state = spark.sparkContext.broadcast(bins)

        def histograms(batches):
            wanted = np.array(sorted(state.value))
            counts = np.zeros((len(wanted), BINS), np.int64)
            for _, _, found, other in scored(batches, wanted):
                for i, q_ in enumerate(wanted.tolist()):
                    start, last, step, _ = state.value[q_]
                    # Scores past the chosen bin are counted as above already; the new bins may reach over its end.
                    inside = found[i][other[i] & (found[i] >= start) & (found[i] <= last)]
                    place = (inside - start).view(np.uint64) // np.uint64(step)
                    counts[i] += np.bincount(place.astype(np.int64), minlength=BINS)
            at, bin_ = np.nonzero(counts)
            yield pa.RecordBatch.from_pydict({"q": wanted[at], "bin": bin_, "n": counts[at, bin_]})

        counted = vectors.mapInArrow(histograms, "q long, bin long, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))
        need = spark.createDataFrame([(q_, left) for q_, (*_, left) in bins.items()], "q long, need long")
        upward = Window.partitionBy("q").orderBy(F.desc("bin"))
        chosen = (counted.withColumn("upto", F.sum("n").over(upward)).join(F.broadcast(need), "q").where("upto >= need")
                  .groupBy("q").agg(F.max(F.struct("bin", F.expr("upto - n as above"))).alias("best")))
        following = {}
        for q_, bin_, above in chosen.select("q", "best.bin", "best.above").collect():  # a row per query of the block
            low, last, width, left = bins[q_]
            low += bin_ * width
            last = min(last, low + width - 1)
            if low == last:
                kth[q_] = low
            else:
                following[q_] = low, last, -(-(last - low + 1) // BINS), left - above
        bins = following
    limit = spark.sparkContext.broadcast(kth)

    def survivors(batches):
        held = [[] for _ in range(n)]
        for ids, rows, found, other in scored(batches, np.arange(n)):
            ids = ids.to_pylist()
            at_q, at = np.nonzero(other & (found >= limit.value[:, None]))
            for i in np.unique(at_q):
                here = [(-int(found[i, j]), ids[j] is None, ids[j] or 0, int(rows[j])) for j in at[at_q == i]]
                held[i] = sorted(held[i] + here)[:k]
        out = [(i, None if none else id_, -score, row) for i, kept in enumerate(held) for score, none, id_, row in kept]
        columns = zip(*out) if out else ((),) * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["q", "vec_id", "score", "row"])

    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    ids = spark.createDataFrame([(i, int(x)) for i, x in enumerate(queries["id"])], "q long, query_id long")
    kept = vectors.mapInArrow(survivors, "q long, vec_id long, score long, row long")
    return (kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .join(F.broadcast(ids), "q").select("query_id", "rank", "vec_id", "score"))


def search(vectors: DataFrame, k: int = 10, every: int = 100, scale: float = 1024.0, id_column: str = "vec_id",
           vector_column: str = "embedding") -> DataFrame:
    """The k best of all other vectors for each whose id is divisible by ``every``: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    rows = vector_rows(vectors, id_column, vector_column, scale)
    queries = rows.where(F.col("id") % every == 0)
    found = []
    for length, n in queries.groupBy("length").count().orderBy("length").collect():
        block = min(BLOCK_QUERIES, max(1, BLOCK_BYTES // (8 * max(1, length))))
        same = rows.where(F.col("length") == length).select("id", "row", "v")
        asked = numbered(queries.where(F.col("length") == length).select("id", "row", "v"), ["row"], "place", "queries")
        for start in range(0, n, block):
            chosen = asked.where(F.col("place").between(start, start + block - 1)).select("id", "row", "v").toPandas()
            found.append(staged(search_block(same, chosen, length, k), "best"))
    result = "query_id long, rank int, vec_id long, score long"
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], result)
