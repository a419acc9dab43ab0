"""Near-duplicate vectors by cosine similarity: an epsilon grid order join.

Unit vectors link when their distance is at most epsilon = sqrt(2 - 2 * cosine). They are projected on leading principal
directions, which never lengthens a distance, and sorted by their grid cells of width epsilon. The sorted sequence is cut
into blocks with bounding boxes. Two intervals of the sequence are joined recursively: if their boxes lie farther apart
than epsilon no pair can link and both are skipped, else each is split; first between intervals of blocks, one round of
all open pairs at a time, then within the task that holds two blocks. What remains is compared exactly, in double precision.

A task returns, per vector, how many others of the two blocks it links with, and of the links only as many as connect what
they connect, so a group of k near copies gives k rows and not k * k. Equal vectors are one node with a weight.
The principal directions only steer the order: they are fitted on ``sample`` vectors, every vector is sorted and joined.

Defined results: vectors that are null, all zero or hold null or non-finite components link with nothing and are kept;
vectors link only with those of the same length; null ids are never the smallest unless there is no other, and such rows are
not kept twice: ``kept`` is whether the id equals the component's; equal rows get equal results; an empty table gives none.
"""

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tintflow.llm.common import components, numbered, staged

BLOCK = 4096  # vectors of a block
LEAF = 512  # vectors that are compared at once with as many
FAN = 8  # intervals into which a round splits an interval
DIRECTIONS = 6
SLACK = 1e-9  # boxes must be this much farther apart than epsilon to be skipped


def unit(v: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that squares neither overflow nor vanish."""
    v = v / np.abs(v).max(axis=1, keepdims=True, initial=1e-300)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def matrix(column, length: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), length)


def directions(vectors: DataFrame, length: int, sample: int) -> np.ndarray:
    """length x m, the leading principal directions of a bounded sample taken by hash."""
    taken = vectors.orderBy(F.xxhash64("v"), "v").limit(sample).select("v").toArrow()
    x = unit(matrix(taken.column("v"), length))
    _, vectors_ = np.linalg.eigh(np.cov(x, rowvar=False).reshape(length, length) if len(x) > 1 else np.eye(length))
    return np.ascontiguousarray(vectors_[:, ::-1][:, :min(DIRECTIONS, length)])


def in_grid_order(vectors: DataFrame, length: int, epsilon: float, sample: int) -> tuple[DataFrame, np.ndarray]:
    """node (the place in the order), v, weight and p, the projection."""
    along = directions(vectors, length, sample)
    shared = vectors.sparkSession.sparkContext.broadcast(along)

    def run(batches):
        for batch in batches:
            p = unit(matrix(batch.column(0), length)) @ shared.value
            cells = np.floor(p / epsilon).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(p), pa.list_(pa.float64())), pa.array(list(cells), pa.list_(pa.int32()))],
                ["v", "weight", "p", "cells"])

    placed = vectors.select("v", "weight").mapInArrow(run, "v array<double>, weight long, p array<double>, cells array<int>")
    return numbered(placed, ["cells", F.xxhash64("v"), "v"], "node", "grid-order").drop("cells"), along


def near_blocks(ordered: DataFrame, epsilon: float, m: int) -> DataFrame:
    """(a, b), a <= b: the pairs of blocks whose boxes are within epsilon, found from the whole sequence downward."""
    low, high = [f"low{i}" for i in range(m)], [f"high{i}" for i in range(m)]
    level = ordered.withColumn("at", F.floor(F.col("node") / BLOCK)).groupBy("at").agg(
        *[F.min(F.col("p")[i]).alias(low[i]) for i in range(m)], *[F.max(F.col("p")[i]).alias(high[i]) for i in range(m)])
    levels = [staged(level, "boxes")]
    blocks = levels[0].count()
    while FAN ** (len(levels) - 1) < blocks:
        level = levels[-1].withColumn("at", F.floor(F.col("at") / FAN)).groupBy("at").agg(
            *[F.min(c).alias(c) for c in low], *[F.max(c).alias(c) for c in high])
        levels.append(staged(level, "boxes"))
    pairs = None
    for boxes in reversed(levels):
        if pairs is None:
            open_ = boxes.select(F.col("at").alias("a"), F.col("at").alias("b"))
        else:
            children = F.explode(F.sequence(F.lit(0), F.lit(FAN - 1)))
            open_ = (pairs.withColumn("i", children).withColumn("j", children)
                     .select((F.col("a") * FAN + F.col("i")).alias("a"), (F.col("b") * FAN + F.col("j")).alias("b")).where("a <= b"))
        x = boxes.withColumnsRenamed({c: f"x_{c}" for c in low + high}).withColumnRenamed("at", "a")
        y = boxes.withColumnsRenamed({c: f"y_{c}" for c in low + high}).withColumnRenamed("at", "b")
        gap = sum((F.pow(F.greatest(F.lit(0.0), F.col(f"x_{p}") - F.col(f"y_{q}"), F.col(f"y_{p}") - F.col(f"x_{q}")), 2)
                   for p, q in zip(low, high)), F.lit(0.0))
        near = open_.join(x, "a").join(y, "b").where(F.sqrt(gap) <= epsilon + SLACK)
        pairs = staged(near.select("a", "b"), "near-blocks")
    return pairs


def compared(ordered: DataFrame, pairs: DataFrame, along: np.ndarray, length: int, cosine: float, epsilon: float) -> DataFrame:
    """Rows (a, n): n other vectors link with node a within a pair of blocks; rows (a, b): links that connect the same."""
    shared = ordered.sparkSession.sparkContext.broadcast(along)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("side", "ascending"), ("node", "ascending")])
        side, node = table.column("side").to_numpy(), table.column("node").to_numpy()
        weight = table.column("weight").to_numpy()
        x = unit(matrix(table.column("v"), length))
        p = x @ shared.value
        label, counts, edges = np.arange(len(node)), np.zeros(len(node), np.int64), []
        cut = int(np.searchsorted(side, 1))

        def leaf(i, j):
            linked = x[i] @ x[j].T >= cosine
            if i == j:
                linked &= ~np.eye(i.stop - i.start, dtype=bool)
            counts[i] += linked @ weight[j]
            if i != j:
                counts[j] += weight[i] @ linked
            for at in np.flatnonzero(linked.any(axis=1)):
                others = j.start + np.flatnonzero(linked[at])
                row = i.start + at
                roots, first = np.unique(label[others], return_index=True)
                new = roots != label[row]
                if new.any():
                    edges.extend((node[row], node[o]) for o in others[first[new]])
                    label[np.isin(label, roots[new])] = label[row]

        def join(i, j):
            a, b = p[i], p[j]
            gap = np.maximum(0, np.maximum(a.min(axis=0) - b.max(axis=0), b.min(axis=0) - a.max(axis=0)))
            if math.sqrt((gap * gap).sum()) > epsilon + SLACK:
                return
            if max(i.stop - i.start, j.stop - j.start) <= LEAF:
                leaf(i, j)
                return
            halves = [[s] if s.stop - s.start <= LEAF else
                      [slice(s.start, (s.start + s.stop) // 2), slice((s.start + s.stop) // 2, s.stop)] for s in (i, j)]
            for left in halves[0]:
                for right in halves[1]:
                    if i != j or left.start <= right.start:
                        join(left, right)

        if cut == len(node):
            join(slice(0, cut), slice(0, cut))
        else:
            join(slice(0, cut), slice(cut, len(node)))
        some = np.flatnonzero(counts)
        a, b = np.array(edges, np.int64).reshape(-1, 2).T
        none, nobody = pa.nulls(len(a), pa.int64()), pa.nulls(len(some), pa.int64())
        return pa.table({"a": np.r_[node[some], a], "b": pa.concat_arrays([nobody, pa.array(b)]),
                         "n": pa.concat_arrays([pa.array(counts[some]), none])})

    members = ordered.select(F.floor(F.col("node") / BLOCK).alias("block"), "node", "v", "weight")
    left = pairs.join(members, pairs["a"] == members["block"]).withColumn("side", F.lit(0))
    right = pairs.where("a < b").join(members, F.col("b") == members["block"]).withColumn("side", F.lit(1))
    return left.unionByName(right).drop("block").groupBy("a", "b").applyInArrow(run, "a long, b long, n long")


def link(vectors: DataFrame, cosine: float = 0.95, id_column: str = "vec_id", vector_column: str = "embedding",
         sample: int = 5000) -> DataFrame:
    """Per row: id, n_links, component_id, kept."""
    epsilon = math.sqrt(2 - 2 * cosine)
    raw = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = F.coalesce(F.col("v").isNotNull() & finite & F.exists("v", lambda c: c != 0), F.lit(False))
    classes = staged(raw.where(usable).groupBy("v").agg(F.count(F.lit(1)).alias("weight"), F.min("id").alias("least"))
                     .withColumn("length", F.size("v")), "vectors")
    nodes, results = [], []
    for row in classes.groupBy("length").count().orderBy("length").collect():
        length = row["length"]
        ordered, along = in_grid_order(classes.where(F.col("length") == length), length, epsilon, sample)
        pairs = near_blocks(ordered, epsilon, along.shape[1])
        # Nodes of different lengths must differ: each length has its own range of numbers.
        found = compared(ordered, pairs, along, length, cosine, epsilon)
        name = F.lit(len(nodes) << 48)
        results.append(staged(found.select((F.col("a") + name).alias("a"), (F.col("b") + name).alias("b"), "n"), "vector-links"))
        nodes.append(ordered.select((F.col("node") + name).alias("node"), "v"))
    if not nodes:
        return raw.select(F.col("id").alias(id_column), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"),
                          F.coalesce(F.col("id").isNotNull(), F.lit(False)).alias("kept"))
    nodes, results = reduce(DataFrame.unionByName, nodes), reduce(DataFrame.unionByName, results)
    counts = results.where("b is null").groupBy("a").agg(F.sum("n").alias("linked")).withColumnRenamed("a", "node")
    together = components(results.where("b is not null").select("a", "b"))
    placed = staged(classes.join(nodes, "v").join(counts, "node", "left").join(together, "node", "left")
                    .select("v", "weight", "least", "linked", F.coalesce("component", "node").alias("component")), "placed")
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = placed.join(least, "component").select(
        "v", (F.col("weight") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component_id")
    joined = raw.withColumn("v", F.when(usable, F.col("v"))).join(named, "v", "left")
    alone = F.col("n_links").isNull()
    component = F.when(alone, F.col("id")).otherwise(F.col("component_id"))
    return joined.select(F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
