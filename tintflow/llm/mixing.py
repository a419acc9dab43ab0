"""Mixing sources to target weights by entropy balancing.

Every source has a target number of words. Among all ways to reach the targets, document rates closest to one in relative
entropy are exponential tilts of the size: rate = min(cap, exp(lambda * size)), one lambda per source. The lambdas are
the solution of the convex dual, found by Newton steps that are kept inside a bracket. Each step is one aggregation over
the table of (source, size, number of documents), which is all that rates depend on. The rates are then rounded to copies:
per source, from the largest size down, a class of equal documents takes the whole number of copies that brings the words
taken so far nearest to what is due, and a hash order chooses which of the class get the one copy more.

Targets: all words are shared by the weights, which repeat over the sources in code point order, null last. A source
gets ``cap`` times its words at most, and the excess is reshared until none is above.

Defined results: a null text has size 0, is taken once and adds nothing; a null source is a source; copies of a row are
decided one by one, so equal rows may differ in ``taken`` by one copy; all sizes zero or an empty table give targets of 0;
other columns are not read.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tintflow.llm.common import WORD, numbered, staged

TOLERANCE = 1e-9  # of a source's target
STEPS = 100


def same(left: DataFrame, right: DataFrame, *keys: str):
    """Equal keys, null being equal to null."""
    return [left[k].eqNullSafe(right[k]) for k in keys]


def source_targets(classes: DataFrame, weights: tuple, cap: float) -> DataFrame:
    """(source, source_size, target) from (source, size, n)."""
    sizes = classes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    placed = numbered(sizes, [F.asc_nulls_last("source")], "place", "sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    placed = placed.withColumn("weight", weight).withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    total = float(placed.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1  # a source gets min(most, weight * level); the level rises as sources become full
    while True:
        above = F.col("weight") * F.lit(level) > F.col("most")
        rest, free, now = placed.agg(
            F.lit(total) - F.sum(F.when(above, F.col("most")).otherwise(0.0)),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))), F.sum(above.cast("long"))).first()
        if now == full or not free:
            break
        level, full = rest / free, now
    return placed.select("source", "source_size", F.least("most", F.col("weight") * F.lit(level)).alias("target"))


def tilts(classes: DataFrame, cap: float) -> DataFrame:
    """(source, tilt): the dual solution from (source, size, n, source_size, target), null where every rate is the cap."""
    open_ = F.col("target") < F.lit(cap) * F.col("source_size")
    # Sizes in units of the source's mean, so that a tilt of one is moderate in every source.
    scaled = staged(classes.where(open_ & (F.col("size") > 0)), "dual")
    state = staged(scaled.groupBy("source").agg(F.lit(0.0).alias("tilt"), F.lit(-math.inf).alias("low"),
                                                F.lit(math.inf).alias("high")), "tilts")
    for _ in range(STEPS):
        joined = scaled.join(state.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
        exponent = F.col("tilt") * F.col("size") / F.col("mean_size")
        words = F.col("n") * F.col("size") * F.exp(F.least(exponent, F.lit(math.log(cap))))
        slope = F.when(exponent < math.log(cap), words * F.col("size") / F.col("mean_size")).otherwise(0.0)
        step = joined.groupBy("source", "tilt", "low", "high", "target").agg(
            F.sum(words).alias("taken"), F.sum(slope).alias("slope"))
        gap = F.col("taken") - F.col("target")
        step = (step.withColumn("gap", gap / F.greatest("target", F.lit(1.0)))
                .withColumn("high", F.when(gap > 0, F.col("tilt")).otherwise(F.col("high")))
                .withColumn("low", F.when(gap <= 0, F.col("tilt")).otherwise(F.col("low"))))
        newton = F.col("tilt") - F.when(F.col("slope") > 0, gap / F.col("slope"))
        inside = (newton > F.col("low")) & (newton < F.col("high"))
        bounded = (F.col("low") > -math.inf) & (F.col("high") < math.inf)
        further = F.when(gap > 0, F.col("tilt") * 2 - 1).otherwise(F.col("tilt") * 2 + 1)
        next_tilt = F.when(inside, newton).when(bounded, (F.col("low") + F.col("high")) / 2).otherwise(further)
        step = staged(step.select("source", "low", "high", "gap", "tilt", next_tilt.alias("next")), "tilts")
        worst = step.agg(F.max(F.abs("gap"))).first()[0]
        if worst is None or worst <= TOLERANCE:
            return step.select("source", "tilt")
        state = step.select("source", F.col("next").alias("tilt"), "low", "high")
    return step.select("source", "tilt")


def round_copies(classes: pd.DataFrame, cap: int) -> pd.DataFrame:
    """Copies of one source's classes; its rows are its distinct sizes. What a large size could not round off falls to the
    next smaller one, so that the source ends within half of its smallest size unless every document is at its cap."""
    classes = classes.sort_values("size", ascending=False, kind="stable")
    copies, owed = [], 0.0
    for size, n, rate in zip(classes["size"], classes["n"], classes["rate"]):
        due = n * rate
        taken = n if not size else min(max(round(due + owed / size), 0), cap * n)
        owed += (due - taken) * size
        copies.append(taken)
    return classes.assign(copies=np.array(copies, dtype="int64"))[["source", "size", "n", "start", "source_size", "target", "copies"]]


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
        weights: tuple = (5, 2, 1), cap: int = 3, *, row: str | None = None) -> DataFrame:
    """Per row: id, size, source_size, target, copies, taken and ``_row``, which is the column ``row`` of ``docs``, or a number.

    A caller that joins it back names the column of ``with_row``.
    """
    rows = docs.select(
        (F.col(row) if row else F.monotonically_increasing_id()).alias("_row"), F.col(id_column).alias("id"), F.col(source_column).alias("source"),
        F.coalesce(F.regexp_count(text_column, F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    rows = numbered(staged(rows, "word-counts"), [F.asc_nulls_last("source"), F.desc("size"), F.xxhash64("id"), F.col("id")], "place", "sizes")
    classes = staged(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("start")), "classes")
    targets = source_targets(classes, weights, float(cap))
    counts = classes.groupBy("source").agg(F.sum("n").alias("docs"))
    targets = staged(targets.join(counts, same(targets, counts, "source")).select(
        targets["source"], "source_size", "target", (F.col("source_size") / F.col("docs")).alias("mean_size")), "targets")
    classes = classes.join(targets, same(classes, targets, "source")).select(
        classes["source"], "size", "n", "start", "source_size", "target", "mean_size")
    tilt = tilts(classes, float(cap))
    rate = F.when(F.col("tilt").isNull(), F.when(F.col("size") > 0, float(cap)).otherwise(1.0)).otherwise(
        F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean_size"), F.lit(math.log(cap)))))
    rated = classes.join(tilt, same(classes, tilt, "source"), "left").select(
        classes["source"], "size", "n", "start", "source_size", "target", rate.alias("rate"))
    kind = dict(docs.dtypes)[source_column]
    rounded = rated.groupBy("source").applyInPandas(
        lambda rows: round_copies(rows, cap), f"source {kind}, size long, n long, start long, source_size long, target double, copies long")
    rounded = staged(rounded, "copies")
    index = F.col("place") - F.col("start")
    copies = F.floor(F.col("copies") / F.col("n")) + F.when(index < F.col("copies") % F.col("n"), 1).otherwise(0)
    return (rows.join(rounded, same(rows, rounded, "source", "size"))
            .select("_row", F.col("id").alias(id_column), rows["size"], "source_size", "target", copies.cast("long").alias("copies"))
            .withColumn("taken", F.col("copies") * F.col("size")))
