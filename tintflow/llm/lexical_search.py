"""Ranked lexical search for many queries at once, sharing what they have in common.

A document's score for an item is the sum, over the item's distinct terms, of integer impacts:
``w * ((10^9 * tf) div (1000 * tf + 8 * m))`` with ``w = floor(1000 * ln((2N + 2) / (2 df + 1)))`` and
``m = 10 + (90 * n * N) div L``: N documents have a term, L terms in all, n in the document.

Sharing. Terms that occur in the same items form one node, whose accumulator is filled once. Of the nodes, the pair that
most items hold becomes a node of its own, and so on until no pair is in two items: a directed acyclic graph in
which an accumulator is made once, from two others, and used by all that lead to it. A block of documents of the index is
evaluated along the graph, a bounded number of documents at a time, and each accumulator is dropped after its last use.
An item's own terms are added to it directly. Each block returns the best of each item, and the best of those are the result.

Items come in slices of bounded size, each with a graph of its own; every slice meets the whole index.

Defined results: null and empty texts have no terms; such items have no rows, such documents are in none; equal scores go
by ascending document id, null last; equal documents and items are ranked one by one; other columns are not read.
"""

import heapq
import math
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tintflow.llm.inverted_index import BLOCK_WORDS, build, item_slices, positions, term_counts

SLICE_WORDS = 100_000
MINED = 300  # items of more shared nodes than this take them one by one: pairs grow with the square
AT_ONCE = 4096  # documents evaluated together


class Graph(NamedTuple):
    """``node``: the node of each term (by number), ``pairs``: the nodes after those of terms, each the sum of two earlier ones;
    ``items``: per item the nodes that add up to its score."""

    node: np.ndarray
    pairs: list[tuple[int, int]]
    items: list[list[int]]


def sharing_graph(items: list[list[int]], terms: int) -> Graph:
    """The graph of items given as lists of distinct term numbers below ``terms``."""
    holders: list[list[int]] = [[] for _ in range(terms)]
    for i, held in enumerate(items):
        for term in held:
            holders[term].append(i)
    nodes: dict[tuple, int] = {}
    node = np.array([nodes.setdefault(tuple(h), len(nodes)) for h in holders], np.int64)
    sets = [set(node[held]) for held in items]
    shared = {n for h, n in nodes.items() if len(h) > 1}
    mined = [i for i, s in enumerate(sets) if len(s & shared) <= MINED]
    holding: dict[tuple[int, int], set[int]] = {}
    for i in mined:
        own = sorted(sets[i] & shared)
        for j, a in enumerate(own):
            for b in own[j + 1:]:
                holding.setdefault((a, b), set()).add(i)
    heap = [(-len(h), pair) for pair, h in holding.items() if len(h) > 1]
    heapq.heapify(heap)
    pairs, following = [], len(nodes)
    while heap:
        uses, pair = heapq.heappop(heap)
        now = {i for i in holding[pair] if pair[0] in sets[i] and pair[1] in sets[i]}
        if len(now) < 2:
            continue
        if len(now) < -uses:
            holding[pair] = now
            heapq.heappush(heap, (-len(now), pair))
            continue
        beside: dict[int, set[int]] = {}
        for i in now:
            sets[i] -= set(pair)
            for other in sets[i] & shared:
                beside.setdefault(other, set()).add(i)
            sets[i].add(following)
        for other, h in beside.items():
            if len(h) > 1:
                holding[other, following] = h
                heapq.heappush(heap, (-len(h), (other, following)))
        shared.add(following)
        pairs.append((int(pair[0]), int(pair[1])))
        following += 1
    return Graph(node, pairs, [sorted(map(int, s)) for s in sets])


def evaluate(graph: Graph, leaves, docs: int):
    """(item, scores of ``docs`` documents), item by item; ``leaves(node)`` makes the accumulator of a node of terms.

    An accumulator lives from its first to its last use.
    """
    first_pair = int(graph.node.max()) + 1 if len(graph.node) else 0
    left = Counter(n for held in graph.items for n in held)
    wanted = [False] * len(graph.pairs)
    for k in range(len(graph.pairs) - 1, -1, -1):
        if left[first_pair + k]:
            wanted[k] = True
            left.update(graph.pairs[k])
    made: dict[int, np.ndarray] = {}

    def use(n: int) -> np.ndarray:
        if n not in made:
            stack = [n]
            while stack:
                top = stack[-1]
                if top in made:
                    stack.pop()
                    continue
                if top < first_pair:
                    made[top] = leaves(top)
                    stack.pop()
                    continue
                missing = [x for x in graph.pairs[top - first_pair] if x not in made]
                if missing:
                    stack.extend(missing)
                    continue
                a, b = graph.pairs[top - first_pair]
                made[top] = made[a] + made[b]
                for x in (a, b):
                    left[x] -= 1
                    if not left[x]:
                        del made[x]
                stack.pop()
        return made[n]

    for i, held in enumerate(graph.items):
        scores = np.zeros(docs, np.int64)
        for n in held:
            scores += use(n)
            left[n] -= 1
            if not left[n]:
                del made[n]
        yield i, scores


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Slice(NamedTuple):
    """What the task of a block needs of a slice of items: the numbers and weights of its terms, the graph, and the items' places and ids."""

    number: dict[bytes, int]
    weights: np.ndarray
    graph: Graph
    places: list[int]
    ids: list


def ranking(items: Slice, documents: int, terms_in_all: int, k: int):
    """What a block's task does: its posting lists and documents to the best of each item."""
    def rank(terms: pa.Table, docs: pa.Table) -> pa.Table:
        docs = docs.sort_by("at")
        firsts, n = docs.column("first").to_numpy().astype(np.int64), docs.column("n").to_numpy().astype(np.int64)
        doc_ids = docs.column("id").combine_chunks()
        by_id = np.empty(len(docs), np.int64)
        by_id[pc.sort_indices(doc_ids, null_placement="at_end").to_numpy()] = np.arange(len(docs))
        m = 10 + 90 * n * documents // max(terms_in_all, 1)
        numbers = np.array([items.number.get(t, -1) for t in terms.column("term").to_pylist()], np.int64)
        at, lengths = positions(terms.column("postings"))
        term = np.repeat(numbers, lengths)
        doc = np.searchsorted(firsts, at, side="right") - 1
        doc, term = doc[term >= 0], term[term >= 0]
        new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])]) if len(doc) else np.empty(0, np.int64)
        tf = np.diff(np.r_[new, len(doc)])
        doc, term = doc[new], term[new]
        impact = items.weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
        node = items.graph.node[term]
        order = np.lexsort((doc, node))
        node, doc, impact = node[order], doc[order], impact[order]
        nodes = int(items.graph.node.max()) + 1 if len(items.graph.node) else 0
        out = {"item": [], "place": [], "score": []}
        for start in range(0, len(docs), AT_ONCE):
            size = min(AT_ONCE, len(docs) - start)
            here = (doc >= start) & (doc < start + size) if len(docs) > AT_ONCE else slice(None)
            near, by, value = doc[here] - start, node[here], impact[here]
            cuts = np.searchsorted(by, np.arange(nodes + 1))

            def leaves(n, near=near, value=value, cuts=cuts, size=size):
                part = slice(cuts[n], cuts[n + 1])
                total = np.zeros(size, np.int64)
                np.add.at(total, near[part], value[part])
                return total

            for item, scores in evaluate(items.graph, leaves, size):
                chosen = np.flatnonzero(scores > 0)
                if len(chosen) > k:
                    least = np.partition(scores, -k)[-k]
                    chosen = np.flatnonzero(scores >= max(least, 1))
                chosen = chosen[np.lexsort((by_id[start + chosen], -scores[chosen]))][:k]
                out["item"].append(np.full(len(chosen), item))
                out["place"].append(start + chosen)
                out["score"].append(scores[chosen])
        item, chosen, score = (np.concatenate(c).astype(np.int64) if c else np.empty(0, np.int64) for c in out.values())
        item_ids = pa.array(items.ids, docs.schema.field("item_id").type)
        return pa.table({"item": pa.array(items.places, pa.int64()).take(pa.array(item)), "item_id": item_ids.take(pa.array(item)),
                         "id": doc_ids.take(pa.array(chosen)), "score": pa.array(score)})

    return rank


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_column: str = "doc_id", text_column: str = "text",
           item_column: str = "item_id", item_text: str = "text", *, block_words: int = BLOCK_WORDS) -> DataFrame:
    """item id, rank (from 1), document id and score of the ``k`` best documents of each item with a score above 0."""
    index = build(docs, id_column, text_column, block_words=block_words)
    documents, terms_in_all = index.docs.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum(F.col("n").cast("long"))).first()
    kind = {c: d.select(c).schema[0].dataType.simpleString() for d, c in ((docs, id_column), (items, item_column))}
    schema = f"item long, item_id {kind[item_column]}, id {kind[id_column]}, score long"
    found, numbers = item_slices(items, item_column, item_text, SLICE_WORDS)
    best = None
    for number in numbers:
        # A slice is bounded by what item_slices puts in it.
        held = found.where(F.col("slice") == number).select("item", "id", "words").collect()
        sets = [{bytes(w) for w in r["words"]} for r in held]
        rows, counts = term_counts(index, sorted(set().union(*sets)))
        weights = {t: weight(documents, counts[t][0]) for t in sorted(counts)}
        known = [t for t in weights if weights[t] > 0]
        place = {t: i for i, t in enumerate(known)}
        graph = sharing_graph([sorted(place[t] for t in s if t in place) for s in sets], len(known))
        of_slice = Slice(place, np.array([weights[t] for t in known], np.int64), graph, [r["item"] for r in held], [r["id"] for r in held])
        of_docs = index.docs.select("block", "at", "id", "first", "n", F.lit(None).cast(kind[item_column]).alias("item_id"))
        made = rows.groupBy("block").cogroup(of_docs.groupBy("block")).applyInArrow(
            ranking(of_slice, documents, terms_in_all, k), schema).withColumn("slice", F.lit(number))
        best = made if best is None else best.unionByName(made)
    if best is None:
        best = items.sparkSession.createDataFrame([], f"{schema}, slice long")
    # The best of each block: cut to k per item before they are shuffled.
    order = Window.partitionBy("slice", "item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select(F.col("item_id").alias(item_column), "rank", F.col("id").alias(id_column), "score"))
