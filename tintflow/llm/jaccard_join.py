"""Near-duplicate documents by the Jaccard similarity of their word n-grams: a size-aware heavy-light join.

A document's set holds the distinct runs of ``width`` words; fewer words make one run, no words an empty set, which is
linked with nothing. Two sets link when 100 * common >= percent * united. Documents with the same set are one node, known
by a 128-bit hash of the set; shingles are 64-bit hashes.

Candidates. Small sets, up to a boundary, write a key for each subset of the sizes that a link needs (the overlap of a
link between sets of a and b shingles is at least need(a, b)). Large sets scan inverted lists, to which a set belongs
by its first shingles in a global order, as many as a link may miss plus one. The order puts frequent shingles last: the
counts of all documents decide for the shingles low in hash order, from which nearly all these firsts come, and the
bound that makes a shingle frequent leaves at most four million of them. The boundary is the size up to which keys of
subsets cost no more than the scans would.

Lists of up to ``LIST`` sets are written as pairs, which are cut down exactly: by size and
by what is left after a shared shingle in the order, then by a lower bound of the symmetric difference from small parity bitmaps, then by the sets themselves. Longer lists, which remain where many
documents consist of the same frequent shingles, are not written as pairs: sets that share such a list form a block, the
block is ordered by size and cut into chunks, and every two chunks whose sizes allow a link are compared in one task,
which returns no more links than connect its sets.

Components are found over the links; nothing about all documents reaches the driver but the frequent shingles, a
histogram of small sizes and counts.

Defined results: null and empty texts have 0 shingles and are their own component; a null id never becomes the
component of others unless all ids there are null; equal rows stay rows; other columns are not read.
"""

import hashlib
import itertools
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tintflow.llm.common import components, numbered, shuffle_partitions, staged, with_row
from tintflow.session import is_small

LIST = 48  # sets of an inverted list that is written as pairs; more where shingles must be in more documents to be frequent
FREQUENT = 8  # documents beyond which a shingle may count as frequent
MOST_FREQUENT = 4_000_000  # shingles that may count as frequent
CHUNK = 256  # sets on either side of a task that compares long lists
SMALL = 24  # the boundary is at most this size: beyond it, subsets are never cheaper
SCAN_COST = 3.0  # reading a list and looking at its pairs, in units of writing one key
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)
LOWEST = -(1 << 63)
REMEMBERED = 1 << 17  # words whose hashes a task remembers
ROWS = 1000  # texts whose sets a task holds at once


# Sets --------------------------------------------------------------------------------------------------------------

class Words(dict):
    """Hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def in_pieces(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def shingles(text: str | None, width: int, known: Words) -> np.ndarray:
    """Distinct shingle hashes, ascending as signed 64-bit integers."""
    # bytes.lower() and bytes.split() touch exactly A-Z and the ASCII white space.
    words = (text or "").encode().lower().split()
    if len(known) > REMEMBERED:
        known.clear()
    if len(words) < width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=1)] if words else [], np.uint64).view(np.int64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n, total = len(words) - width + 1, np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        total = total * FACTORS[0] + mixed(hashes[i:i + n] + FACTORS[1])
    return np.unique(mixed(total).view(np.int64))


def identity(found: np.ndarray) -> tuple[int, int]:
    high, low = np.frombuffer(hashlib.blake2b(found.tobytes(), digest_size=16).digest(), np.int64)
    return int(high), int(low)


def bitmap(found: np.ndarray) -> bytes:
    """A bit per residue, set where an odd number of shingles falls; at least half as many bits as shingles."""
    bits = max(64, 1 << (max(1, len(found) // 2) - 1).bit_length())
    odd = np.bincount((found & (bits - 1)), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def at_least_different(a: bytes, b: bytes) -> int:
    """A lower bound of the symmetric difference of the sets behind two bitmaps."""
    if len(a) < len(b):
        a, b = b, a
    x, bits = int.from_bytes(a, "little"), 8 * len(a)
    while bits > 8 * len(b):
        bits //= 2
        x = (x >> bits) ^ (x & ((1 << bits) - 1))
    return (x ^ int.from_bytes(b, "little")).bit_count()


class Rule:
    """What ``percent`` means for sizes; integers only."""

    def __init__(self, percent: int):
        self.percent = percent

    def need(self, a: int, b: int) -> int:
        """Shingles that sets of a and b must share to link."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def least(self, n: int) -> int:
        """Size of the smallest set that can link with one of n."""
        return -(-self.percent * n // 100)

    def first(self, n: int) -> int:
        """How many shingles of a set in the global order hold one of every set it links with."""
        return n - self.least(n) + 1

    def zone(self) -> int:
        """Hashes below this bound are counted; they are 1.6 times as many as the firsts."""
        return LOWEST + int(1.6 * (1 - self.percent / 100) * 2 ** 64)

    def subset_sizes(self, n: int, boundary: int) -> list[int]:
        return sorted({self.need(m, n) for m in range(self.least(n), min(boundary, n * 100 // self.percent) + 1)})


def set_rows(docs: DataFrame, width: int, rule: Rule) -> DataFrame:
    """_row, id, n, hi, lo, zoned (shingles in the counted zone), low (these and the next firsts; all of a small set), bitmap."""
    def run(batches):
        known, zone = Words(), rule.zone()
        for batch in in_pieces(batches):
            out = {name: [] for name in ("n", "hi", "lo", "zoned", "low", "bitmap")}
            for text in batch.column(2):
                found = shingles(text.as_py(), width, known)
                zoned = int(np.searchsorted(found, zone))
                high, low = identity(found)
                kept = len(found) if len(found) <= SMALL else zoned + rule.first(len(found))
                row = (len(found), high, low, zoned, found[:kept], bitmap(found))
                for column, value in zip(out.values(), row):
                    column.append(value)
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *map(pa.array, out.values(), kinds)], ["_row", "id", *out])

    row_type, id_type = (docs.schema[c].dataType.simpleString() for c in ("_row", "id"))
    return docs.select("_row", "id", "text").mapInArrow(
        run, f"_row {row_type}, id {id_type}, n int, hi long, lo long, zoned int, low array<long>, bitmap binary")


# Keys --------------------------------------------------------------------------------------------------------------

def frequent_shingles(sets: DataFrame) -> tuple[np.ndarray, int]:
    """Ascending, and the number of documents beyond which they are frequent. Each counts more than 1 / MOST_FREQUENT of all
    counted shingles, so there are no more than that."""
    total = sets.agg(F.sum(F.col("zoned").cast("long"))).first()[0] or 0
    bound = max(FREQUENT, total // MOST_FREQUENT)
    counted = sets.select(F.explode(F.expr("slice(low, 1, zoned)")).alias("shingle")).groupBy("shingle").count()
    found = counted.where(F.col("count") > bound).select("shingle").toPandas()["shingle"]
    return np.sort(found.to_numpy(np.int64)), bound


def size_boundary(sets: DataFrame, rule: Rule) -> int:
    """The largest size up to which writing subsets costs no more than scanning inverted lists."""
    sizes = {r["n"]: r["count"] for r in sets.where(F.col("n").between(1, SMALL)).groupBy("n").count().collect()}
    best, subsets, scans = 0, 0.0, 0.0
    for n in range(1, SMALL + 1):
        most = n * 100 // rule.percent
        subsets += sizes.get(n, 0) * sum(comb(n, k) for k in rule.subset_sizes(n, most))
        scans += sizes.get(n, 0) * rule.first(n) * SCAN_COST
        if subsets <= scans:
            best = n
    return best


def key_rows(sets: DataFrame, rule: Rule, frequent: np.ndarray, boundary: int) -> DataFrame:
    """key, hi, lo, n, at: what a set is listed under, and how many of its shingles come before in the global order (0 for
    subsets). A task writes the keys of a set once."""
    shared = sets.sparkSession.sparkContext.broadcast(frequent)  # at most MOST_FREQUENT numbers

    def keys_of(n: int, zoned: int, low: np.ndarray, frequent: np.ndarray) -> list[tuple[np.ndarray, bool]]:
        found = []
        if n <= boundary:
            for k in rule.subset_sizes(n, boundary):
                chosen = np.array(list(itertools.combinations(low.view(np.uint64), k)), np.uint64).reshape(-1, k)
                found.append((mixed(chosen.sum(axis=1, dtype=np.uint64) * FACTORS[2] + np.uint64(k)).view(np.int64), False))
        if n * 100 // rule.percent > boundary:
            inside = low[:zoned]
            if len(frequent):
                often = frequent[np.minimum(np.searchsorted(frequent, inside), len(frequent) - 1)] == inside
                low = np.concatenate([inside[~often], low[zoned:], inside[often]])
            found.append((low[:rule.first(n)], True))
        return found

    def run(batches):
        frequent, written = shared.value, set()
        for batch in batches:
            keys, high, low, sizes, places = [], [], [], [], []
            flat = batch.column(4).flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum([len(x) for x in batch.column(4)])
            for h, lo, n, zoned, end, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                                  batch.column(2).to_pylist(), batch.column(3).to_pylist(), ends,
                                                  np.diff(ends, prepend=0)):
                if (h, lo) in written:
                    continue
                if len(written) < 1 << 18:
                    written.add((h, lo))
                for found, ordered in keys_of(n, zoned, flat[end - size:end], frequent):
                    keys.append(found)
                    places.append(np.arange(len(found)) if ordered else np.zeros(len(found), np.int64))
                    high.append(h)
                    low.append(lo)
                    sizes.append(n)
            if keys:
                times = [len(k) for k in keys]
                yield pa.RecordBatch.from_pydict({
                    "key": np.concatenate(keys), "hi": np.repeat(np.array(high, np.int64), times),
                    "lo": np.repeat(np.array(low, np.int64), times), "n": np.repeat(np.array(sizes, np.int32), times),
                    "at": np.concatenate(places).astype(np.int32)})

    return sets.where("n > 0").select("hi", "lo", "n", "zoned", "low").mapInArrow(
        run, "key long, hi long, lo long, n int, at int")


def pair_rows(keys: DataFrame, rule: Rule, longest: int) -> DataFrame:
    """From all lists: pairs of nodes (key null) of lists up to ``longest``, members (b null) of longer ones.

    Of a pair, enough shingles must be left from here on: at the first one that both hold, all others that they share follow.
    """
    def pairs_of(rows: np.ndarray):
        """rows: key, hi, lo, n, at, sorted, without repeats, in whole lists."""
        starts = np.flatnonzero(np.r_[True, rows["key"][1:] != rows["key"][:-1]])
        sizes = np.diff(np.r_[starts, len(rows)])
        for k in np.unique(sizes[(sizes > 1) & (sizes <= longest)]):
            at = starts[sizes == k][:, None]
            i, j = np.triu_indices(k, 1)
            a, b = rows[(at + i).ravel()], rows[(at + j).ravel()]
            n, m = a["n"].astype(np.int64), b["n"].astype(np.int64)
            need = -(-rule.percent * (n + m) // (100 + rule.percent))
            near = (rule.percent * np.maximum(n, m) <= 100 * np.minimum(n, m)) & (np.minimum(n - a["at"], m - b["at"]) >= need)
            if near.any():
                yield a[near], b[near], False
        for at, k in zip(starts[sizes > longest], sizes[sizes > longest]):
            yield rows[at:at + k], None, True

    def batch_of(a, b, long):
        none = np.ones(len(a), bool)
        return pa.RecordBatch.from_arrays([
            pa.array(a["key"], mask=None if long else none), pa.array(a["hi"]), pa.array(a["lo"]), pa.array(a["n"]),
            *[pa.array(a[c] if long else b[c], mask=none if long else None) for c in ("hi", "lo", "n")]],
            ["key", "a_hi", "a_lo", "a_n", "b_hi", "b_lo", "b_n"])

    def run(batches):
        kind = np.dtype([("key", np.int64), ("hi", np.int64), ("lo", np.int64), ("n", np.int32), ("at", np.int32)])
        held, long = np.empty(0, kind), None  # the unfinished last list; the key of a long one already being written
        for batch in batches:
            rows = np.empty(batch.num_rows, kind)
            for i, name in enumerate(kind.names):
                rows[name] = batch.column(i).to_numpy(zero_copy_only=False)
            rows = np.concatenate([held, rows])
            new = np.r_[True, (rows[1:] != rows[:-1])] if len(rows) else np.empty(0, bool)
            rows = rows[new]
            if long is not None:
                here = rows["key"] == long
                more = rows[here][1:]  # the first was written before and is kept to find repeats
                if len(more):
                    yield batch_of(more, None, True)
                if here.all():
                    held = rows[-1:]
                    continue
                rows, long = rows[~here], None
            if not len(rows):
                held = rows
                continue
            last = int(np.searchsorted(rows["key"], rows["key"][-1]))
            for found in pairs_of(rows[:last]) if last else ():
                yield batch_of(*found)
            held = rows[last:]
            if len(held) > longest:
                yield batch_of(held, None, True)
                long, held = int(held["key"][-1]), held[-1:]
        if long is None and len(held):
            for found in pairs_of(held):
                yield batch_of(*found)

    parts = shuffle_partitions(keys.sparkSession)
    ordered = keys.repartition(parts, "key").sortWithinPartitions("key", "hi", "lo")
    return ordered.mapInArrow(run, "key long, a_hi long, a_lo long, a_n int, b_hi long, b_lo long, b_n int")


# Links -------------------------------------------------------------------------------------------------------------

def maybe_linked(pairs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) whose bitmaps allow a link."""
    def run(batches):
        for batch in batches:
            a, b, n, m, x, y = (batch.column(i).to_pylist() for i in range(6))
            kept = [at_least_different(x[i], y[i]) <= n[i] + m[i] - 2 * rule.need(n[i], m[i]) for i in range(len(a))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(kept, pa.bool_()))

    maps = nodes.select("node", "n", "bitmap")
    both = (pairs.join(maps.toDF("a", "n", "x"), "a").join(maps.toDF("b", "m", "y"), "b")
            .select("a", "b", "n", "m", "x", "y"))
    return both.mapInArrow(run, "a struct<hi:long,lo:long>, b struct<hi:long,lo:long>")


def linked(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    def run(batches):
        for batch in batches:
            kept = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                kept.append(len(np.intersect1d(x, y, assume_unique=True)) >= rule.need(len(x), len(y)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(kept, pa.bool_()))

    both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b").select("a", "b", "x", "y")
    return both.mapInArrow(run, "a struct<hi:long,lo:long>, b struct<hi:long,lo:long>")


def long_list_blocks(members: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """Nodes of long lists as (node, block, chunk), and the pairs of chunks that can hold links."""
    heads = members.groupBy("key").agg(F.min("node").alias("head"))
    edges = members.join(heads, "key").selectExpr("node as a", "head as b")
    blocks = components(edges).withColumnRenamed("component", "block")
    sized = members.groupBy("node").agg(F.first("n").alias("n")).join(blocks, "node")
    placed = numbered(sized, ["block", "n", "node"], "place", "blocks")
    starts = placed.groupBy("block").agg(F.min("place").alias("start"))
    chunked = staged(placed.join(starts, "block").withColumn("chunk", F.floor((F.col("place") - F.col("start")) / CHUNK))
                     .select("node", "n", "block", "chunk"), "chunks")
    spans = chunked.groupBy("block", "chunk").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    i, j = spans.alias("i"), spans.alias("j")
    grid = i.join(j, (F.col("i.block") == F.col("j.block")) & (F.col("i.chunk") <= F.col("j.chunk"))
                  & (F.col("j.low") * rule.percent <= F.col("i.high") * 100))
    return chunked, grid.select("i.block", F.col("i.chunk").alias("i"), F.col("j.chunk").alias("j"))


def links_in_long_lists(members: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Enough links to connect all sets of long lists that links connect."""
    chunked, grid = long_list_blocks(members, rule)
    spread = {"block", "i", "j"}
    left = grid.join(chunked.withColumnRenamed("chunk", "i"), ["block", "i"]).select(*sorted(spread), "node", F.lit(0).alias("side"))
    right = (grid.where("i < j").join(chunked.withColumnRenamed("chunk", "j"), ["block", "j"])
             .select(*sorted(spread), "node", F.lit(1).alias("side")))
    rows = left.unionByName(right).join(sets, "node").select(
        *sorted(spread), "side", F.col("node.hi").alias("hi"), F.col("node.lo").alias("lo"), "set")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        found, side = list(rows["set"]), rows["side"].to_numpy()
        sizes = np.array([len(s) for s in found])
        bits = 1024
        maps = np.array([np.packbits((np.bincount(s & (bits - 1), minlength=bits) & 1).astype(np.uint8)) for s in found])
        maps = maps.view(np.uint64)
        root = list(range(len(found)))

        def top(x):
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        out, alone = [], not side.any()
        for x in np.flatnonzero(side == 0):
            others = np.arange(x + 1, len(found)) if alone else np.flatnonzero(side == 1)
            need = -(-rule.percent * (sizes[x] + sizes[others]) // (100 + rule.percent))
            apart = np.bitwise_count(maps[others] ^ maps[x]).sum(axis=1, dtype=np.int64)
            for y, least in zip(others[apart <= sizes[x] + sizes[others] - 2 * need],
                                need[apart <= sizes[x] + sizes[others] - 2 * need]):
                if top(x) != top(y) and len(np.intersect1d(found[x], found[y], assume_unique=True)) >= least:
                    root[top(x)] = top(y)
                    out.append((x, y))
        a, b = np.array(out, int).reshape(-1, 2).T
        hi, lo = rows["hi"].to_numpy(), rows["lo"].to_numpy()
        return pd.DataFrame({"a_hi": hi[a], "a_lo": lo[a], "b_hi": hi[b], "b_lo": lo[b]})

    found = rows.groupBy(*sorted(spread)).applyInPandas(compare, "a_hi long, a_lo long, b_hi long, b_lo long")
    return found.selectExpr("struct(a_hi as hi, a_lo as lo) as a", "struct(b_hi as hi, b_lo as lo) as b")


def sets_of(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, set) of the nodes, made again from the text of one document each."""
    def run(batches):
        known = Words()
        for batch in in_pieces(batches):
            found = [shingles(text.as_py(), width, known) for text in batch.column(0)]
            high, low = zip(*map(identity, found)) if found else ((), ())
            yield pa.RecordBatch.from_pydict({"hi": pa.array(high, pa.int64()), "lo": pa.array(low, pa.int64()),
                                              "set": pa.array(found, pa.list_(pa.int64()))})

    wanted = nodes.select("_row")
    if is_small(wanted, 1_000_000):
        wanted = F.broadcast(wanted)
    found = docs.join(wanted, "_row", "left_semi").select("text").mapInArrow(run, "hi long, lo long, set array<long>")
    return staged(found.selectExpr("struct(hi, lo) as node", "set"), "shingles")


def join(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 5, percent: int = 80, *,
         row: str | None = None) -> DataFrame:
    """Per row: id, n_shingles, component_id, ``_row``, what tells the row apart, and ``_group``, the ``_row`` of one of its component.

    The texts are read twice, and ``_row`` must be the same each time: it is the column ``row`` if a caller has taken
    one from ``with_row``, or else made here.
    """
    rule = Rule(percent)
    if row is None:
        docs, row = with_row(docs)
    docs = docs.select(F.col(row).alias("_row"), F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    sets = staged(set_rows(docs, width, rule), "sets")
    (frequent, bound), boundary = frequent_shingles(sets), size_boundary(sets, rule)
    candidates = staged(pair_rows(key_rows(sets, rule, frequent, boundary), rule, max(LIST, bound)), "candidates")
    node = "struct(hi, lo) as node"
    nodes = staged(sets.where("n > 0").groupBy("hi", "lo").agg(
        F.min("_row").alias("_row"), F.min("id").alias("least_id"), F.first("n").alias("n"), F.first("bitmap").alias("bitmap"))
        .selectExpr(node, "_row", "least_id", "n", "bitmap"), "nodes")

    pairs = candidates.where("key is null").selectExpr(
        "struct(a_hi as hi, a_lo as lo) as a", "struct(b_hi as hi, b_lo as lo) as b").distinct()
    members = candidates.where("key is not null").selectExpr("key", "struct(a_hi as hi, a_lo as lo) as node", "a_n as n")
    pairs = staged(maybe_linked(pairs, nodes, rule), "pairs")
    involved = pairs.select("a").union(pairs.select("b")).union(members.select("node")).toDF("node").distinct()
    found = sets_of(docs, nodes.join(involved, "node", "left_semi"), width)
    links = staged(linked(pairs, found, rule).unionByName(links_in_long_lists(members, found, rule)), "links")

    together = components(links)
    labels = together.join(nodes, "node").groupBy("component").agg(
        F.min("least_id").alias("label"), F.min("_row").alias("row"))
    labels = together.join(labels, "component").select("node", "label", "row")
    named = nodes.join(labels, "node", "left").selectExpr(
        "node.hi as hi", "node.lo as lo", "coalesce(label, least_id) as component_id",
        "coalesce(row, _row) as _group")
    return sets.join(named, ["hi", "lo"], "left").select(
        "_row", F.when(F.col("n") > 0, F.col("_group")).otherwise(F.col("_row")).alias("_group"), F.col("id").alias(id_column), F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
