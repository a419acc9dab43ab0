"""The prefix trie of conversations, by truncation peeling.

Every conversation is rebuilt: it begins with the first h turns of the conversation at the start of its hundred and goes on with its
own turns after its first h. A node is a distinct sequence of first turns. It is known by 128 bits: the exclusive or of a
hash of (place, role, MD5 of the text) for each of its turns, a running value along the conversation that chunks of a
long one can compute on their own. Dropping the last turn of a node is one more exclusive or.

Peeling. Conversations that are equal to the end are one from the start, named by the smallest id. From the greatest depth
down, conversations that end at a depth join the nodes that are left from the depth below, equal ones are merged, and
each of the merged loses its last turn; members, children, leaves and savings are summed while the nodes are discovered.
The trie is cut for that: a subtree of few turns, or of a single distinct conversation, is peeled in one task together with
other such subtrees, of which it holds a bounded number of turns. What lies above them, a
node in thousands of turns, is peeled depth by depth by grouping, starting from the sums of the subtrees.

Defined results: null roles and texts count as empty ones; turns come in the order of ``turn``, null first, equal
ones by role and then by the MD5 of the text; repeated rows are turns of their own; rows without a conversation id are
in none; an empty table has no node, not even a root; other columns are not read. The turns that only one distinct conversation
has are one task's work (some 60 bytes a turn), its shared ones are not.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tintflow.llm.common import shuffle_partitions, staged
from tintflow.operators.ordering import CHUNK, across_chunks, cut_into_chunks, earlier_chunks, number_rows, with_carried
from tintflow.session import join_on_group

HUNDRED = 100  # conversations that share a beginning
LONGEST = 6  # they share fewer turns than this
LIGHT = 4096  # turns of a subtree that is peeled in one piece
TOGETHER = 50_000  # turns that are peeled in one task, about
KEY = ["k1", "k2"]


def rebuilt_turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """conv_id, depth, e1, e2 (hashes of the turn at its place), size (code points), ends (whether it is the last); and the
    turnless conversations."""
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"),
        F.unhex(F.md5(F.coalesce(text, F.lit("")))).alias("text"), F.coalesce(F.length(text), F.lit(0)).cast("long").alias("size"))
    rows = staged(number_rows(rows, ["conv_id"], ["turn", "role", "text"], number="place", total="turns").drop("turn"), "turns")
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % LONGEST).alias("shared")
    base = (F.col("conv_id") - F.col("conv_id") % HUNDRED).alias("base")
    heads = rows.where((F.col("conv_id") % HUNDRED == 0) & (F.col("place") < LONGEST))
    convs = rows.where("place = 1").select("conv_id", "turns", shared, base)
    # A beginning has at most a hundred conversations and five turns.
    begun = heads.select(F.col("conv_id").alias("base"), "place", "role", "text", "size", F.col("turns").alias("base_turns"))
    taken = F.least("shared", "base_turns")
    first = convs.join(begun, "base").where("place <= shared").select(
        "conv_id", F.col("place").alias("depth"), "role", "text", "size",
        ((F.col("turns") <= F.col("shared")) & (F.col("place") == taken)).alias("ends"))
    lengths = heads.where("place = 1").select(F.col("conv_id").alias("base"), F.col("turns").alias("base_turns"))
    short = (convs.join(lengths, "base", "left").withColumn("taken", F.least("shared", F.coalesce("base_turns", F.lit(0))))
             .where("taken < shared"))
    own = join_on_group(rows.withColumn("shared", shared).where("place > shared"), short.select("conv_id", "taken"), "conv_id", ["place"], "left")
    own = own.select("conv_id", (F.col("place") - F.col("shared") + F.coalesce("taken", "shared")).alias("depth"), "role", "text", "size",
                     (F.col("place") == F.col("turns")).alias("ends"))
    turnless = short.where("taken = 0 and turns <= shared").select("conv_id")
    turns = first.unionByName(own)
    return turns.select("conv_id", F.col("depth").cast("long").alias("depth"), *[
        F.xxhash64(F.lit(n), "depth", "role", "text").alias(f"e{n}") for n in (1, 2)], "size", "ends"), turnless


def with_keys(turns: DataFrame) -> DataFrame:
    """``turns`` with k1, k2: the node that a conversation's turns up to this one lead to."""
    chunked = cut_into_chunks(turns, ["conv_id"], ["depth"])
    so_far = Window.partitionBy("conv_id", CHUNK).orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    both = (1, 2)
    carried = across_chunks(chunked, ["conv_id"], *[F.bit_xor(f"e{n}").alias(f"x{n}") for n in both])
    carried = carried.select("conv_id", CHUNK, *[F.bit_xor(f"x{n}").over(earlier_chunks(["conv_id"])).alias(f"before{n}") for n in both])
    local = chunked.withColumns({f"k{n}": F.bit_xor(f"e{n}").over(so_far) for n in both})
    keyed = with_carried(local, carried, ["conv_id"])
    return keyed.withColumns({f"k{n}": F.col(f"k{n}").bitwiseXOR(F.coalesce(f"before{n}", F.lit(0))) for n in both}).drop(
        CHUNK, "before1", "before2")


# Ends -----------------------------------------------------------------------------------------------------------------

def joined_ids(members: DataFrame) -> DataFrame:
    """k1, k2, sha256: of the ids (conv_id) of each key, ascending and joined by commas.

    The ids are sorted across tasks and written out as pieces of text; the pieces of a key then run through one hash, which cannot
    be split, in a stream that is never held.
    """
    def pieces(batches):
        part, piece = TaskContext.get().partitionId(), 0
        for rows in batches:
            k1, k2, ids = (rows.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            starts = np.flatnonzero(np.r_[True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])]) if len(ids) else np.empty(0, int)
            ends = np.r_[starts[1:], len(ids)]
            texts = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(starts, ends)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1[starts]), pa.array(k2[starts]), pa.array(np.full(len(starts), part, np.int64)),
                 pa.array(np.arange(piece, piece + len(starts))), pa.array(texts, pa.string())], [*KEY, "part", "piece", "ids"])
            piece += len(starts)

    def hashed(batches):
        key, state = None, None
        for rows in batches:
            out = []
            for k1, k2, ids in zip(*(rows.column(i).to_pylist() for i in (0, 1, 4))):
                if (k1, k2) != key:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = (k1, k2), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_pylist([dict(zip((*KEY, "sha256"), r)) for r in out], schema)
        if key is not None:
            yield pa.RecordBatch.from_pylist([dict(zip((*KEY, "sha256"), (*key, state.hexdigest())))], schema)

    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("sha256", pa.string())])
    parts, order = shuffle_partitions(members.sparkSession), [*KEY, "conv_id"]
    sorted_ids = members.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    written = sorted_ids.mapInArrow(pieces, "k1 long, k2 long, part long, piece long, ids string")
    return (written.repartition(parts, *KEY).sortWithinPartitions(*KEY, "part", "piece")
            .mapInArrow(hashed, "k1 long, k2 long, sha256 string"))


# Peeling --------------------------------------------------------------------------------------------------------------

SUMS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
NODE = "k1 long, k2 long, p1 long, p2 long, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, sha256 string, top boolean"


def peel(rows: pa.Table) -> pa.Table:
    """The nodes of whole subtrees, given as the turns of their distinct conversations."""
    rows = rows.sort_by([("conv_id", "ascending"), ("depth", "ascending")])
    get = {c: rows.column(c).to_numpy() for c in ("conv_id", "depth", "k1", "k2", "p1", "p2", "size", "ended")}
    conv, depth, ended = get["conv_id"], get["depth"], get["ended"]
    last = np.flatnonzero(np.r_[conv[1:] != conv[:-1], True])
    begins = np.r_[True, conv[1:] != conv[:-1]]  # the subtree's top on this conversation
    order = np.lexsort((get["k2"], get["k1"]))
    k1, k2 = get["k1"][order], get["k2"][order]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(np.r_[False, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])
    last = last[np.argsort(depth[last], kind="stable")]
    ends_at = np.searchsorted(depth[last], np.arange(depth[last[-1]] + 2))
    # What is left from the depth below, with its last turn dropped: the row it stands at, and its sums.
    at, sums, least, below = np.empty(0, np.int64), np.empty((0, 4), np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    shown, totals, smallest = [], [], []
    parent_of, parent = [], []
    for d in range(int(depth[last[-1]]), int(depth.min()) - 1, -1):
        new = last[ends_at[d]:ends_at[d + 1]]
        if not len(new) and not len(at):
            continue
        here = np.r_[at, new]
        values = np.concatenate([sums, np.stack([ended[new], 0 * new, 0 * new, 0 * new], axis=1)])
        low = np.r_[least, conv[new]]
        order = np.argsort(number[here], kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(number[here][order]) != 0])
        which = np.empty(len(here), np.int64)
        which[order] = np.cumsum(np.r_[False, np.diff(number[here][order]) != 0])
        at = here[order][starts]
        sums = np.add.reduceat(values[order], starts, axis=0)
        least = np.minimum.reduceat(low[order], starts)
        sums[:, 2] += sums[:, 1] == 0
        sums[:, 3] += (sums[:, 0] - 1) * get["size"][at]
        parent_of.append(below)
        parent.append(least[which[:len(below)]])
        shown.append(at)
        totals.append(sums)
        smallest.append(least)
        index = np.arange(len(at)) + sum(map(len, shown[:-1]))
        deeper = ~begins[at]
        below, least = index[deeper], least[deeper]
        at, sums = at[deeper] - 1, sums[deeper].copy()
        sums[:, 1] = 1
    at, totals, smallest = np.concatenate(shown), np.concatenate(totals), np.concatenate(smallest)
    parents, known = np.zeros(len(at), np.int64), np.zeros(len(at), bool)
    of = np.concatenate(parent_of)
    parents[of], known[of] = np.concatenate(parent), True
    # The ids that end at a node are hashed at the conversation that stands for them, which ends there.
    ending = {int(number[row]): int(row) for row in last}
    shas = rows.column("sha256").to_pylist()
    table = {c: pa.array(get[c][at]) for c in ("k1", "k2", "p1", "p2", "depth")}
    table |= {"conv_id": pa.array(smallest), "parent_conv_id": pa.array(parents, mask=~known)}
    table |= {name: pa.array(totals[:, i]) for i, name in enumerate(SUMS)}
    table["sha256"] = pa.array([shas[ending[n]] if n in ending else None for n in number[at].tolist()], pa.string())
    table["top"] = pa.array(begins[at])
    return pa.table(table)


def combined(children: DataFrame) -> DataFrame:
    """What the children of each node add to it."""
    return children.groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.min("conv_id").alias("_conv"), F.sum("n_convs").alias("_convs"), F.count(F.lit(1)).alias("_children"),
        F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_saved"))


def with_children(nodes: DataFrame, children: DataFrame) -> DataFrame:
    """Sums of ``nodes`` with those of ``children`` added; ``saved_tokens`` without the node's own."""
    joined = nodes.join(combined(children), KEY, "left")
    return joined.withColumns({
        "conv_id": F.least("conv_id", "_conv"), "n_convs": F.col("n_convs") + F.coalesce("_convs", F.lit(0)),
        "n_children": F.col("n_children") + F.coalesce("_children", F.lit(0)),
        "n_leaves": F.col("n_leaves") + F.coalesce("_leaves", F.lit(0)),
        "saved_tokens": F.col("saved_tokens") + F.coalesce("_saved", F.lit(0)),
    }).drop("_conv", "_convs", "_children", "_leaves", "_saved")


def finished(nodes: DataFrame) -> DataFrame:
    """Nodes all of whose children are added: a childless one is its own leaf."""
    return nodes.withColumns({
        "n_leaves": F.when(F.col("n_children") == 0, F.lit(1).cast("long")).otherwise(F.col("n_leaves")),
        "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size")})


def trie(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", *,
         light: int = LIGHT) -> DataFrame:
    """One row per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    turns, turnless = rebuilt_turns(conversations, conv, turn, role, text)
    turns = staged(with_keys(turns), "paths")
    root = [F.lit(0).cast("long").alias(k) for k in KEY]
    members = turns.where("ends").select(*KEY, "depth", "conv_id").unionByName(
        turnless.select(*root, F.lit(0).cast("long").alias("depth"), "conv_id"))
    ended = members.groupBy(*KEY, "depth").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("ended"))
    ended = staged(ended.join(joined_ids(members), KEY), "ends")

    # The turns of one conversation for all that are equal, each with the length and the members it stands for.
    stands = ended.select("conv_id", F.col("depth").alias("length"), "ended", "sha256")
    paths = join_on_group(turns, stands, "conv_id", ["depth"]).withColumns({
        f"p{n}": F.col(f"k{n}").bitwiseXOR(F.col(f"e{n}")) for n in (1, 2)}).drop("e1", "e2", "ends")
    paths = staged(paths, "distinct-paths")
    sizes = paths.groupBy(*KEY).agg(F.sum(F.col("length") - F.col("depth") + 1).alias("turns"), F.count(F.lit(1)).alias("convs"),
                                    F.first("depth").alias("depth"), F.first(F.struct("p1", "p2", "size")).alias("of"))
    heavy = staged(sizes.where((F.col("turns") > light) & (F.col("convs") > 1)).select(*KEY, "depth", "of.*"), "heavy-nodes")
    marked = join_on_group(paths, heavy.select(*KEY, F.lit(True).alias("heavy")), KEY, ["conv_id"], "left")
    below = staged(marked.where("heavy is null").drop("heavy"), "light-turns")
    tops = below.groupBy("conv_id").agg(F.min_by("k1", "depth").alias("top"))
    tasks = max(1, -(-below.count() // TOGETHER))
    dealt = join_on_group(below, tops, "conv_id", ["depth"]).withColumn("task", F.pmod(F.xxhash64("top"), F.lit(tasks)))
    peeled = staged(dealt.drop("top").groupBy("task").applyInArrow(peel, NODE), "light-nodes")

    # Above: conversations that end there, the sums of the subtrees, and depth by depth those of each other.
    none = spark.range(1).select(*root, F.lit(0).cast("long").alias("depth"), *[F.lit(None).cast("long").alias(p) for p in ("p1", "p2")],
                                 F.lit(0).cast("long").alias("size"))
    above = heavy.unionByName(none).join(ended.select(*KEY, "conv_id", F.col("ended").alias("n_convs"), "sha256"), KEY, "left")
    above = above.withColumns({name: F.coalesce(name, F.lit(0)) if name == "n_convs" else F.lit(0).cast("long") for name in SUMS})
    above = staged(with_children(above, peeled.where("top")), "above")
    deepest = above.agg(F.max("depth")).first()[0]
    done = staged(finished(above.where(F.col("depth") == deepest)), "depth")
    whole = done
    for depth in range(deepest - 1, -1, -1):
        done = staged(finished(with_children(above.where(F.col("depth") == depth), done)), "depth")
        whole = whole.unionByName(done)
    whole = staged(whole.where("n_convs > 0"), "heavy-sums")

    columns = [*KEY, "p1", "p2", "depth", "conv_id", *SUMS, "sha256"]
    names = whole.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    under = peeled.where("top").select(*columns).unionByName(whole.where("depth > 0").select(*columns))
    under = join_on_group(under, names, ["p1", "p2"], KEY)
    top = whole.where("depth = 0").select(*columns, F.lit(None).cast("long").alias("parent_conv_id"))
    nodes = peeled.where("not top").drop("top").unionByName(under).unionByName(top)
    return nodes.select("conv_id", "depth", "parent_conv_id", *SUMS,
                        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
