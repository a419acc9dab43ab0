"""Benchmark decontamination with a positional inverted index: exact phrases and proximity.

The training corpus is stored as posting lists in blocks (``inverted_index``). A benchmark item's windows are its runs of
``width`` consecutive words; an item of fewer words, but not none, is one window. Per block and for all windows at once, the
list of a window's rarest word, moved back by the word's place, gives candidate starts; these are intersected with
the lists of the other words, from rare to frequent, each moved by its own place, and only the starts that are left go on.
Windows with a word that the corpus lacks are dropped before. Items come in slices of bounded size; each
slice is compared with the whole index.

``phrases`` returns every stretch of document words that windows of an item cover, ``proximity`` the places where all words of a
window stand near its rarest one, in any order, and ``contaminated`` one row per document.

Defined results: null and empty texts have no words, hit nothing and remain rows; equal documents are found
one by one; items without an id count as one item, with an empty text for its id; tables without rows give no hits; a
text of any length is used whole; other columns are not read.
"""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tintflow.llm.inverted_index import BLOCK_WORDS, Index, build, item_slices, positions, term_counts

SLICE_WORDS = 500_000
CANDIDATES = 2_000_000  # starts that are looked at together; one window has no more than a block has words
NEVER = np.iinfo(np.int32).max


class Windows(NamedTuple):
    """The windows of a slice of items whose words all occur: ``words`` holds the numbers of their words, ``order`` the places of a
    window from its rarest word on, ``length`` how many there are, ``item`` the item's place in ``ids``."""

    number: dict
    words: np.ndarray
    order: np.ndarray
    length: np.ndarray
    item: np.ndarray
    ids: list


def windows_of(items: list, counts: dict, width: int) -> Windows:
    """From (id, words) and the occurrences of words; equally rare ones in byte order."""
    known = sorted(counts, key=lambda t: (counts[t][1], t))
    number = {term: i for i, term in enumerate(known)}
    words, length, of, ids = [], [], [], []
    for id_, found in items:
        numbers = np.array([number.get(w, -1) for w in found], np.int32)
        size = min(width, len(numbers))
        runs = np.lib.stride_tricks.sliding_window_view(numbers, size)
        runs = runs[(runs >= 0).all(axis=1)]
        if len(runs):
            words.append(np.pad(runs, ((0, 0), (0, width - size)), constant_values=NEVER))
            length.append(np.full(len(runs), size))
            of.append(np.full(len(runs), len(ids)))
            ids.append(id_)
    if not ids:
        none = np.empty((0, width), np.int32)
        return Windows(number, none, none, np.empty(0, np.int64), np.empty(0, np.int64), ids)
    words = np.concatenate(words)
    # Numbers ascend with the occurrences, so sorting by them puts the rarest first and what is no place last.
    order = np.argsort(words, axis=1, kind="stable")
    return Windows(number, words, order, np.concatenate(length), np.concatenate(of), ids)


class Lists:
    """The posting lists of a block as one ascending array of (word number, position)."""

    def __init__(self, rows: pa.Table, number: dict):
        terms = np.array([number[t] for t in rows.column("term").to_pylist()], np.int64)
        order = np.argsort(terms)
        found, lengths = positions(rows.column("postings").take(pa.array(order)) if len(order) else rows.column("postings"))
        self.keys = (np.repeat(terms[order], lengths) << 32) | found
        self.start, self.count = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
        self.count[terms[order]] = lengths
        self.start[terms[order]] = np.cumsum(lengths) - lengths

    def near(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Where in ``keys`` the first occurrence at or after each position is."""
        return np.searchsorted(self.keys, (term.astype(np.int64) << 32) | position)

    def has(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        at = self.near(term, position)
        inside = at < len(self.keys)
        out = np.zeros(len(at), bool)
        out[inside] = self.keys[at[inside]] == ((term[inside].astype(np.int64) << 32) | position[inside])
        return out

    def portions(self, windows: Windows):
        """(window, position of its rarest word) for every window all of whose words the block has, a bounded number at a time."""
        there = np.r_[self.count > 0, True]
        alive = np.flatnonzero(there[np.where(windows.words == NEVER, len(self.count), windows.words)].all(axis=1))
        rarest = windows.words[alive, windows.order[alive, 0]]
        ends = np.cumsum(self.count[rarest])
        begin = 0
        while begin < len(alive):
            done = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, done + CANDIDATES, side="right")))
            part, terms = alive[begin:end], rarest[begin:end]
            counts = self.count[terms]
            place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            yield np.repeat(part, counts), self.keys[np.repeat(self.start[terms], counts) + place] & 0xFFFFFFFF
            begin = end


def phrase_starts(lists: Lists, windows: Windows):
    """(window, start) of every place where the words of a window stand consecutively."""
    for window, position in lists.portions(windows):
        start = position - windows.order[window, 0]
        window, start = window[start >= 0], start[start >= 0]
        for k in range(1, windows.words.shape[1]):
            place = windows.order[window, k]
            kept = windows.length[window] <= k
            open_ = np.flatnonzero(~kept)
            kept[open_] = lists.has(windows.words[window[open_], place[open_]], start[open_] + place[open_])
            window, start = window[kept], start[kept]
        yield window, start


def joined(item: np.ndarray, first: np.ndarray, last: np.ndarray):
    """Stretches of an item that overlap or touch become one."""
    order = np.lexsort((first, item))
    item, first, last = item[order], first[order], last[order]
    if not len(item):
        return item, first, last
    base = item * (1 << 33)  # keeps the running maximum of one item from reaching into the next
    reach = np.maximum.accumulate(last + base)
    new = np.r_[True, (item[1:] != item[:-1]) | (first[1:] + base[1:] > reach[:-1] + 1)]
    at = np.flatnonzero(new)
    return item[at], first[at], (np.maximum.reduceat(last, at))


def proximities(lists: Lists, windows: Windows, firsts: np.ndarray, ends: np.ndarray, within: int):
    """(window, first, last): the rarest word and, within ``within`` words of it in its document, the nearest of each other word."""
    for window, anchor in lists.portions(windows):
        doc = np.searchsorted(firsts, anchor, side="right") - 1
        low, high = np.maximum(anchor - within, firsts[doc]), np.minimum(anchor + within, ends[doc])
        first, last = anchor.copy(), anchor.copy()
        for k in range(1, windows.words.shape[1]):
            used = windows.length[window] > k
            term = np.where(used, windows.words[window, windows.order[window, k]], 0)
            after = lists.near(term, anchor)
            keys = np.r_[-1, lists.keys, -1]  # keys[i + 1] is the list's i-th
            right, left = keys[after + 1], keys[after]
            right_at = np.where((right >> 32 == term) & ((right & 0xFFFFFFFF) <= high), right & 0xFFFFFFFF, -1)
            left_at = np.where((left >> 32 == term) & ((left & 0xFFFFFFFF) >= low), left & 0xFFFFFFFF, -1)
            nearer = (right_at >= 0) & ((left_at < 0) | (right_at - anchor <= anchor - left_at))
            found = np.where(nearer, right_at, left_at)
            first = np.where(used, np.minimum(first, found), first)
            last = np.where(used, np.maximum(last, found), last)
            kept = ~used | (found >= 0)
            window, anchor, low, high, first, last = (x[kept] for x in (window, anchor, low, high, first, last))
        yield window, first, last


def comparing(windows: Windows, within: int | None):
    """What a block's task does: its posting lists and documents to stretches."""
    def compare(terms: pa.Table, docs: pa.Table) -> pa.Table:
        lists = Lists(terms, windows.number)
        docs = docs.sort_by("at")
        firsts = docs.column("first").to_numpy().astype(np.int64)
        ends = firsts + docs.column("n").to_numpy() - 1
        if within is None:
            parts = [(w, s, s + windows.length[w] - 1) for w, s in phrase_starts(lists, windows)]
        else:
            parts = list(proximities(lists, windows, firsts, ends, within))
        parts.append((np.empty(0, np.int64),) * 3)
        window, first, last = (np.concatenate(x) for x in zip(*parts))
        if within is None:
            item, first, last = joined(windows.item[window], first, last)
        else:
            item, first, last = np.unique(np.stack([windows.item[window], first, last], axis=1), axis=0).reshape(-1, 3).T
        doc = np.searchsorted(firsts, first, side="right") - 1
        block = docs.column("block")[0] if len(docs) else pa.scalar(0)
        ids = pa.array(windows.ids, docs.schema.field("item_id").type)
        return pa.table({
            "block": pa.array(np.full(len(item), block.as_py(), np.int64)), "at": pa.array(doc.astype(np.int32)),
            "item_id": ids.take(pa.array(item)), "first": pa.array((first - firsts[doc]).astype(np.int32)),
            "last": pa.array((last - firsts[doc]).astype(np.int32))})

    return compare


def stretches(index: Index, items: DataFrame, id_column: str, text_column: str, width: int, within: int | None = None) -> DataFrame:
    """block, at, item_id, first, last: stretches of document words, counted from 0 in the document."""
    kind = items.select(id_column).schema[0].dataType.simpleString()
    schema = f"block long, at int, item_id {kind}, first int, last int"
    found, numbers = item_slices(items, id_column, text_column, SLICE_WORDS)
    out = None
    for number in numbers:
        # A slice is bounded by what item_slices puts in it.
        held = [(r["id"], [bytes(w) for w in r["words"]]) for r in found.where(F.col("slice") == number).collect()]
        rows, counts = term_counts(index, sorted({w for _, words in held for w in words}))
        windows = windows_of(held, counts, width)

        docs = index.docs.select("block", "at", "first", "n", F.lit(None).cast(kind).alias("item_id"))
        made = rows.groupBy("block").cogroup(docs.groupBy("block")).applyInArrow(comparing(windows, within), schema)
        out = made if out is None else out.unionByName(made)
    if out is None:
        return items.sparkSession.createDataFrame([], schema)
    return out


def with_id(found: DataFrame, index: Index, id_column: str) -> DataFrame:
    named = index.docs.select("block", "at", F.col("id").alias(id_column))
    return found.join(named, ["block", "at"])


def phrases(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id",
            item_text: str = "text", width: int = 10, *, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document and item the stretches (first and last word, from 0) that windows of the item cover."""
    index = build(docs, id_column, text_column, block_words=block_words)
    return with_id(stretches(index, items, item_column, item_text, width), index, id_column).select(
        id_column, F.col("item_id").alias(item_column), "first", "last")


def proximity(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id",
              item_text: str = "text", width: int = 10, within: int = 20, *, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document and item the distinct stretches (first and last word) around an occurrence of a window's rarest word, all of whose
    other words have an occurrence at most ``within`` words from it; of several the nearest counts, of equally near ones the later.

    Rarest is the word with the fewest occurrences in all documents, of equally rare ones the first in byte order.
    """
    index = build(docs, id_column, text_column, block_words=block_words)
    return with_id(stretches(index, items, item_column, item_text, width, within), index, id_column).select(
        id_column, F.col("item_id").alias(item_column), "first", "last")


def contaminated(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 item_column: str = "item_id", item_text: str = "text", width: int = 10, *,
                 block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: n_words, n_hit (words that any window covers), n_items, items_sha256 and contaminated."""
    index = build(docs, id_column, text_column, block_words=block_words)
    found = stretches(index, items, item_column, item_text, width)
    # Words covered by several stretches count once; the window runs over one document's stretches, fewer than its words.
    before = Window.partitionBy("block", "at").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max("last").over(before), F.lit(-1))
    new = F.greatest(F.lit(0), F.col("last") - F.greatest(F.col("first") - 1, "_reach"))
    item = F.coalesce(F.col("item_id").cast("string"), F.lit(""))
    hits = (found.withColumn("_reach", reach).groupBy("block", "at")
            .agg(F.sum(new).cast("long").alias("n_hit"), F.array_sort(F.collect_set(item)).alias("items")))
    joined_rows = index.docs.join(hits, ["block", "at"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined_rows.select(
        F.col("id").alias(id_column), F.col("n").cast("long").alias("n_words"), n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
