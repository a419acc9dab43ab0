"""A positional inverted index of a document table, kept in blocks of documents.

A block holds consecutive documents of a scan: up to ``BLOCK_WORDS`` words or ``BLOCK_DOCS`` documents, one document
more at most. Its words are numbered through, with a gap after each document, so that consecutive positions lie in one
document. Each block has its own posting lists, so that building shuffles nothing, a word that fills a third of the corpus has
as many lists as there are blocks, and a task that works on a block knows how much that can be.

Words are maximal runs of ASCII letters and digits and of all characters above ASCII; A-Z are lower-cased. A null or
empty text has no words and remains a document. Words are kept as bytes. Repeated rows are documents of their own;
other columns are not read.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tintflow.llm.common import staged

BLOCK_WORDS = 1 << 20
BLOCK_DOCS = 1 << 14
PIECE = 1 << 20  # bytes of a text that are cut into words at once
# What a byte becomes: A-Z lower-case, digits, letters and all of UTF-8's multi-byte characters themselves, others a space.
FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class Index(NamedTuple):
    """``docs``: block, at (place in the block), id, first (position of its first word), n (words).
    ``terms``: block, term, n_docs, postings (little-endian 32-bit steps from position to position, the first from 0)."""

    docs: DataFrame
    terms: DataFrame


def word_lists(text: bytes | None) -> Iterator[list[bytes]]:
    """The words of a text in order, a bounded piece of the text at a time."""
    folded, at = (text or b"").translate(FOLDED), 0
    while at < len(folded):
        end = folded.find(b" ", at + PIECE)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


class Numbers(dict):
    """Numbers for words, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Block:
    def __init__(self, number: int, most_words: int):
        self.number, self.most_words, self.words, self.found, self.next = number, most_words, Numbers(), [], 0
        self.firsts, self.sizes = [], []

    def add(self, text: bytes | None) -> None:
        size = 0
        for words in word_lists(text):
            self.found.append(np.fromiter(map(self.words.__getitem__, words), np.int32, len(words)))
            size += len(words)
        self.firsts.append(self.next)
        self.sizes.append(size)
        self.next += size + 1

    def is_full(self) -> bool:
        return self.next >= self.most_words or len(self.firsts) >= BLOCK_DOCS

    def rows(self, ids: pa.Array) -> Iterator[pa.RecordBatch]:
        firsts, sizes = np.array(self.firsts, np.int32), np.array(self.sizes, np.int32)
        docs = len(firsts)
        yield batch(self.number, docs, pa.nulls(docs, pa.binary()), pa.nulls(docs, pa.int32()), pa.nulls(docs, pa.binary()),
                    pa.array(np.arange(docs, dtype=np.int32)), ids, pa.array(firsts), pa.array(sizes))
        if not self.words:
            return
        term = np.concatenate(self.found)
        doc = np.repeat(np.arange(docs, dtype=np.int32), sizes)
        order = np.argsort(term, kind="stable")
        term, doc = term[order], doc[order]
        position = order.astype(np.int32) + doc  # a gap after each document
        starts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
        steps = np.diff(position, prepend=np.int32(0))
        steps[starts] = position[starts]
        other = np.r_[True, doc[1:] != doc[:-1]]
        other[starts] = True
        n_docs = np.add.reduceat(other.astype(np.int32), starts).astype(np.int32)
        words = pa.array(list(self.words), pa.binary())  # in order of their numbers
        at = np.r_[starts, len(term)].astype(np.int64) * 4
        terms = len(starts)
        postings = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), terms, [None, pa.py_buffer(at.tobytes()), pa.py_buffer(steps.astype("<i4").tobytes())]).cast(pa.binary())
        none = pa.nulls(terms, pa.int32())
        yield batch(self.number, terms, words, pa.array(n_docs), postings, none, pa.nulls(terms, ids.type), none, none)


NAMES = ["block", "term", "n_docs", "postings", "at", "id", "first", "n"]


def batch(block: int, rows: int, *columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(rows, block, np.int64)), *columns], NAMES)


def build(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", *, block_words: int = BLOCK_WORDS) -> Index:
    """The index, written once to the shared folder; documents are read once."""
    def run(batches):
        part, blocks = TaskContext.get().partitionId() << 32, 0
        block, held = Block(part, block_words), []
        for rows in batches:
            ids, start = rows.column(0), 0
            for i, text in enumerate(rows.column(1).cast(pa.binary()).to_pylist()):
                block.add(text)
                if block.is_full():
                    yield from block.rows(pa.concat_arrays([*held, ids.slice(start, i + 1 - start)]))
                    blocks += 1
                    block, held, start = Block(part + blocks, block_words), [], i + 1
            if start < rows.num_rows:
                held.append(ids.slice(start))
        if held:
            yield from block.rows(pa.concat_arrays(held))

    kind = docs.select(id_column).schema[0].dataType.simpleString()
    rows = staged(docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(
        run, f"block long, term binary, n_docs int, postings binary, at int, id {kind}, first int, n int"), "inverted-index", "zstd")
    # toDF names the columns anew, so that the two sides can be grouped together.
    return Index(rows.where("term is null").select("block", "at", "id", "first", "n").toDF("block", "at", "id", "first", "n"),
                 rows.where("term is not null").select("block", "term", "n_docs", "postings"))


def positions(postings: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The positions of all lists, one after the other, and the length of each list."""
    column = pa.concat_arrays([c.cast(pa.large_binary()) for c in postings.chunks]) if postings.num_chunks else pa.array([], pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    steps = np.frombuffer(column.buffers()[2], "<i4", offset=offsets[0], count=(offsets[-1] - offsets[0]) // 4) if offsets[-1] > offsets[0] else np.empty(0, np.int32)
    lengths = np.diff(offsets) // 4
    total = np.cumsum(steps, dtype=np.int64)
    ends = np.cumsum(lengths)
    before = np.r_[0, total[ends[:-1] - 1]] if len(ends) else np.empty(0, np.int64)
    return total - np.repeat(before, lengths), lengths


# Items ----------------------------------------------------------------------------------------------------------------

def item_slices(items: DataFrame, id_column: str, text_column: str, words: int) -> tuple[DataFrame, list[int]]:
    """The items as (slice, item, id, words), staged, and the slices' numbers.

    A slice holds up to ``words`` words and one item more, so that it may be sent to the driver and to all tasks.
    Items without words are in none.
    """
    def run(batches):
        number = TaskContext.get().partitionId() << 32
        item, held = 0, 0
        for rows in batches:
            out = []
            for id_, text in zip(rows.column(0), rows.column(1).cast(pa.binary()).to_pylist()):
                found = [word for part in word_lists(text) for word in part]
                if not found:
                    continue
                if held >= words:
                    number, held = number + 1, 0
                held += len(found)
                out.append((number, item, id_.as_py(), found))
                item += 1
            columns = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), rows.column(0).type, pa.list_(pa.binary())))],
                ["slice", "item", "id", "words"])

    kind = items.select(id_column).schema[0].dataType.simpleString()
    found = staged(items.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(
        run, f"slice long, item long, id {kind}, words array<binary>"), "items")
    return found, sorted(r[0] for r in found.select("slice").distinct().collect())


def term_counts(index: Index, terms: list[bytes]) -> tuple[DataFrame, dict[bytes, tuple[int, int]]]:
    """The index rows of ``terms``, and for each that occurs its number of documents and of occurrences."""
    spark = index.terms.sparkSession
    # A slice's words: bounded by what a slice may hold.
    wanted = F.broadcast(spark.createDataFrame([(bytearray(t),) for t in terms], "term binary"))
    rows = index.terms.join(wanted, "term", "left_semi")
    counts = rows.groupBy("term").agg(F.sum("n_docs"), F.sum(F.octet_length("postings") / 4).cast("long")).collect()
    return rows, {bytes(r[0]): (r[1], r[2]) for r in counts}
