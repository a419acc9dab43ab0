"""Byte-level BPE encoding and decoding, exactly as merging by rank, in time linear in the text.

A text is split by the vocabulary's pattern. Within a piece, bytes are mapped to Latin-1 characters, and one
Aho-Corasick pass finds every vocabulary entry. From left to right the longest entry is tried first. It may follow
the token before it only if the two are compatible: merging their joined bytes by rank gives back exactly these
two tokens. That answer is memoised per pair. A sequence whose neighbours are all compatible is the one that merging
yields, and there is only one; a place from which no entry fits is marked dead and never entered again, so the work per
piece is linear however long it is.

Defined results: a null or empty text has no tokens; equal rows give equal rows; other columns are not read, so their
names never clash; an empty table gives an empty table. Texts are read whole; a text over a million characters is
split piece by piece, so that no list of all its pieces is held.
"""

import base64
import hashlib
import itertools
import re

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

MEMO = 1 << 19  # entries of a memo before it is emptied; no result depends on it
LONG = 1 << 20  # characters
NEVER = 1 << 60  # the rank of what is no entry


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


# Fixed value: the splitting pattern that ``latin_pattern`` spells out.
SPELT_OUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def latin_pattern() -> str:
    """``SPELT_OUT`` with its classes spelt out for characters below U+0250, where ``re`` is twice as fast."""
    low = [chr(c) for c in range(0x250)]
    letters = "".join(c for c in low if regex.match(r"\p{L}", c))
    numbers = "".join(c for c in low if regex.match(r"\p{N}", c))
    space = r"\t-\r \x85\xa0"
    letters, numbers = re.escape(letters), re.escape(numbers)
    return (rf" ?[{letters}]+|'(?:s|t|re|ve|m|ll|d)| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+"
            rf"|[{space}]+(?![^{space}])|[{space}]+")


class ByteBPE:
    """Encoder and decoder of one vocabulary of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.split = regex.compile(pattern)
        # Any other pattern splits all texts itself.
        self.split_latin = re.compile(latin_pattern()) if pattern == SPELT_OUT else self.split
        self.beyond_latin = re.compile("[^\x00-ɏ]")
        self.length = [0] * (max(ranks.values()) + 1)
        self.shorter = [-1] * len(self.length)  # the longest entry that is a proper prefix
        self.found = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.length[rank] = len(token)
            self.shorter[rank] = next((ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in ranks), -1)
            self.found.add_word(token.decode("latin-1"), rank)
        self.found.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.memo: dict[str, bytes] = {}

    def merged(self, piece: bytes) -> list[int]:
        """The plain definition: merge the neighbours whose joined bytes rank lowest, leftmost first. Short inputs only."""
        parts, rank_of = [piece[i:i + 1] for i in range(len(piece))], self.ranks.get
        costs = [rank_of(a + b, NEVER) for a, b in itertools.pairwise(parts)]
        while costs and (least := min(costs)) != NEVER:
            at = costs.index(least)
            parts[at] += parts.pop(at + 1)
            costs.pop(at)
            if at < len(costs):
                costs[at] = rank_of(parts[at] + parts[at + 1], NEVER)
            if at:
                costs[at - 1] = rank_of(parts[at - 1] + parts[at], NEVER)
        return [self.ranks[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging keeps ``right`` as it is after ``left``; -1 on the left stands for the piece's start."""
        known = self.pairs.get(key := left << 32 | right)
        if known is None:
            if len(self.pairs) >= MEMO:
                self.pairs.clear()
            pair = [right] if left < 0 else [left, right]
            known = self.pairs[key] = self.merged(b"".join([self.bytes_of[t] for t in pair])) == pair
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        length, shorter, known = self.length, self.shorter, self.pairs
        longest = [-1] * (len(piece) + 1)
        for end, token in self.found.iter(piece.decode("latin-1")):
            longest[end + 1 - length[token]] = token  # a longer one from the same place ends later
        dead = bytearray(len(piece) + 1)
        tokens, last, place, token = [], -1, 0, longest[0]
        while place < len(piece):
            while token >= 0:
                end = place + length[token]
                ok = known.get(last << 32 | token) if not dead[end] else False
                if ok or ok is None and self.compatible(last, token):
                    tokens.append(token)
                    last, place, token = token, end, longest[end]
                    break
                token = shorter[token]
            else:
                if last < 0:
                    raise ValueError("the vocabulary lacks a single byte")
                dead[place] = 1
                place -= length[tokens.pop()]
                token, last = shorter[last], tokens[-1] if tokens else -1
        return tokens

    def packed(self, piece: str) -> bytes:
        """The piece's ids as little-endian unsigned 32-bit integers."""
        known = self.memo.get(piece)
        if known is None:
            known = np.array(self.encode_piece(piece.encode()), "<u4").tobytes()
            if len(piece) <= 64:
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                self.memo[piece] = known
        return known

    def encode(self, text: str | None):
        """Chunks of packed ids, in order."""
        if not text:
            return
        split = self.split if self.beyond_latin.search(text) else self.split_latin
        if len(text) <= LONG:
            memo = self.memo
            yield b"".join([memo.get(p) or self.packed(p) for p in split.findall(text)])
            return
        pieces = (m.group() for m in split.finditer(text))
        while chunk := list(itertools.islice(pieces, 100_000)):
            yield b"".join(map(self.packed, chunk))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_built: dict[str, ByteBPE] = {}


def built(ranks: dict[bytes, int], pattern: str, key: str) -> ByteBPE:
    """One encoder per Python worker and vocabulary."""
    if key not in _built:
        _built[key] = ByteBPE(ranks, pattern)
    return _built[key]


def shared(df: DataFrame, path: str):
    """The vocabulary file's ranks, read on the driver and sent to the executors (a few MB, whatever the corpus)."""
    ranks = read_ranks(path)
    key = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()
    return df.sparkSession.sparkContext.broadcast(ranks), key


def encode_table(df: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text",
                 with_ids: bool = True) -> DataFrame:
    """Per row: id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, the ids themselves (array of int)."""
    ranks, key = shared(df, path)
    fields = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    if with_ids:
        fields.append(("ids", pa.list_(pa.int32())))

    def run(batches):
        bpe = built(ranks.value, pattern, key)
        for batch in batches:
            out = {name: [] for name, _ in fields}
            for text in batch.column(1):
                digest, decoded, n, kept = hashlib.sha256(), hashlib.sha256(), 0, []
                for ids in bpe.encode(text.as_py()):
                    n += len(ids) // 4
                    digest.update(ids)
                    decoded.update(bpe.decode(ids))
                    if with_ids:
                        kept.append(np.frombuffer(ids, "<i4"))
                row = (n, digest.hexdigest(), decoded.hexdigest(), np.concatenate(kept) if kept else [])
                for column, value in zip(out.values(), row):
                    column.append(value)
            columns = [pa.array(out[name], kind) for name, kind in fields]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [id_column, *out])

    kinds = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    id_type = df.schema[id_column].dataType.simpleString()
    return df.select(id_column, text_column).mapInArrow(run, f"`{id_column}` {id_type}, {kinds}")


def decode_table(df: DataFrame, path: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """The inverse: (id, text) from the ids; bytes that are no UTF-8 become U+FFFD, null ids a null text."""
    ranks, _ = shared(df, path)

    def run(batches):
        bytes_of = {rank: token for token, rank in ranks.value.items()}
        for batch in batches:
            texts = [None if ids is None else b"".join(map(bytes_of.__getitem__, ids)).decode("utf-8", "replace")
                     for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_column, "text"])

    id_type = df.schema[id_column].dataType.simpleString()
    return df.select(id_column, ids_column).mapInArrow(run, f"`{id_column}` {id_type}, text string")
