"""Token counts by a finite-state transducer compiled from a BPE vocabulary with word ends.

The transducer reads a word symbol by symbol, the last one marked as a word end. Its state is what later symbols can
depend on: for each place from which the symbols so far could still grow into an entry, the entry tree's node, the
token that ends there and how many tokens fewer the word had at that place. A transition is annotated with the change of
the number of tokens; a word's tokens are the sum over its path. Two neighbours are possible if merging their joined symbols
by rank gives them back, so the path follows exactly what merging yields. States and transitions are compiled when first
met and the paths of whole words are remembered; emptying either changes no result.

Between words the transducer is always in its start state, and ASCII white space ends words. So a chunk of a text has a state map
of three parts: the symbols up to its first white space, the tokens from there to its last, and the symbols after it, or
the symbols alone where it holds none. Chunks are mapped in parallel; maps compose associatively, by a running count
of the chunks that hold white space, which says where each loose piece ends, and one more count of the joined pieces.

Defined results: null and empty texts have no tokens; special strings in a text count as their one token, as the
library does by default; equal rows give equal rows; other columns are not read. A word may be as long as its text and
is held whole, nothing else is.
"""

import itertools
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tintflow.llm.common import staged

CHUNK = 1 << 16  # bytes
MEMO = 1 << 18  # words, and states, that are remembered
NEVER = 1 << 60
SPACE = r"[\x20\x09-\x0D]"


def classes_below(limit: int) -> tuple[str, str]:
    """The letters and numbers of the splitting pattern among the first code points, for a ``re`` class."""
    low = [chr(c) for c in range(limit)]
    return tuple(re.escape("".join(c for c in low if unicodedata.category(c)[0] == kind)) for kind in "LN")


class Transducer:
    """States are numbers; state 0 is the start. ``end`` marks the last symbol of a word."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], end: str):
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.end = end
        self.tree: list[dict] = [{}]  # node -> symbol -> node
        self.token: list[int] = [-1]  # node -> entry
        self.symbols: list[tuple[str, ...]] = []
        for entry in vocabulary:
            symbols = tuple(entry.removesuffix(end)) if entry != end else (end,)
            if entry.endswith(end) and entry != end:
                symbols = (*symbols[:-1], symbols[-1] + end)
            node = 0
            for s in symbols:
                if s not in self.tree[node]:
                    self.tree.append({})
                    self.token.append(-1)
                    self.tree[node][s] = len(self.tree) - 1
                node = self.tree[node][s]
            self.token[node] = len(self.symbols)
            self.symbols.append(symbols)
        self.pairs: dict[int, bool] = {}
        self.forget()

    def forget(self):
        self.states: list[tuple] = [((0, -1, 0),)]
        self.number = {self.states[0]: 0}
        self.steps: list[dict[str, tuple[int, int]]] = [{}]  # state -> symbol -> (state, change of the count)

    def merged(self, symbols: tuple[str, ...]) -> list[str]:
        parts, rank_of = list(symbols), self.rank.get
        costs = [rank_of(pair, NEVER) for pair in itertools.pairwise(parts)]
        while costs and (least := min(costs)) != NEVER:
            at = costs.index(least)
            parts[at] += parts.pop(at + 1)
            costs.pop(at)
            if at < len(costs):
                costs[at] = rank_of((parts[at], parts[at + 1]), NEVER)
            if at:
                costs[at - 1] = rank_of((parts[at - 1], parts[at]), NEVER)
        return parts

    def possible(self, left: int, right: int) -> bool:
        """Whether merging leaves the entry ``right`` as it is after ``left``; -1 is the word's start."""
        known = self.pairs.get(key := left << 32 | right)
        if known is None:
            if len(self.pairs) > MEMO:
                self.pairs.clear()
            pair = [self.symbols[t] for t in ((right,) if left < 0 else (left, right))]
            known = self.pairs[key] = self.merged(sum(pair, ())) == ["".join(p) for p in pair]
        return known

    def compile_step(self, state: int, symbol: str) -> tuple[int, int]:
        live, ends = [], None
        for node, last, fewer in self.states[state]:
            node = self.tree[node].get(symbol)
            if node is not None:
                live.append((node, last, fewer))
                token = self.token[node]
                if ends is None and token >= 0 and self.possible(last, token):
                    ends = token, 1 - fewer
        if ends is None:
            raise ValueError(f"the vocabulary lacks the symbol {symbol!r}")
        token, change = ends
        after = (*((node, last, fewer + change) for node, last, fewer in live), (0, token, 0))
        if after not in self.number:
            self.number[after] = len(self.states)
            self.states.append(after)
            self.steps.append({})
        found = self.steps[state][symbol] = self.number[after], change
        return found

    def count(self, symbols: str) -> int:
        """Tokens of a word."""
        if len(self.states) > MEMO:
            self.forget()
        state, total = 0, 0
        for symbol in symbols[:-1]:
            state, change = self.steps[state].get(symbol) or self.compile_step(state, symbol)
            total += change
        last = symbols[-1] + self.end
        return total + (self.steps[state].get(last) or self.compile_step(state, last))[1]


class Counter:
    """Counts the tokens of texts whose words no neighbour continues."""

    LIMIT = 0x250  # below it, the library's lower case and classes are Python's, and nothing composes

    def __init__(self, definition: str):
        parsed = json.loads(definition)
        library = Tokenizer.from_str(definition)
        self.normalize, self.pieces_of = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        model = parsed["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.transducer = Transducer(model["vocab"], merges, model["end_of_word_suffix"])
        special = [re.escape(t["content"]) for t in parsed["added_tokens"]]
        self.special = re.compile("|".join(sorted(special, key=len, reverse=True)) or r"(?!)")
        letters, numbers = classes_below(self.LIMIT)
        space = r"\t-\r \x85\xa0"
        self.split = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{letters}]+|[{numbers}]|[^{space}{letters}{numbers}]+")
        self.beyond = re.compile(f"[^\x00-{chr(self.LIMIT - 1)}]")
        # The byte-level alphabet: bytes that print stand for themselves, the others for the code points from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.alphabet = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.memo: dict[str, int] = {}

    def symbols(self, piece: str) -> str:
        return piece.encode().decode("latin-1").translate(self.alphabet)

    def tokens(self, piece: str) -> int:
        known = self.memo.get(piece)
        if known is None:
            known = self.transducer.count(self.symbols(piece))
            if len(piece) <= 64:
                if len(self.memo) > MEMO:
                    self.memo.clear()
                self.memo[piece] = known
        return known

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings."""
        if not self.beyond.search(text):
            memo, total = self.memo, 0
            for piece in self.split.findall(text.lower()):
                known = memo.get(piece)
                if known is None:
                    known = self.tokens(piece)
                total += known
            return total
        # Rare alphabets: the library's own normaliser and splitter, whose Unicode tables differ from Python's.
        return sum(self.transducer.count(symbols) for symbols, _ in self.pieces_of(self.normalize(text)))

    def count(self, text: str) -> int:
        if "<|" not in text:
            return self.plain(text)
        return len(self.special.findall(text)) + sum(map(self.plain, self.special.split(text)))


_built: dict[str, Counter] = {}


def built(definition: str) -> Counter:
    """One per Python worker and vocabulary."""
    key = str(hash(definition))
    if key not in _built:
        _built[key] = Counter(definition)
    return _built[key]


def state_maps(docs: DataFrame, definition: str) -> DataFrame:
    """_row, id, n_bytes, chunk, chunks, tokens, head, tail (null where the chunk holds no white space)."""
    shared = docs.sparkSession.sparkContext.broadcast(definition)  # a vocabulary file, 2 MB
    cut = re.compile(SPACE.encode())

    def run(batches):
        counter = built(shared.value)
        for batch in batches:
            tokens, heads, tails = [], [], []
            for part, chunk, chunks in zip(batch.column(5), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                part = part.as_py()
                if chunks == 1:
                    head, body, tail = b"", part, b""
                elif first := cut.search(part):
                    last = max(part.rfind(c) for c in b" \t\n\v\f\r")
                    start = first.start() if chunk else 0
                    end = last if chunk < chunks - 1 else len(part)
                    head, body, tail = part[:start], part[start:end], part[end:]
                else:
                    head, body, tail = part, None, None
                tokens.append(0 if body is None else counter.count(body.decode()))
                heads.append(head)
                tails.append(tail)
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, range(5)), pa.array(tokens, pa.int64()), pa.array(heads, pa.binary()), pa.array(tails, pa.binary())],
                ["_row", "id", "n_bytes", "chunk", "chunks", "tokens", "head", "tail"])

    binary = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("_row", "id", binary.alias("text")).withColumn("n_bytes", F.length("text").cast("long"))
    rows = rows.withColumn("chunks", F.greatest(F.lit(1), F.ceil(F.col("n_bytes") / CHUNK)).cast("int"))
    starts = F.sequence(F.lit(0), F.col("chunks") - 1)
    part = F.expr(f"substring(text, chunk * {CHUNK} + 1, {CHUNK})")
    rows = rows.withColumn("chunk", F.explode(starts)).select("_row", "id", "n_bytes", "chunk", "chunks", part.alias("part"))
    id_type = docs.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_row long, id {id_type}, n_bytes long, chunk int, chunks int, tokens long, head binary, tail binary")


def composed(maps: DataFrame, definition: str) -> DataFrame:
    """_row, tokens of what lies across chunks: the loose pieces between one white space and the next, joined in order."""
    shared = maps.sparkSession.sparkContext.broadcast(definition)

    def run(batches):
        counter = built(shared.value)
        for batch in batches:
            counts = [counter.count(b"".join(parts).decode()) for parts in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["_row", "tokens"])

    before = Window.partitionBy("_row").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    ends = F.coalesce(F.sum(F.col("tail").isNotNull().cast("int")).over(before), F.lit(0))
    many = maps.where("chunks > 1").withColumn("piece", ends)
    heads = many.select("_row", "piece", (F.col("chunk") * 2).alias("at"), F.col("head").alias("part"))
    tails = many.where("tail is not null").select("_row", (F.col("piece") + 1).alias("piece"),
                                                  (F.col("chunk") * 2 + 1).alias("at"), F.col("tail").alias("part"))
    joined = heads.unionByName(tails).groupBy("_row", "piece").agg(F.sort_array(F.collect_list(F.struct("at", "part"))).alias("parts"))
    return joined.select("_row", F.transform("parts", lambda p: p["part"]).alias("parts")).mapInArrow(run, "_row long, tokens long")


def token_counts(docs: DataFrame, path: str, limit: int = 2048, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, n_bytes, n_tokens, over_limit."""
    with open(path, encoding="utf-8") as file:
        definition = file.read()
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    maps = staged(state_maps(rows, definition), "state-maps")
    whole = maps.where("chunks = 1").select("id", "n_bytes", "tokens")
    inside = maps.where("chunks > 1").groupBy("_row").agg(F.first("id").alias("id"), F.first("n_bytes").alias("n_bytes"), F.sum("tokens").alias("inside"))
    across = composed(maps, definition).groupBy("_row").agg(F.sum("tokens").alias("across"))
    long = inside.join(across, "_row").select("id", "n_bytes", (F.col("inside") + F.col("across")).alias("tokens"))
    return whole.unionByName(long).select(
        F.col("id").alias(id_column), "n_bytes", F.col("tokens").alias("n_tokens"), (F.col("tokens") > limit).alias("over_limit"))
