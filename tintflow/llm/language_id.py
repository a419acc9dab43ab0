"""Language identification by words first, backing off to shorter and shorter character n-grams.

Each word known from the labelled texts scores every language by the negative logarithm of its relative frequency
there; a language that lacks it gets a fixed penalty. An unseen word is scored by its n-grams of the largest size of
which at least one is known, by their mean; if none is, by the next smaller size. A document's language is the one with
the smallest mean over its words, equal ones resolved by code point.

The model is fitted on a bounded sample of the labelled rows, taken by a hash of the id: of each language about an equal part of
``sample_docs`` rows, but not fewer than ``least_docs``, and all of them if it has no more. Every language and every word and gram
of the sampled rows is learned. Predictions read whole texts and nothing but the text.

Defined results: a null text, a text without a letter, and any text when nothing was learned get ``und`` with score 0;
equal rows get equal predictions; unlabelled rows teach nothing; a null id counts as not held out; other columns are not
read. ``evidence`` counts the words of which at least one gram is known.
"""

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cached_property
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tintflow.llm.common import bound_batches

SIZES = (5, 4, 3, 2, 1)  # n-grams, tried in this order
WORD = 0  # the size that stands for whole words
PENALTY = 7.0  # negative decimal logarithm given to a language that lacks a gram
DRAWS = 1 << 30  # steps in which the sample's rates are given
CERTAIN_WORDS = 30  # words beyond which more text does not make a prediction more certain

ALNUM = re.compile(r"[^\W\d_]+")
LETTERS = regex.compile(r"\p{L}+")
ASCII_LETTERS = bytes(c if chr(c).isascii() and chr(c).isalpha() else ord(" ") for c in range(256))


def words(text: str) -> Counter:
    """Lower-cased runs of letters with their counts."""
    text = text.lower()
    if text.isascii():
        return Counter(text.encode().translate(ASCII_LETTERS).decode().split())
    found = Counter(ALNUM.findall(text))
    for other in [w for w in found if not w.isalpha()]:
        n = found.pop(other)
        for run in LETTERS.findall(other):
            found[run] += n
    return found


def grams(word: str, size: int) -> list[str]:
    padded = f" {word} " if size > 1 else word
    return [padded[i:i + size] for i in range(len(padded) - size + 1)]


def held_out(id_column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def count_grams(batches):
    for batch in batches:
        by_lang: dict[str, Counter] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            by_lang.setdefault(lang, Counter()).update(words(text.as_py()))
        for lang, found in by_lang.items():
            for size in (WORD, *SIZES):
                counts = found if size == WORD else Counter()
                for word, n in found.items() if size else ():
                    for gram in grams(word, size):
                        counts[gram] += n
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(counts), pa.string()), "size": pa.array([size] * len(counts), pa.int32()),
                    "gram": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})


class Grams:
    """Values of the grams of one size: a row of all languages per gram, of which only those that know the gram are kept.

    The grams stay an Arrow array until one is looked up, which the driver never does.
    """

    def __init__(self, langs: int, grams: pa.Array, starts: np.ndarray, lang: np.ndarray, value: np.ndarray):
        self.langs, self.grams, self.starts, self.lang, self.value = langs, grams, starts, lang, value

    @classmethod
    def of(cls, langs: int, rows: dict[str, np.ndarray]) -> "Grams":
        """From whole rows."""
        return cls(langs, pa.array(rows, pa.string()), langs * np.arange(len(rows) + 1),
                   np.tile(np.arange(langs, dtype=np.int32), len(rows)), np.concatenate([np.empty(0), *rows.values()]))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "places"}

    @cached_property
    def places(self) -> dict[str, int]:
        return {gram: place for place, gram in enumerate(self.grams.to_pylist())}

    def __contains__(self, gram: str) -> bool:
        return gram in self.places

    def find(self, grams: list[str]) -> np.ndarray:
        """Their places, -1 where unknown."""
        return np.fromiter(map(self.places.get, grams, repeat(-1)), np.int64, len(grams))

    def rows(self, places: np.ndarray) -> np.ndarray:
        first, n = self.starts[places], self.starts[places + 1] - self.starts[places]
        kept = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
        rows = np.full((len(places), self.langs), PENALTY)
        rows[np.repeat(np.arange(len(places)), n), self.lang[kept]] = self.value[kept]
        return rows


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
        sample_docs: int = 20_000, least_docs: int = 50) -> dict:
    """The model: languages in code point order, and per gram size the values of each gram in each language.

    The driver and every task hold it: one number per gram and language that knows it, of the sampled rows.
    """
    labelled = docs.select(F.col(id_column).alias("id"), F.col(lang_column).alias("lang"), F.col(text_column).alias("text"))
    labelled = labelled.where(F.col("lang").isNotNull() & ~held_out("id"))
    rows_of = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    langs = sorted(rows_of)
    if not langs:
        return {"langs": [], "values": {}}
    spark = docs.sparkSession
    part = max(least_docs, sample_docs // len(langs))
    below = [(lang, -(-min(part, n) * DRAWS // n)) for lang, n in rows_of.items()]
    # One row per language, which the model holds as well.
    rates = F.broadcast(spark.createDataFrame(below, "lang string, below long"))
    drawn = F.pmod(F.xxhash64(F.lit("language"), "id"), F.lit(DRAWS))
    sample = labelled.join(rates, "lang").where((drawn < F.col("below")) & F.col("text").isNotNull()).select("lang", "text")
    counted = (sample.mapInArrow(count_grams, "lang string, size int, gram string, n long")
               .groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))).toArrow()
    lang = pc.index_in(counted["lang"], value_set=pa.array(langs, pa.string())).to_numpy()
    size, n = counted["size"].to_numpy(), counted["n"].to_numpy()
    values = {}
    for each in (WORD, *SIZES):
        of_size = np.flatnonzero(size == each)
        coded = counted["gram"].take(of_size).combine_chunks().dictionary_encode()
        place, grams_of_size = coded.indices.to_numpy(), coded.dictionary
        by_gram = np.argsort(place, kind="stable")
        rows, n_rows = lang[of_size], n[of_size]
        value = -np.log10(n_rows / np.bincount(rows, n_rows, len(langs))[rows])
        starts = np.searchsorted(place[by_gram], np.arange(len(grams_of_size) + 1))
        values[each] = Grams(len(langs), grams_of_size, starts, rows[by_gram].astype(np.int32), value[by_gram])
    del counted, coded
    pa.default_memory_pool().release_unused()  # what was gathered is not left with the driver beside the model
    return {"langs": langs, "values": values}


class Scorer:
    """Scores of words: learned ones by their place in the model, others by their grams, which are remembered.

    Nothing depends on what is remembered, nor on which words are scored together.
    """

    ROWS = 1 << 16  # unseen words beyond which all are forgotten; a quarter of it is scored together
    CELLS = 1 << 23  # the same, in words times languages

    def __init__(self, model: dict):
        self.langs = model["langs"]
        self.values = {size: Grams.of(len(self.langs), of) if isinstance(of, dict) else of for size, of in model["values"].items()}
        self.most = min(self.ROWS, self.CELLS // (len(self.langs) + 1))
        self.forget()

    def forget(self):
        self.row_of: dict[str, int] = {}
        self.rows = np.empty((1024, len(self.langs) + 1))

    def rows_of(self, found: list[str]) -> np.ndarray:
        """A row per word; its last column tells whether any gram is known."""
        place = self.values[WORD].find(found)
        seen = place >= 0
        rows = np.ones((len(found), len(self.langs) + 1))
        rows[seen, :-1] = self.values[WORD].rows(place[seen])
        unseen = list(compress(found, ~seen))
        self.remember(unseen)
        rows[~seen] = self.rows[np.fromiter(map(self.row_of.__getitem__, unseen), np.int64, len(unseen))]
        return rows

    def remember(self, unseen: list[str]):
        if len(self.row_of) > self.most:
            self.forget()
        new = [w for w in dict.fromkeys(unseen) if w not in self.row_of]
        used, total = len(self.row_of), len(self.row_of) + len(new)
        if total > len(self.rows):
            self.rows = np.concatenate([self.rows[:used], np.empty((max(used, len(new)), self.rows.shape[1]))])
        self.rows[used:total, :-1], self.rows[used:total, -1] = self.back_off(new)
        self.row_of.update(zip(new, range(used, total)))

    def back_off(self, unseen: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A row per word, and whether any gram of it is known."""
        rows, known = np.full((len(unseen), len(self.langs)), PENALTY), np.zeros(len(unseen), bool)
        for size in SIZES:
            left = np.flatnonzero(~known)
            pieces = [grams(unseen[i], size) for i in left]
            place = self.values[size].find(list(chain.from_iterable(pieces)))
            word = np.repeat(np.arange(len(left)), list(map(len, pieces)))[place >= 0]
            n = np.bincount(word, minlength=len(left))
            found = n > 0
            rows[left[found]] = self.sums(size, word, place[place >= 0], len(left))[found] / n[found, None]
            known[left[found]] = True
        return rows, known

    def sums(self, size: int, word: np.ndarray, place: np.ndarray, n_words: int) -> np.ndarray:
        """Per word the sum of its grams' rows, in steps that bound memory whatever the words' lengths."""
        langs = len(self.langs)
        total, step = np.zeros(n_words * langs), max(1, self.CELLS // 4 // langs)
        for at in range(0, len(word), step):
            cell = word[at:at + step, None] * langs + np.arange(langs)
            total += np.bincount(cell.ravel(), self.values[size].rows(place[at:at + step]).ravel(), n_words * langs)
        return total.reshape(n_words, langs)

    def score(self, word: str) -> tuple[np.ndarray, bool]:
        row = self.rows_of([word])[0]
        return row[:-1], bool(row[-1])

    def predict_all(self, texts: Iterable[str | None]) -> Iterator[tuple[str, float, int]]:
        """Language, score and evidence of each text. Words of several texts are scored together."""
        held, n = [], 0
        for text in texts:
            held.append(words(text) if text and self.langs else Counter())
            n += len(held[-1])
            if n >= self.most // 4:
                yield from self.predict_held(held)
                held, n = [], 0
        yield from self.predict_held(held)

    def predict_held(self, held: list[Counter]) -> Iterator[tuple[str, float, int]]:
        together = list(chain.from_iterable(held))
        rows, at = self.rows_of(together) if together else None, 0
        for found in held:
            yield self.predict_words(found, rows[at:at + len(found)]) if found else ("und", 0.0, 0)
            at += len(found)

    def predict_words(self, found: Counter, rows: np.ndarray) -> tuple[str, float, int]:
        counts = np.fromiter(found.values(), np.float64, len(found))
        sums = counts @ rows
        n = counts.sum()
        means = sums[:-1] / n
        best = int(np.argmin(means))
        odds = np.exp(-np.log(10) * (means - means[best]) * min(n, CERTAIN_WORDS))
        return self.langs[best], float(1 / odds.sum()), int(sums[-1])

    def predict(self, text: str | None) -> tuple[str, float, int]:
        return next(self.predict_all([text]))


def predict(docs: DataFrame, model: dict, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, held_out, lang_pred, score (the share of the best language's odds), evidence."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the grams of the sampled rows

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            found = list(scorer.predict_all(text.as_py() for text in batch.column(2)))
            lang, score, evidence = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(evidence, pa.int64())], [id_column, "held_out", "lang_pred", "score", "evidence"])

    id_type = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(id_column, held_out(id_column).alias("_held_out"), text_column)
    return rows.mapInArrow(run, f"`{id_column}` {id_type}, held_out boolean, lang_pred string, score double, evidence long")


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, fit(docs))


def keep_identified(docs: DataFrame, model: dict, text_column: str = "text") -> DataFrame:
    """The rows, all columns, whose text has a word or n-gram of a learned language; nothing else is rejected."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_column))
            kept = [evidence > 0 for _, _, evidence in scorer.predict_all(text.as_py() for text in texts)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
