"""The pipeline's stages, each against brute force on what the stage before it kept."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tintflow.llm import jaccard_join, mixing

from .test_documents import tiktoken_rows, water_levels
from .test_jaccard_join import brute_force

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(11)
    stock = [f"{a}{b}" for a in ("ber", "lin", "or", "che", "sta") for b in ("de", "gen", "ti", "on", "es", "um")]
    texts = [" ".join(rng.choice(stock) for _ in range(rng.choice([3, 8, 30, 80]))) for _ in range(60)]
    for text in texts[:25]:
        words = text.split()
        texts.append(text)
        if len(words) > 25:
            words[0] = rng.choice(stock)
            texts.append(" ".join(words))
    texts += [None, "", "12 !!", "漢字", "berde"]
    rows = [(i, t, None if t == "漢字" else "en", rng.choice(["a", "b", None, "c"]), len(t or "")) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows + rows[:2] + [(None, "lingen on our own here berti chees", None, "a", 3)]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(corpus(), SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append([tuple(r) for r in docs.collect()])
        columns = docs.columns
        assert columns == ["doc_id", "text", "lang", "source", "n_chars"] or stage is corpus_pipeline.tokens
    return folder, out


def test_language_stage(stages):
    kept = Counter(stages[1][0])
    assert kept == Counter(r for r in corpus() if r[1] not in (None, "", "12 !!", "漢字"))


def test_one_of_each_group_stays(stages):
    before, after = stages[1][0], stages[1][1]
    # A row of its own for each id, so that components of repeated and null ids stay apart.
    numbered = [(i, text) for i, (_, text, *_) in enumerate(sorted(before, key=lambda r: (r[0] is None, r[0])))]
    order = sorted(before, key=lambda r: (r[0] is None, r[0]))
    first = {component for _, _, component in brute_force(numbered, 5, 80)}
    assert Counter(after) == Counter(order[i] for i in first)


def test_mix(stages):
    before, after = Counter(stages[1][1]), Counter(stages[1][2])
    assert set(after) <= set(before) and all(n <= 3 * before[row] for row, n in after.items())
    words = lambda row: len(re.findall(r"[^\x20\x09-\x0D]+", row[1] or ""))
    sizes, taken = Counter(), Counter()
    for row, n in before.items():
        sizes[row[3]] += n * words(row)
    for row, n in after.items():
        taken[row[3]] += n * words(row)
    assert all(abs(taken[s] - t) <= 0.02 * t + 5 for s, t in water_levels(sizes).items())


def test_tokens(stages):
    before, after = stages[1][2], stages[1][3]
    assert sorted((r[:4] for r in after), key=repr) == sorted(tiktoken_rows([r[:2] for r in before]), key=repr)


@pytest.fixture
def split_anew(spark):
    """Wraps a function so that scans planned after its call split their files in another way."""
    key = "spark.sql.files.maxPartitionBytes"

    def wrap(run):
        def changed(*args, **named):
            out = run(*args, **named)
            spark.conf.set(key, 100_000)
            return out
        return changed
    yield wrap
    spark.conf.unset(key)


def test_rows_stay_the_same_where_later_scans_split_anew(spark, tmp_path, monkeypatch, split_anew):
    texts = [" ".join(f"w{i}_{j}" for j in range(30)) for i in range(40)]
    rows = [(i, text + end, "en", "ab"[i % 2], 1) for i, (text, end) in enumerate((t, e) for t in texts for e in ("", " more"))]
    spark.createDataFrame(rows, SCHEMA).repartition(9).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    with monkeypatch.context() as patch:
        patch.setattr(jaccard_join, "frequent_shingles", split_anew(jaccard_join.frequent_shingles))
        found = {r["doc_id"]: r["component_id"] for r in jaccard_join.join(docs).collect()}
    assert found == {i: i - i % 2 for i in range(80)}
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    with monkeypatch.context() as patch:
        patch.setattr(jaccard_join, "join", split_anew(jaccard_join.join))
        kept = corpus_pipeline.one_of_each_group(spark, docs, "")
        assert sorted(r["doc_id"] for r in kept.collect()) == list(range(0, 80, 2))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    wanted = Counter({r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()})
    with monkeypatch.context() as patch:
        patch.setattr(mixing, "mix", split_anew(mixing.mix))
        assert Counter(r["doc_id"] for r in corpus_pipeline.mixed(spark, docs, "").collect()) == +wanted


def test_run(spark, stages):
    folder, out = stages
    assert sorted(map(repr, map(tuple, corpus_pipeline.run(spark, folder).collect()))) == sorted(map(repr, out[-1]))


CLASHING = ["row", "_row", "times", "copies", "copy", "_copy", "_metadata", "_group", "component_id", "n_tokens", "ids", "taken", "a b"]


def test_columns_with_clashing_names(spark, stages, tmp_path):
    """Other columns change nothing and are kept, however they are called."""
    folder, out = stages
    extra = spark.createDataFrame(corpus(), SCHEMA)
    for i, name in enumerate(CLASHING):
        extra = extra.withColumn(name, F.lit(i))
    extra.repartition(3).write.parquet(f"{tmp_path}/documents")
    docs = spark.read.parquet(f"{tmp_path}/documents")
    for (name, stage), expected in zip(corpus_pipeline.STAGES[:3], out):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *CLASHING]
        assert docs.select(*[f"`{c}`" for c in CLASHING]).distinct().collect() in ([tuple(range(len(CLASHING)))], [])
        assert Counter(r[0] for r in docs.collect()) == Counter(r[0] for r in expected)


def test_rows_that_are_no_table(spark):
    """Rows that do not lie in files are numbered and stored first."""
    docs = spark.createDataFrame([(i, "all of these texts are the same here", "en", "a", 1) for i in range(4)], SCHEMA)
    assert [r["doc_id"] for r in corpus_pipeline.one_of_each_group(spark, docs, "").collect()] == [0]
    assert corpus_pipeline.mixed(spark, docs, "").count() == sum(r["copies"] for r in mixing.mix(docs).collect())


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_empty_table(spark, tmp_path, name):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/docs")
    out = dict(corpus_pipeline.STAGES)[name](spark, spark.read.parquet(f"{tmp_path}/docs"), "")
    assert out.collect() == [] and (name == "byte_bpe" or out.columns == ["doc_id", "text", "lang", "source", "n_chars"])
