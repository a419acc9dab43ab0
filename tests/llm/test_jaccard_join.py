"""The n-gram Jaccard join against comparing all pairs."""

import itertools
import random
import re

import pytest

from tintflow.llm import jaccard_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets_of(text, width):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def brute_force(rows, width, percent):
    found = [sets_of(text, width) for _, text in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = found[i], found[j]
        small, large = sorted((len(a), len(b)))
        if small and 100 * small >= percent * large and top(i) != top(j) and 100 * len(a & b) >= percent * len(a | b):
            root[top(i)] = top(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        ids = [k for k in (key, least.get(top(i))) if k is not None]
        least[top(i)] = min(ids) if ids else None
    return sorted(((key, len(found[i]), least[top(i)] if found[i] else key) for i, (key, _) in enumerate(rows)), key=repr)


def near_copies(seed):
    """Texts of all lengths, exact copies, near copies, common passages, and a group of one stock of words."""
    rng = random.Random(seed)
    stock = [f"w{i}" for i in range(400)]
    passage = [rng.choice(stock) for _ in range(60)]
    texts = [None, "", "  \t\n", "One", "one", "ONE two", "a b c", "a b c d", "É b c d", "é b c d", "long" * 9000]
    for _ in range(40):
        words = [rng.choice(stock) for _ in range(rng.choice([5, 9, 12, 16, 20, 40, 90, 300]))]
        if rng.random() < 0.4:
            words[3:3] = passage
        texts.append(" ".join(words))
        for _ in range(rng.choice([0, 1, 3])):
            copy = list(words)
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(stock)
            texts.append((" " if rng.random() < 0.5 else "\n").join(copy[rng.choice([0, 0, 1]):]))
    base = [rng.choice(stock) for _ in range(120)]
    for _ in range(90):
        copy = list(base)
        for _ in range(rng.choice([1, 2, 3, 6])):
            copy[rng.randrange(len(copy))] = rng.choice(stock)
        texts.append(" ".join(copy))
    rows = [(i, text) for i, text in enumerate(texts)]
    rng.shuffle(rows)
    return rows + rows[:3] + [(None, texts[-1]), (None, "alone here for once")]


@pytest.fixture
def batches_of(spark):
    """Rows of a batch that Python gets at once, so that lists reach over batches."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    yield lambda rows: spark.conf.set(key, rows)
    spark.conf.unset(key)


@pytest.mark.parametrize("seed,width,percent,rows_at_once,limits", [
    (1, 4, 85, 10_000, {}), (2, 5, 80, 7, {"LIST": 4, "FREQUENT": 3, "CHUNK": 16}),
    (3, 4, 85, 10_000, {"LIST": 2, "FREQUENT": 2, "SCAN_COST": 1e9, "SMALL": 13}), (4, 4, 85, 2, {"LIST": 3, "FREQUENT": 2, "CHUNK": 8})])
def test_equals_all_pairs(spark, tmp_path, monkeypatch, batches_of, seed, width, percent, rows_at_once, limits):
    for name, value in limits.items():
        monkeypatch.setattr(jaccard_join, name, value)
    batches_of(rows_at_once)
    rows = near_copies(seed)
    frame = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, n_shingles string, hi int")
    frame.repartition(3).write.parquet(str(tmp_path / "docs"))
    found = jaccard_join.join(spark.read.parquet(str(tmp_path / "docs")), width=width, percent=percent)
    assert found.columns == ["_row", "_group", "doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r)[2:] for r in found.collect()), key=repr) == brute_force(rows, width, percent)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    assert jaccard_join.join(spark.read.parquet(str(tmp_path / "docs"))).collect() == []


def test_bitmaps_never_exceed_the_difference():
    rng = random.Random(5)
    import numpy as np
    for _ in range(300):
        a = {rng.getrandbits(60) for _ in range(rng.randrange(1, 900))}
        b = {x for x in a if rng.random() < 0.8} | {rng.getrandbits(60) for _ in range(rng.randrange(0, 200))}
        maps = [jaccard_join.bitmap(np.array(sorted(s), np.int64)) for s in (a, b)]
        assert jaccard_join.at_least_different(*maps) <= len(a ^ b)
