"""Top-k search and vector near-duplicates against comparing all pairs."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from tintflow.llm import embedding_dedup, top_k

SCHEMA = "vec_id long, embedding array<float>, label int, score string, component_id string, v int"


def write(spark, tmp_path, rows):
    spark.createDataFrame([(i, v, 1, "x", "y", 3) for i, v in rows], SCHEMA).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    return spark.read.parquet(f"{tmp_path}/embeddings.parquet")


def single(v):
    return None if v is None else [None if x is None else float(np.float32(x)) for x in v]


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def clustered(seed, n=160, dims=6):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(12)]
    rows = []
    for i in range(n):
        centre, noise = rng.choice(centres), rng.choice([0.02, 0.1, 0.4])
        rows.append((i, single([x + rng.gauss(0, noise) for x in centre])))
    rows += [(n + i, rows[7][1]) for i in range(30)]
    rows += [(300, None), (400, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (401, [1.0, math.nan, 0.0, 0.0, 0.0, 0.0]), (402, [math.inf] + [0.0] * 5), (403, [0.0] * 6),
             (500, [1.0, 2.0]), (501, [1.0, 2.0]), (502, []), (600, single([3e38] * 6)), (601, single([-3e38] * 6)), (700, single([1e-38] * 6)), (None, rows[3][1]), (None, [1.0, 2.0])]
    rows += rows[:4] + [(300, None), (100, rows[100][1])]
    rng.shuffle(rows)
    return rows


def best_by_force(rows, k, every):
    scaled = [(i, [math.floor(1024.0 * x) for x in v]) for i, v in rows if usable(v)]
    out = []
    for at, (q, v) in enumerate(scaled):
        if q is None or q % every:
            continue
        scores = [(max(min(sum(a * b for a, b in zip(v, w)), (1 << 63) - 1), -(1 << 63)), i) for j, (i, w) in enumerate(scaled) if j != at and len(w) == len(v)]
        scores.sort(key=lambda s: (-s[0], s[1] is None, s[1]))
        out += [(q, rank, i, score) for rank, (score, i) in enumerate(scores[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("limits", [{}, {"BLOCK_QUERIES": 2, "SLICE": 7, "BINS": 4}])
def test_search(spark, tmp_path, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(top_k, name, value)
    rows = clustered(1)
    df = top_k.search(write(spark, tmp_path, rows), k=10, every=100)
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, df.collect()), key=repr) == best_by_force(rows, 10, 100)


@pytest.mark.parametrize("seed", [3, 4])
def test_dense_near_copies_fill_every_place(spark, tmp_path, seed):
    rng = random.Random(seed)
    base = [rng.gauss(0, 1) for _ in range(8)]
    rows = [(i, single([x + rng.gauss(0, 0.004) for x in base])) for i in range(300)] + [(i, single([rng.gauss(0, 1) for _ in base])) for i in range(300, 400)]
    found = top_k.search(write(spark, tmp_path, rows), k=10, every=2).collect()
    assert Counter(r["query_id"] for r in found) == {i: 10 for i in range(0, 400, 2)}
    assert sorted(map(tuple, found), key=repr) == best_by_force(rows, 10, 2)


def test_ties_at_the_last_place_go_to_smaller_ids(spark, tmp_path):
    rows = [(i, [1.0, 0.0]) for i in range(200)] + [(200, [2.0, 0.0])]
    found = top_k.search(write(spark, tmp_path, rows), k=3, every=100).collect()
    assert sorted(map(tuple, found)) == [(0, 1, 200, 2 << 20), (0, 2, 1, 1 << 20), (0, 3, 2, 1 << 20), (100, 1, 200, 2 << 20), (100, 2, 0, 1 << 20),
                                         (100, 3, 1, 1 << 20), (200, 1, 0, 2 << 20), (200, 2, 1, 2 << 20), (200, 3, 2, 2 << 20)]


def links_by_force(rows, cosine):
    unit = []
    for _, v in rows:
        if usable(v) and any(v):
            most = max(map(abs, v))
            w = np.array(v, float) / most
            unit.append(w / math.sqrt((w * w).sum()))
        else:
            unit.append(None)
    near = [[j for j, y in enumerate(unit) if j != i and x is not None and y is not None and len(x) == len(y) and x @ y >= cosine]
            for i, x in enumerate(unit)]
    out = []
    for i, (key, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = [j for j in near[todo.pop()] if j not in seen]
            seen.update(new)
            todo += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        component = min(ids) if ids else None
        out.append((key, len(near[i]), component, key is not None and key == component))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limits", [{}, {"BLOCK": 16, "LEAF": 4, "FAN": 2}])
def test_links(spark, tmp_path, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(embedding_dedup, name, value)
    rows = clustered(2)
    df = embedding_dedup.link(write(spark, tmp_path, rows), sample=50)
    assert df.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, df.collect()), key=repr) == links_by_force(rows, 0.95)


def test_distant_blocks_are_skipped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rows = [(i, single([math.cos(i / 20), math.sin(i / 20)])) for i in range(126)]
    vectors = write(spark, tmp_path, rows).selectExpr("cast(embedding as array<double>) as v", "1L as weight")
    ordered, along = embedding_dedup.in_grid_order(vectors, 2, math.sqrt(0.1), 100)
    assert embedding_dedup.near_blocks(ordered, math.sqrt(0.1), along.shape[1]).count() < 8 * 9 / 2


def test_no_vectors(spark, tmp_path):
    vectors = write(spark, tmp_path, [(1, None), (None, [0.0]), (100, None)])
    assert Counter(map(tuple, embedding_dedup.link(vectors).collect())) == Counter([(1, 0, 1, True), (None, 0, None, False), (100, 0, 100, True)])
    assert top_k.search(vectors).collect() == []
    assert embedding_dedup.link(vectors.where("false")).collect() == [] and top_k.search(vectors.where("false")).collect() == []
