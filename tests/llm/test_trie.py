"""The conversation trie against brute force."""

import hashlib
import random
import zlib

import pytest

from tintflow.llm import conversation_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, depth int, k1 string, ended int, n_convs string"


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 60), *range(100, 140), 205, 207, 300, 301, 302, 303, -5, -100, 1001]:
        turns = [(t, rng.choice(["user", "assistant", None]), rng.choice(["Hello", "ça va 🎉", "", None, "long " * 50])) for t in range(rng.randrange(1, 7))]
        if c % 7 == 0:
            turns = [(t, "user", f"same {t}") for t in range(8)]
        rows += [(c, *t) for t in turns]
    rows += [(300, t, "user", "only two") for t in (50, 51)]
    rows += [(130, t, "user", f"t{t % 3}") for t in range(10, 150)] + [(131, t, "user", f"t{t % 3}") for t in range(10, 151)]
    rows += [(7, None, "system", "first of all"), (7, None, "system", "first of all"), (8, 0, "user", "tie"), (8, 0, "system", "tie"), (8, 0, "system", "a tie")]
    rows += [(None, 1, "user", "nobody's"), rows[3], rows[3]]
    rng.shuffle(rows)
    return rows


def brute_force(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).digest(), text or ""))
    own = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in own.items()}
    nodes = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        whole = own.get(base, [])[:h] + turns[h:]
        for d in range(len(whole) + 1):
            node = nodes.setdefault(tuple(whole[:d]), {"members": [], "ends": []})
            node["members"].append(c)
            if d == len(whole):
                node["ends"].append(c)
    out = []
    for key, node in nodes.items():
        under = [k for k in nodes if k[:len(key)] == key]
        parents = {k[:-1] for k in nodes if k}
        out.append((min(node["members"]), len(key), min(nodes[key[:-1]]["members"]) if key else None, len(node["members"]),
                    sum(len(k) == len(key) + 1 for k in under), sum(k not in parents for k in under),
                    sum((len(nodes[k]["members"]) - 1) * len(k[-1][1]) for k in under if k),
                    hashlib.sha256(",".join(map(str, sorted(node["ends"]))).encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("light", [1, 20, 4096])
def test_trie(spark, monkeypatch, light):
    rows = conversations(light)
    monkeypatch.setattr(conversation_trie, "TOGETHER", 40)
    df = spark.createDataFrame([(*r, 9, "x", 1, "y") for r in rows], SCHEMA).repartition(3)
    got = conversation_trie.trie(df, light=light)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=repr) == brute_force(rows)


def test_query_and_empty_table(spark, tmp_path):
    rows = conversations(77)
    spark.createDataFrame([(*r, 9, "x", 1, "y") for r in rows], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert sorted(map(tuple, queries.QUERIES["op13_conversation_trie"](spark, str(tmp_path)).collect()), key=repr) == brute_force(rows)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/none/conversations.parquet")
    assert queries.QUERIES["op13_conversation_trie"](spark, f"{tmp_path}/none").collect() == []


def test_ids_of_a_key_over_many_tasks(spark):
    """A key whose ids lie in several tasks and pieces is hashed in ascending order."""
    rows = [(1, 2, i * 3) for i in range(25_000)] + [(1, 3, 5), (0, 0, -4), (0, 0, 10), (0, 0, 9)]
    df = spark.createDataFrame(rows, "k1 long, k2 long, conv_id long").repartition(4)
    expected = {key: hashlib.sha256(",".join(str(c) for c in sorted(r[2] for r in rows if r[:2] == key)).encode()).hexdigest()
                for key in {r[:2] for r in rows}}
    assert {(r["k1"], r["k2"]): r["sha256"] for r in conversation_trie.joined_ids(df).collect()} == expected
