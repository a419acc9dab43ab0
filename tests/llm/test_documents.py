"""The operators on documents against brute force, on rows with nulls, empty and long texts, ties and repeated rows."""

import cProfile
import hashlib
import math
import pickle
import random
import re
import struct
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tintflow.llm import byte_bpe, language_id, license_scan, mixing, queries, sharding, token_counts

SCHEMA = "doc_id long, text string, lang string, source string, n_tokens string, size int, shard string, labels int"
ODD = [None, "", " \n\t ", "One two", "don't stop 've é漢字 🎉 ½x ﬁ İΣς", "<|endoftext|>a<|startoftext|>", "a" * 3000, " " * 2000 + "x",
       "1234 5678\r\n\r\n!!??", "ẞ é    \x85 \x1c z", "Σας ΣΑΣ ͸ Ᲊ"]


def write(spark, tmp_path, texts, ids=None):
    sources = ["b", "a", None, "c", "a", "ä"]
    rows = [(i if ids is None else ids[i], t, "en", sources[i % 6], "x", 1, "y", 2) for i, t in enumerate(texts)]
    rows += rows[:5] + [(None, "no id here", None, "b", None, None, None, None)] * 2
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return [(r[0], r[1], r[3]) for r in rows]


def nothing(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")


def found(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def some_texts(seed, n=60):
    rng = random.Random(seed)
    stock = ["the", "apache", "license", "version", "2", "0", "under", "mit", "cc", "by", "nc", "gnu", "released", "licensed", "x", "Ünd"]
    return ODD + [(rng.choice([" ", "-", "\n", ", "])).join(rng.choice(stock) for _ in range(rng.randrange(1, 40))) for _ in range(n)]


@pytest.mark.parametrize("name", ["op1_sharding", "op2_language_id", "op3_license_scan", "op5_token_counts", "op6_mixing", "op10_byte_bpe"])
def test_empty_table(spark, tmp_path, name):
    nothing(spark, tmp_path)
    assert queries.QUERIES[name](spark, str(tmp_path)).collect() == []


# Sharding

@pytest.mark.parametrize("rows", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation(rows):
    places = sharding.permuted(np.arange(rows), rows, seed=3)
    assert sorted(places) == list(range(rows))
    assert list(sharding.restored(places, rows, seed=3)) == list(range(rows))


def test_shards(spark, tmp_path):
    rows = write(spark, tmp_path, some_texts(1))
    df = queries.QUERIES["op1_sharding"](spark, str(tmp_path))
    expected = [(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows]
    assert found(df, "doc_id", "size", "text_crc32") == sorted(expected, key=repr)
    slots = {}
    for shard, slot, law, grown in df.select("shard", "slot", "law", "grown_shard").collect():
        slots.setdefault(shard, []).append(slot)
        assert (law, grown) == ("rows", None)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(24))
    assert max(map(len, slots.values())) - min(len(slots.get(i, ())) for i in range(24)) <= 1
    again = sharding.shard(spark.read.parquet(f"{tmp_path}/documents.parquet").repartition(7, "text"))
    columns = ["doc_id", "size", "text_crc32", "shard", "slot", "row_number"]
    assert found(df, *columns) == found(again, *columns)


def test_many_copies_are_spread(spark, monkeypatch):
    monkeypatch.setattr(sharding, "REPEAT", 16)
    docs = spark.range(1000).select(F.lit(5).alias("doc_id"), F.lit("same").alias("text"))
    assert sharding.shard(docs).select("row_number").distinct().count() == 1000


# Language

LANGUAGES = {"en": "the of and with house water green", "de": "der und mit haus wasser grün ß", "fr": "le la et avec maison eau vert é"}


def test_language(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(LANGUAGES[lang].split()) + rng.choice(["", "", "s", "en"]) for _ in range(12)), lang)
            for i in range(150) for lang in [rng.choice(sorted(LANGUAGES))]]
    rows += [(900, None, "en"), (901, "", "de"), (902, "123 !! ½", "fr"), (None, "der und mit", None), (903, "漢字", None), (904, "a²b THE", None)]
    rows += rows[:3]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, score string")
    got = language_id.identify(docs).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    right = [by_id[i]["lang_pred"] == lang for i, _, lang in rows if i is not None and i < 900 and by_id[i]["held_out"]]
    assert len(right) > 20 and np.mean(right) >= 0.95
    assert [(by_id[i]["lang_pred"], by_id[i]["score"]) for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert by_id[None]["lang_pred"] == "de" and by_id[904]["lang_pred"] == "en"
    assert by_id[903]["evidence"] == 0 and by_id[903]["lang_pred"] in LANGUAGES
    assert all(0 <= r["score"] <= 1 for r in got)
    kept = language_id.keep_identified(docs, language_id.fit(docs))
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == set(by_id) - {900, 901, 902, 903}


def test_language_ignores_held_out_labels_and_learns_nothing_from_none(spark):
    rows = [(i, "der und mit" if zlib.crc32(str(i).encode()) % 3 == 1 else "the of and", "de" if zlib.crc32(str(i).encode()) % 3 == 1 else "en") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in language_id.identify(docs).collect()} == {"en"}
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {(r["lang_pred"], r["score"]) for r in language_id.identify(unlabelled).collect()} == {("und", 0.0)}


def language_row(rows, text):
    """Plain statement of fit and score: (best languages, score) of ``text`` after learning all (text, lang) ``rows``."""
    def words(t):
        return regex.findall(r"\p{L}+", t.lower())

    def pieces(word, size):
        padded = f" {word} " if size > 1 else word
        return [word] if size == 0 else [padded[k:k + size] for k in range(len(padded) - size + 1)]

    langs = sorted({lang for _, lang in rows})
    counts = {(lang, size): Counter(g for t, of in rows if of == lang for w in words(t) for g in pieces(w, size))
              for lang in langs for size in range(6)}
    found = words(text)
    if not found:
        return ["und"], 0.0

    def value(lang, size, gram):
        n = counts[lang, size][gram]
        return -math.log10(n / counts[lang, size].total()) if n else 7.0

    means = []
    for lang in langs:
        total = 0.0
        for word in found:
            for size in (0, 5, 4, 3, 2, 1):
                known = [g for g in pieces(word, size) if any(counts[of, size][g] for of in langs)]
                if known:
                    total += sum(value(lang, size, g) for g in known) / len(known)
                    break
            else:
                total += 7.0
        means.append(total / len(found))
    best = [lang for lang, m in zip(langs, means) if m < min(means) + 1e-9]
    return best, 1 / sum(10 ** (-(m - min(means)) * min(len(found), 30)) for m in means)


def test_language_equals_its_plain_statement(spark):
    rng = random.Random(5)
    vocabulary = ["the", "of", "and", "der", "und", "mit", "le", "la", "été", "что", "漢字", "naïve", "theta", "a²b"]
    rows = [(i, " ".join(rng.choice(vocabulary) + rng.choice(["", "", "n", "er", "xq"]) for _ in range(rng.randint(0, 9))), rng.choice("abc"))
            for i in range(120)] + [(500, "12 !", "a"), (501, "zzz", None), (502, "unheard", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    learned = [(t, lang) for i, t, lang in rows if lang and zlib.crc32(str(i).encode()) % 3 != 1]
    text_of = {i: t for i, t, _ in rows}
    for r in language_id.identify(docs).collect():
        best, score = language_row(learned, text_of[r["doc_id"]])
        assert r["score"] == pytest.approx(score, rel=1e-6) and r["lang_pred"] in best


def test_a_rare_language_is_learned_from_all_its_rows(spark):
    rows = [(i, "the of and in", "en") for i in range(3000)] + [(9001 + i, "αυτό είναι", "el") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs, sample_docs=40, least_docs=20)
    assert model["langs"] == ["el", "en"] and "αυτό" in model["values"][0] and "the" in model["values"][0]
    got = language_id.predict(docs.where("lang = 'el'"), model).collect()
    assert len(got) == 8 and {r["lang_pred"] for r in got} == {"el"}


def test_every_language_and_gram_is_learned(spark):
    rows = [(3 * k, "w" + "".join(chr(97 + int(c)) for c in str(k)), f"l{k}") for k in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = {lang for i, _, lang in rows if zlib.crc32(str(i).encode()) % 3 != 1}
    model = language_id.fit(docs, sample_docs=10, least_docs=1)
    assert set(model["langs"]) == learned
    assert all(t in model["values"][0] for _, t, lang in rows if lang in learned)


def test_back_off_takes_the_largest_known_size():
    model = {"langs": ["a", "b"], "values": {0: {"known": np.array([1.0, 2.0])}, 5: {}, 4: {}, 3: {" ab": np.array([3.0, 4.0])},
                                             2: {"ab": np.array([9.0, 0.0])}, 1: {}}}
    scorer = language_id.Scorer(model)
    assert [list(scorer.score(w)[0]) for w in ("known", "abc", "xab", "zz")] == [[1, 2], [3, 4], [9, 0], [7, 7]]


def test_unseen_words_are_scored_together_and_alike(monkeypatch):
    rng = random.Random(8)
    values = {size: {} for size in range(6)}
    for word in ["abcab", "été", "x", "bca", "ab", "ca", "漢字"]:
        for size in range(6):
            for gram in [word] if size == 0 else language_id.grams(word, size):
                values[size][gram] = np.array([rng.random(), rng.choice([language_id.PENALTY, rng.random()])])
    model = {"langs": ["a", "b"], "values": values}
    texts = [" ".join("".join(rng.choice("abcxé漢9²A") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 40)))
             for _ in range(300)] + [None, "", "1 ²!", "zzz", "KÅ", "ab" * 5000]
    alone = [language_id.Scorer(model).predict(t) for t in texts]
    for t, (lang, score, evidence) in zip(texts, alone):
        found = Counter(regex.findall(r"\p{L}+", (t or "").lower()))
        total, known = np.zeros(2), 0
        for word, n in found.items():
            sizes = [[values[size][g] for g in ([word] if size == 0 else language_id.grams(word, size)) if g in values[size]]
                     for size in (0, 5, 4, 3, 2, 1)]
            rows = next(filter(None, sizes), [])
            total += n * (np.mean(rows, axis=0) if rows else language_id.PENALTY)
            known += n * bool(rows)
        means = total / max(1, found.total())
        assert evidence == known and (lang == "und" if not found else lang == "ab"[int(np.argmin(means))])
        assert score == pytest.approx(0 if not found else 1 / sum(10 ** (-(means - means.min()) * min(found.total(), 30))))
    assert list(language_id.Scorer(model).predict_all(iter(texts))) == alone
    monkeypatch.setattr(language_id.Scorer, "ROWS", 50)
    monkeypatch.setattr(language_id.Scorer, "CELLS", 60)
    assert [r[::2] for r in language_id.Scorer(model).predict_all(texts)] == [r[::2] for r in alone]


def test_language_costs_few_calls_a_word(spark):
    names = ["".join(chr(97 + int(c)) for c in str(10_000 + 7 * k)) for k in range(4000)]
    docs = spark.createDataFrame([(3 * k, w, "ab"[k % 2]) for k, w in enumerate(names[:2000])], "doc_id long, text string, lang string")
    model = language_id.fit(docs)
    scorer, profile = language_id.Scorer(model), cProfile.Profile()
    profile.runcall(lambda: [scorer.predict(" ".join(names[k:k + 500])) for k in range(0, 4000, 500)])
    assert sum(call.callcount for call in profile.getstats()) < 10 * len(names)


def test_the_driver_makes_no_dictionary_of_grams(spark):
    docs = spark.createDataFrame([(i, "the of and", "en") for i in range(30)], "doc_id long, text string, lang string")
    model = language_id.fit(docs)

    def dictionaries(values):
        return [v for of in values.values() for v in vars(of).values() if isinstance(v, dict)]

    assert not dictionaries(model["values"])
    assert "the" in model["values"][0] and "zzz" not in model["values"][0] and dictionaries(model["values"])
    assert not dictionaries(pickle.loads(pickle.dumps(model))["values"])


def test_the_model_takes_few_bytes_a_gram_on_the_driver(spark):
    word = "translate(cast(id * 20 + k as string), '0123456789', 'abcdefghij')"
    docs = spark.range(3000).selectExpr("3 * id as doc_id", "'en' as lang", f"concat_ws(' ', transform(sequence(1, 20), k -> {word})) as text")
    language_id.fit(docs.limit(30))  # what is imported and remembered on first use does not count
    tracemalloc.start()
    try:
        model = language_id.fit(docs)
        kept = tracemalloc.get_traced_memory()[0] + sum(of.grams.nbytes for of in model["values"].values())
    finally:
        tracemalloc.stop()
    n_grams = sum(len(of.starts) - 1 for of in model["values"].values())
    assert n_grams > 90_000 and kept < 50 * n_grams


# Licences

LICENCE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def licence_words(text):
    return LICENCE_WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def licence_row(text, threshold=0.9):
    words, starts, base = licence_words(text), [], set()
    for phrase, label in license_scan.PHRASES.items():
        key = phrase.split()
        here = [i for i in range(len(words)) if words[i:i + len(key)] == key]
        starts += here
        base |= {label} if here else set()
    lines = [set(licence_words(line)) for line in (text or "").split("\n")]
    labels, score = set(base), 1.0 if base else 0.0
    for block in lines + [a | b for a, b in zip(lines, lines[1:])]:
        fits = []
        for label, template in license_scan.TEMPLATES:
            held = set(licence_words(template))
            if len(held & block) >= threshold * len(held) - 1e-9:
                fits.append((len(held & block) / len(held), held & block, label))
        labels |= {label for share, common, label in fits
                   if not any(common <= other and (len(other) > len(common) or better > share) for better, other, _ in fits)}
        score = max([score, *(f[0] for f in fits)])
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score)


def test_licences(spark, tmp_path):
    notices = [t for _, t in license_scan.TEMPLATES]
    texts = some_texts(3) + notices + [f"Some text.\n{a}\n{b[:50]}\n{b[50:]} end." for a, b in zip(notices, notices[3:])]
    texts += ["cc by nc cc by nc by cc by nc", "Under_the MIT  license, under the mit license under the mit licenses",
              "Permission is hereby\ngranted, free of charge, to any person obtaining", "x \x7fapache\tLICENSE (version 2)"]
    rows = write(spark, tmp_path, texts)
    df = queries.QUERIES["op3_license_scan"](spark, str(tmp_path))
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert found(df, *columns) == sorted(((i, *licence_row(t)) for i, t, _ in rows), key=repr)


MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy", 'of this software and associated documentation files (the "Software"), to deal',
       "in the Software without restriction, including without limitation the rights")


def test_wrapped_notices(spark):
    cases = [
        ("\n".join(MIT), "mit"), ("x\n" + "\n".join(" ".join(MIT).split()), "mit"),
        ("Redistribution and use in source and binary forms, with\nor without modification, are permitted provided that the\nfollowing conditions are met:", "bsd"),
        ("This\nwork is\nlicensed under CC\nBY-NC 4.0", "cc-by-nc")]
    cases += [(notice.replace(" ", gap), label) for label, notice in license_scan.TEMPLATES for gap in (" ", "\n")]
    same_labels(spark, cases)


def same_labels(spark, cases):
    found = {r["doc_id"]: r for r in license_scan.scan(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")).collect()}
    assert [(text, found[i]["labels"]) for i, (text, _) in enumerate(cases)] == cases
    assert all(r["score"] >= 0.9 for r in found.values())


def test_several_notices_on_a_line(spark):
    same_labels(spark, [
        ("Released under the MIT License. Licensed under the Apache License, Version 2.0", "apache-2,mit"),
        ("licensed under the GNU General Public License. Text: licensed under CC BY 4.0", "cc-by,gpl"),
        ("Licensed under CC BY-NC 4.0. Licensed under CC BY 4.0", "cc-by,cc-by-nc")])


def test_matches_whose_words_lie_scattered(spark):
    """Every verified match of a line keeps its label, whatever stands between its words."""
    same_labels(spark, [
        ("... licensed under the very permissive Apache License, as published by ASF, Version 2.0; docs licensed under the well-known CC BY 4.0",
         "apache-2,cc-by"),
        ("Released by us under the well known MIT open License. Licensed by us under the Apache public License in Version 2.0", "apache-2,mit"),
        ("this work, all of it, is licensed to you under the GNU General Public License, version 3", "gpl-3")])


def test_licence_scan_uses_no_python(spark, tmp_path):
    write(spark, tmp_path, ["Released under the MIT License."])
    plan = queries.QUERIES["op3_license_scan"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


# Tokens

@pytest.mark.parametrize("chunk", [1 << 16, 16])
def test_token_counts(spark, tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(token_counts, "CHUNK", chunk)
    rows = write(spark, tmp_path, some_texts(4))
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = []
    for i, text, _ in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        expected.append((i, len((text or "").encode()), n, n > 2048))
    df = queries.QUERIES["op5_token_counts"](spark, str(tmp_path))
    assert found(df, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(expected, key=repr)


def test_transducer_on_random_words():
    rng = random.Random(5)
    path = public_tokenizers.path("word_bpe_49k.json")
    counter, library = token_counts.Counter(open(path, encoding="utf-8").read()), Tokenizer.from_file(path)
    for _ in range(3000):
        text = "".join(rng.choice("abehinorstu'S .<|é漢7\ń") for _ in range(rng.randrange(40)))
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def tiktoken_rows(rows):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        yield (i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


@pytest.mark.parametrize("pattern", [r"\S|\s+", r"\p{L}+|\P{L}", public_tokenizers.PATTERN])
def test_byte_bpe_splits_by_the_pattern_it_is_given(pattern):
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    own = byte_bpe.ByteBPE(ranks, pattern)
    for text in ("hello world", "it's 12 o'clock\n\n  naïve ", "Ωmega and hello"):
        assert np.frombuffer(b"".join(own.encode(text)), "<u4").tolist() == library.encode_ordinary(text)


def test_byte_bpe(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(byte_bpe, "LONG", 200)
    rows = write(spark, tmp_path, some_texts(6))
    df = queries.QUERIES["op10_byte_bpe"](spark, str(tmp_path))
    assert found(df, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(tiktoken_rows([r[:2] for r in rows]), key=repr)


def test_round_trip(spark, tmp_path):
    rows = write(spark, tmp_path, some_texts(7))
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode_table(spark.read.parquet(f"{tmp_path}/documents.parquet"), path, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode_table(encoded, path)
    assert found(decoded, "doc_id", "text") == sorted(((i, t or "") for i, t, _ in rows), key=repr)


def test_byte_bpe_on_random_bytes():
    rng = random.Random(8)
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    bpe = byte_bpe.ByteBPE(ranks, public_tokenizers.PATTERN)
    for _ in range(2000):
        piece = bytes(rng.choice(b"aeinrst hE\xc3\xa9\xe6\xbc\xff") for _ in range(rng.randrange(1, 40)))
        assert bpe.encode_piece(piece) == bpe.merged(piece)


# Mixing

def water_levels(sizes, weights=(5, 2, 1), cap=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[s] for s in full)
        free = sum(weight[s] for s in sizes if s not in full)
        target = {s: cap * sizes[s] if s in full else rest * weight[s] / free for s in sizes} if free else {s: cap * sizes[s] for s in sizes}
        above = {s for s in sizes if s not in full and target[s] > cap * sizes[s]}
        if not above:
            return target
        full |= above


def test_mixing(spark, tmp_path):
    rng = random.Random(9)
    texts = ODD + [" ".join(["w"] * rng.choice([1, 2, 3, 5, 8, 30, 200])) for _ in range(300)]
    rows = write(spark, tmp_path, texts)
    df = queries.QUERIES["op6_mixing"](spark, str(tmp_path))
    got = df.collect()
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    sizes = {}
    for (_, _, source), n in zip(rows, size):
        sizes[source] = sizes.get(source, 0) + n
    target = water_levels(sizes)
    expected = [(i, n, sizes[s], round(target[s], 6)) for (i, _, s), n in zip(rows, size)]
    assert sorted(((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6)) for r in got), key=repr) == sorted(expected, key=repr)
    assert all(0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"] for r in got)
    taken = {}
    for r in got:
        taken[r["target"], r["source_size"]] = taken.get((r["target"], r["source_size"]), 0) + r["taken"]
    assert all(abs(n - t) <= 0.02 * t + 3 for (t, _), n in taken.items()), taken
    assert found(df, *df.columns) == found(queries.QUERIES["op6_mixing"](spark, str(tmp_path)), *df.columns)


def test_tilts_solve_the_dual(spark):
    classes = spark.createDataFrame([("a", s, n, 1000, t, 10.0) for s, n, t in [(1, 100, 700.0), (20, 20, 700.0), (250, 2, 700.0)]]
                                    + [("b", 10, 10, 100, 300.0, 10.0)], "source string, size long, n long, source_size long, target double, mean_size double")
    tilt = {r["source"]: r["tilt"] for r in mixing.tilts(classes, 3.0).collect()}
    assert set(tilt) == {"a"}
    words = sum(n * s * min(3.0, np.exp(tilt["a"] * s / 10.0)) for s, n in [(1, 100), (20, 20), (250, 2)])
    assert abs(words - 700.0) < 1e-6
