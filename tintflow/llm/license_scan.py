"""License phrases and notices: an exact set-similarity join of text blocks with templates, in DataFrame operations only.

Base: the places where the words of a phrase stand consecutively.

The method: a block is a line, a line and the next, or, wherever lines break, a window of as many words as a template has and
as many more as it may miss. Its set holds its words that occur in any template; other words can't match. A block matches a template that it contains to at least ``threshold``. Template words are ordered by how many
documents hold them, the rarest first. A match must share one of the template's first words, as many as it may miss plus one
(prefix); the block must hold enough template words at all (length); and from the first word that both share, enough words
must be left on either side (position). What passes is verified by the intersection. Every template that a line or two match gives
its label, unless all the words that it shares with them are shared by another match that shares more, or that they contain better. Every
template that its window matches gives its label, unless a window of another around it holds the same words and more, or the same words of a template that it
contains better (gpl within gpl-3, cc-by-nc where only cc-by stands). So each notice on a line is found, and every wrapped one.

The templates are the only data sent to every executor; their number is fixed by the caller. Counts cover all documents.

Defined results: null and empty texts have no words, no places and empty labels; score is 1 where a phrase stands, else the best
containment found, else 0; equal rows give equal rows; an empty table gives an empty table; other columns are not read.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tintflow.llm.common import staged

# Phrases with their labels, and usual wordings of license notices.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
TEMPLATES = [
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License"),
    ("gpl", "Licensed under the GNU General Public License"),
    ("gpl-2", "This work is licensed under the GNU General Public License, version 2"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "Licensed under the GNU Lesser General Public License"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the software without restriction"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """The runs between separators: cutting the text there costs less than half of collecting the matches of a word."""
    return F.array_remove(F.split(text, BETWEEN_WORDS), "")


def literal(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def count_in(text: Column, part: str) -> Column:
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("long")


def phrase_places(phrases: dict[str, str]) -> tuple[Column, Column, Column, Column]:
    """Places, first and last start, and labels, from the columns ``spaced`` (every word between two own spaces) and n_words."""
    spaced, none = F.col("spaced"), F.lit(None).cast("long")
    places, first, last, labels = F.lit(0).cast("long"), [none, none], [none, none], []
    for phrase, label in phrases.items():
        key, length = " " + "  ".join(phrase.split()) + " ", len(phrase.split())
        there = F.contains(spaced, F.lit(key))
        places += F.when(there, count_in(spaced, key)).otherwise(0)
        # Both sides of an occurrence hold two spaces a word.
        first.append(F.when(there, (count_in(F.substring_index(spaced, key, 1), " ") / 2).cast("long")))
        last.append(F.when(there, F.col("n_words") - length - (count_in(F.substring_index(spaced, key, -1), " ") / 2).cast("long")))
        labels.append(F.when(there, F.lit(label)))
    return places, F.least(*first), F.greatest(*last), F.array_compact(F.array(*labels))


def word_order(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Place of every template word, by the number of documents that hold it; as many rows as template words."""
    held = docs.select(F.explode(F.array_intersect(words(lowered(F.col("text"))), literal(vocabulary))).alias("word"))
    counts = {r["word"]: r["count"] for r in held.groupBy("word").count().collect()}
    return {word: i for i, word in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}


def surroundings(ordered: list[tuple[str, list[str], int, int]], reach: int) -> Column:
    """From the column words: (at, start, words), the words around each prefix word, from number start on, if they can match."""
    templates = F.array(*[F.struct(literal(held[:len(held) - need + 1]).alias("prefix"), literal(held).alias("words"), F.lit(need).alias("need"))
                          for _, held, need, _ in ordered])
    prefix_words = sorted({w for _, held, need, _ in ordered for w in held[:len(held) - need + 1]})
    places = F.array_compact(F.transform("words", lambda w, i: F.when(w.isin(prefix_words), i)))
    around = F.transform(places, lambda at: F.struct(
        at.alias("at"), F.greatest(at - reach, F.lit(0)).alias("start"),
        F.slice("words", F.greatest(at - reach, F.lit(0)) + 1, F.least(at, F.lit(reach)) + 1 + reach).alias("words")))
    return F.filter(around, lambda n: F.exists(templates, lambda t: F.array_contains(t["prefix"], F.get(n["words"], n["at"] - n["start"]))
                                               & (F.size(F.array_intersect(n["words"], t["words"])) >= t["need"])))


def window_matches(rows: DataFrame, prefix: DataFrame, reach: int) -> DataFrame:
    """_row, label, share of the templates that a window of their width matches, without those inside a better match."""
    def window(first, width):
        return F.slice("words", first - F.col("start") + 1, width)

    near = rows.select("_row", F.inline("near")).withColumn("word", F.get("words", F.col("at") - F.col("start")))
    at = near.join(F.broadcast(prefix), "word")
    firsts = F.filter(F.sequence(F.greatest("start", F.col("at") - F.col("width") + 1), F.col("at")), lambda first: (
        F.array_contains("template", F.get("words", first - F.col("start")))
        & (F.size(F.array_intersect(window(first, F.col("width")), "template")) >= F.col("need"))))
    at = at.withColumn("first", F.explode(firsts)).withColumn("part", window(F.col("first"), F.col("width")))
    # The span from first to last is as short as its words allow: where the first word comes again, a later window holds the same.
    at = at.where(~F.array_contains(F.slice("part", 2, reach + 1), F.get("part", F.lit(0)))).withColumn("shared", F.array_intersect("template", "part"))
    length = F.array_max(F.transform("shared", lambda w: F.array_position("part", w)))
    at = at.withColumn("last", (F.col("first") + length - 1).cast("int"))
    share = F.size("shared") / F.size("template")

    def better(rival, first):
        held = F.array_intersect(rival["words"], window(first, rival["width"]))
        return ((first + rival["width"] > F.col("last")) & (F.size(held) >= rival["need"]) & (F.size(F.array_except("shared", held)) == 0)
                & ((F.size(held) > F.size("shared")) | (F.size(held) / F.size(rival["words"]) > share)))

    def beaten(rival):
        lowest = F.greatest("start", F.col("last") - rival["width"] + 1)
        return F.exists(F.sequence(F.least(lowest, "first"), F.col("first")), lambda first: better(rival, first))

    return at.where(~F.exists("rivals", beaten)).select("_row", "label", share.alias("share"))


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", phrases: dict[str, str] = PHRASES,
         templates: list[tuple[str, str]] = TEMPLATES, threshold: float = 0.9) -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    texts = spark.createDataFrame(templates, "label string, template string")
    sets = [(r["label"], sorted(set(r["words"])), len(r["words"])) for r in texts.select(
        "label", words(lowered(F.col("template"))).alias("words")).collect()]
    place = word_order(docs, sorted({w for _, held, _ in sets for w in held}))
    ordered = [(label, sorted(held, key=place.get), math.ceil(threshold * len(held) - 1e-9), n) for label, held, n in sets if held]
    ordered = [(label, held, need, n + len(held) - need) for label, held, need, n in ordered]
    rivals = [[(held, need, width) for j, (_, held, need, width) in enumerate(ordered) if j != i and len({*held} & {*own}) >= least]
              for i, (_, own, least, _) in enumerate(ordered)]
    prefixes = [(word, i, label, held, need, width, others) for (label, held, need, width), others in zip(ordered, rivals)
                for i, word in enumerate(held[:len(held) - need + 1])]
    in_order = literal(sorted(place, key=place.get))
    least = min((need for _, _, need, _ in ordered), default=0)
    reach = max((width for *_, width in ordered), default=1) - 1

    rows = docs.select(F.monotonically_increasing_id().alias("_row"), "id", lowered(F.col("text")).alias("lower"))
    rows = rows.withColumn("words", words(F.col("lower")))
    # A block can only match if it holds a prefix word, so texts without one are not cut into blocks.
    maybe = F.arrays_overlap("words", literal(sorted({p[0] for p in prefixes})))
    keys = F.arrays_overlap("words", literal(sorted({p.split()[0] for p in phrases})))
    spaced = F.when(keys, F.concat(F.lit(" "), F.array_join("words", "  "), F.lit(" "))).otherwise(F.lit(""))
    lines = F.split("lower", "\n")
    held = F.transform(F.when(maybe, lines).otherwise(literal([])), lambda line: F.array_intersect(in_order, words(line)))
    near = F.when(maybe, surroundings(ordered, reach)) if ordered else F.lit(None)
    rows = rows.select("_row", "id", F.size("words").cast("long").alias("n_words"), spaced.alias("spaced"), held.alias("lines"),
                       near.cast("array<struct<at:int,start:int,words:array<string>>>").alias("near"))
    places, first, last, labels = phrase_places(phrases)
    pairs = F.transform("lines", lambda line, i: F.array_intersect(
        in_order, F.concat(line, F.coalesce(F.get("lines", i + 1), literal([])))))
    blocks = F.filter(F.concat("lines", pairs), lambda block: F.size(block) >= least)
    rows = staged(rows.select("_row", "id", "n_words", places.alias("n_base"), first.alias("first_word"), last.alias("last_word"),
                              labels.alias("base"), F.array_distinct(blocks).alias("blocks"), "near"), "license-words")

    prefix = spark.createDataFrame(prefixes, "word string, i int, label string, template array<string>, need int, width int, "
                                             "rivals array<struct<words:array<string>,need:int,width:int>>")
    entries = (rows.where(F.size("blocks") > 0).select("_row", F.posexplode("blocks").alias("block", "held"))
               .select("_row", "block", "held", F.posexplode("held").alias("j", "word")))
    size, t, b = F.size("template"), F.col("i"), F.col("j")
    candidates = (entries.join(F.broadcast(prefix), "word")
                  .where(F.size("held") >= F.col("need"))
                  .where(1 + F.least(size - t - 1, F.size("held") - b - 1) >= F.col("need"))
                  .where(~F.arrays_overlap(F.slice("template", F.lit(1), t), F.slice("held", F.lit(1), b))))
    matches = candidates.withColumn("shared", F.array_intersect("template", "held")).where(F.size("shared") >= F.col("need"))
    # A block's matches, as many as there are templates at most.
    matches = matches.groupBy("_row", "block").agg(F.collect_list(F.struct(
        "label", (F.size("shared") / size).alias("share"), "shared")).alias("matches"))

    def inside(match, other):
        return ((F.size(F.array_except(match["shared"], other["shared"])) == 0)
                & ((F.size(other["shared"]) > F.size(match["shared"])) | (other["share"] > match["share"])))

    kept = F.filter("matches", lambda match: ~F.exists("matches", lambda other: inside(match, other)))
    best = F.array_max(F.transform("matches", lambda match: match["share"]))
    found = (matches.select("_row", best.alias("share"), F.explode(kept).alias("kept")).select("_row", "kept.label", "share")
             .unionByName(window_matches(rows, prefix, reach)).groupBy("_row")
             .agg(F.collect_set("label").alias("found"), F.max("share").alias("share")))
    labels = F.array_sort(F.array_union("base", F.coalesce("found", literal([]))))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0)))
    return rows.join(found, "_row", "left").select(
        F.col("id").alias(id_column), "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"))
