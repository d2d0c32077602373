"""License phrases by place, and license notices by an exact set-similarity join of text blocks with templates."""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words after lower-casing A-Z, and phrases with their labels.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: The opening words of well-known public license notices, with labels. At most BLOCK - STEP words each.
TEMPLATES = [
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
#: Words in a block and from one block to the next, and the share of a template's different words that a block has to hold.
BLOCK, STEP, THRESHOLD = 64, 32, 0.8


def words_of(text: Column) -> Column:
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lower, F.lit(f"({WORD})"), F.lit(1))


def places(words: Column, n_words: Column, phrase: str) -> Column:
    """Where the phrase begins; only documents that hold all of its words are searched."""
    parts = phrase.split()
    hold = F.lit(True)
    for part in sorted(set(parts), key=len, reverse=True):
        hold = hold & F.array_contains(words, part)
    here = F.filter(F.sequence(F.lit(0), n_words - 1), lambda k: (F.get(words, k) == parts[0]) & (F.slice(words, k + 1, F.lit(len(parts))) == F.array(*map(F.lit, parts))))
    return F.when(hold, here).otherwise(F.array().cast("array<int>"))


def word_order(words: DataFrame, templates: list[tuple[str, str]]) -> list[str]:
    """The different words of the templates, the rarest first, by the number of documents of ``words`` that hold them.

    As many rows as the templates have words come to the driver, whatever the corpus.
    """
    vocabulary = sorted({w for _, text in templates for w in text.split()})
    found = words.select(F.explode(F.array_intersect(F.array(*map(F.lit, vocabulary)), "words")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["word"]: r["n"] for r in found.collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def in_order(text: str, order: list[str], threshold: float) -> tuple[list[str], int]:
    """The different words of a template, the rarest first, and how many of them a block has to hold."""
    ranked = sorted(set(text.split()), key=order.index)
    return ranked, math.ceil(threshold * len(ranked) - 1e-9)


def prefix_table(spark: SparkSession, templates: list[tuple[str, str]], order: list[str], threshold: float) -> DataFrame:
    """``(word, place, least, label, template)``: the words of each template's prefix, with their places in the global order.

    A block that holds ``least`` words of a template of m words shares one of its m - least + 1 rarest.
    """
    rows = []
    for label, text in templates:
        ranked, least = in_order(text, order, threshold)
        whole = F.array(*map(F.lit, ranked)).alias("template")
        rows += [F.struct(F.lit(w).alias("word"), F.lit(k).alias("place"), F.lit(least).alias("least"), F.lit(label).alias("label"), whole) for k, w in enumerate(ranked[: len(ranked) - least + 1])]
    return spark.range(1).select(F.inline(F.array(*rows)))


def license_scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD, block: int = BLOCK, step: int = STEP) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    Base: places where a phrase stands. Labels add those of every template of which some block of ``block``
    words, one beginning every ``step`` words, holds at least ``threshold`` of the different words. The join is exact: words are ordered by their
    frequency in all documents, a block meets a template by a word of the prefix of each, pairs that are too short or whose
    places leave too few words are dropped, the others are counted. Score: 1 with a phrase, else the
    greatest share of a template (0: none over the threshold). Null and empty texts have no words, null places and empty labels;
    texts are read whole. Rows that repeat and null ids are rows of their own. An empty table gives no rows. Further columns
    play no part.
    """
    templates = TEMPLATES if templates is None else templates
    words = docs.select(F.col(doc_id).alias("doc_id"), words_of(F.col(text)).alias("words"))
    order = word_order(words, templates)
    prefixes = prefix_table(docs.sparkSession, templates, order, threshold)
    ranked = F.array(*map(F.lit, order))
    ordered = [in_order(t, order, threshold) for _, t in templates]
    heads = sorted({w for whole, least in ordered for w in whole[: len(whole) - least + 1]})

    found = words.withColumns({"n_words": F.size("words").cast("long"), "row": F.monotonically_increasing_id()})
    at = {phrase: f"at_{k}" for k, phrase in enumerate(PHRASES)}
    found = found.withColumns({c: places(F.col("words"), F.size("words"), p) for p, c in at.items()})
    begins = F.sequence(F.lit(0), F.greatest(F.size("words") - 1 - (block - step), F.lit(0)), F.lit(step))
    cut = F.transform(begins, lambda k: F.array_intersect(ranked, F.slice("words", k + 1, F.lit(block))))
    hot = F.arrays_overlap("words", F.array(*map(F.lit, heads)))
    everywhere = F.concat(*at.values())
    named = F.array_compact(F.array(*[F.when(F.size(c) > 0, PHRASES[p]) for p, c in at.items()]))
    base = [F.size(everywhere).cast("long").alias("n_base"), F.array_min(everywhere).cast("long").alias("first_word"), F.array_max(everywhere).cast("long").alias("last_word"), F.array_sort(F.array_distinct(named)).alias("named")]
    rows = found.select("row", "doc_id", "n_words", *base, F.explode_outer(F.when(hot, cut)).alias("block"))
    rows = rows.select("*", F.size("block").alias("size"), F.posexplode_outer("block").alias("at", "word"))
    pairs = rows.join(F.broadcast(prefixes), "word", "left")
    long_enough = F.col("size") >= F.col("least")
    room = F.least(F.size("template") - F.col("place"), F.col("size") - F.col("at")) >= F.col("least")
    shared = F.size(F.array_intersect("block", "template"))
    share = F.when(long_enough & room & (shared >= F.col("least")), shared / F.size("template"))
    pairs = pairs.select("row", "doc_id", "n_words", "n_base", "first_word", "last_word", "named", "label", share.alias("share"))
    facts = [F.first(c).alias(c) for c in ("doc_id", "n_words", "n_base", "first_word", "last_word", "named")]
    per = pairs.groupBy("row").agg(*facts, F.collect_set(F.when(F.col("share").isNotNull(), F.col("label"))).alias("joined"), F.max("share").alias("best"))
    labels = F.array_join(F.array_sort(F.array_union("named", "joined")), ",").alias("labels")
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score")
    return per.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("named", ",").alias("base_labels"), labels, score)
