"""License scans by an exact set-similarity join of text blocks with license templates.

A template is found where a run of consecutive words, at most 1 / `threshold` times as long as the template, holds at least
`threshold` of its distinct words. Templates fall into size classes, powers of two over the length of such a run. A class cuts
every text into blocks of twice its size, one starting a size after the other, so any run lies whole inside a block, and short
templates meet short blocks only.

Words are ordered by the number of documents that hold them, over all documents, rarest first. A block that
reaches the threshold must hold one of the template's first |T| - need + 1 words (prefix filter), must have at least
`need` template words at all (length filter), and from the places of a shared word in both ordered lists enough
words must be left (positional filter). What passes is verified by the exact overlap of its runs. The templates are a list of
constants, so their words and prefixes are bounded whatever the documents are.

Edge cases: null texts are empty. Rows of one id are told apart by their texts; repeated rows get the same result.
Templates without words never match.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywire.llm.text import lower_ascii, text_key, written

#: anything but ASCII letters, digits and characters beyond ASCII parts words (fixed value)
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: phrases and their labels (fixed values)
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: short notices as their licenses publish them (fixed values)
TEMPLATES = (
    ("agpl", "GNU Affero General Public License version 3"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "Released under the MIT License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("reserved", "No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)


def license_words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BREAK), "")


def template_words(text: str) -> list[str]:
    return [w for w in re.split(BREAK, text.lower()) if w]


def phrase_figures(words: Column) -> dict[str, Column]:
    """n_base, first_word, last_word, base_labels: places where the words of a phrase stand in a row."""
    line = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    held = [F.contains(line, F.lit(f" {phrase} ")) for phrase, _ in PHRASES]
    hit = held[0]
    for h in held[1:]:
        hit = hit | h
    either = "|".join(phrase for phrase, _ in PHRASES)

    def blanks(part: Column) -> Column:
        return (F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))).cast("long")

    return {
        "n_base": F.when(hit, F.regexp_count(line, F.lit(f" (?:{either})(?= )"))).otherwise(F.lit(0)).cast("long"),
        # as many blanks before a place as there are words
        "first_word": F.when(hit, blanks(F.regexp_extract(line, f"(?s)^(.*?) (?:{either})(?= )", 1))),
        "last_word": F.when(hit, blanks(F.regexp_extract(line, f"(?s)^(.*) (?:{either})(?= )", 1))),
        "base_labels": F.array_sort(F.array_compact(F.array(*[F.when(h, F.lit(label)) for h, (_, label) in zip(held, PHRASES)]))),
    }


def constant_rows(spark: SparkSession, rows: Sequence[dict[str, Column]]) -> DataFrame:
    """The rows as SQL literals."""
    return spark.range(1).select(F.inline(F.array(*[F.struct(*[c.alias(n) for n, c in row.items()]) for row in rows])))


def word_array(words: Sequence[str]) -> Column:
    return F.array(*map(F.lit, words))


def word_order(docs: DataFrame, text_col: str, vocabulary: Sequence[str]) -> DataFrame:
    """One row: the template words, rarest first by documents over the whole table, ties by the word."""
    held = docs.select(F.explode(F.array_intersect(word_array(vocabulary), license_words(F.col(text_col)))).alias("word"))
    # words that no document holds count once too
    every = docs.sparkSession.range(1).select(F.explode(word_array(vocabulary)).alias("word"))
    counts = held.unionByName(every).groupBy("word").agg(F.count("*").alias("n"))
    return counts.agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "word"))), lambda x: x["word"]).alias("words"))


def run_length(words: Sequence[str], threshold: float) -> int:
    """The most consecutive words that a template may be spread over."""
    return math.ceil(len(words) / threshold - 1e-9)


def template_matches(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = 0.9,
) -> DataFrame:
    """_id, _row, block (its first word), template (index), label, containment: every block and template that match."""
    spark = docs.sparkSession
    texts = [(i, label, template_words(text)) for i, (label, text) in enumerate(templates)]
    texts = [(i, label, words) for i, label, words in texts if words]
    vocabulary = sorted({w for _, _, words in texts for w in words})
    found = "_id {}, _row long, block int, template int, label string, containment double"
    if not vocabulary:
        return spark.createDataFrame([], found.format(docs.schema[id_col].dataType.simpleString()))
    order = written(word_order(docs, text_col, vocabulary), "word-order")
    classes: dict[int, list[tuple[int, str, list[str]]]] = {}  # size of a class -> its templates
    for i, label, words in texts:
        classes.setdefault(1 << (run_length(words, threshold) - 1).bit_length(), []).append((i, label, words))

    def need(words: list[str]) -> int:
        return math.ceil(threshold * len(set(words)) - 1e-9)

    rules = constant_rows(
        spark,
        [
            {
                "class": F.lit(step), "template": F.lit(i), "label": F.lit(label), "words": word_array(words), "run": F.lit(run_length(words, threshold)),
                "size": F.lit(len(set(words))), "need": F.lit(need(words)),
            }
            for step, members in classes.items()
            for i, label, words in members
        ],
    )
    rules = rules.withColumn("words", F.array_intersect(order.scalar(), "words"))
    prefix = rules.withColumn("prefix", F.slice("words", F.lit(1), F.col("size") - F.col("need") + 1))

    def cut(step: int, members: list[tuple[int, str, list[str]]]) -> Column:
        """Blocks of a class with enough of its words; none for documents without a word of its prefixes."""
        starts = prefix.where(F.col("class") == step).agg(F.array_distinct(F.flatten(F.collect_list("prefix")))).scalar()
        slices = F.transform(
            F.sequence(F.lit(0), F.size("_w") - 1, F.lit(step)),
            lambda at: F.struct(F.lit(step).alias("class"), at.alias("at"), F.slice("_w", at + 1, F.lit(2 * step)).alias("text")),
        )
        blocks = F.transform(
            slices, lambda b: F.struct(b["class"].alias("class"), b["at"].alias("at"), b["text"].alias("text"), F.array_intersect(F.col(f"_order_{step}"), b["text"]).alias("tokens"))
        )
        least = min(need(words) for *_, words in members)
        enough = F.filter(blocks, lambda b: F.size(b["tokens"]) >= least)
        return F.when((F.size("_w") > 0) & F.arrays_overlap("_w", starts), enough)

    rows = docs.select(F.col(id_col).alias("_id"), text_key(F.col(text_col)).alias("_row"), license_words(F.col(text_col)).alias("_w"))
    for step, members in classes.items():
        own = word_array(sorted({w for *_, words in members for w in words}))
        rows = rows.withColumn(f"_order_{step}", order.select(F.array_intersect("words", own)).scalar())
    cuts = F.flatten(F.array_compact(F.array(*[cut(step, members) for step, members in classes.items()])))
    blocks = rows.select("_id", "_row", F.explode(cuts).alias("b")).select("_id", "_row", "b.*")
    probes = blocks.select("_id", "_row", F.col("class").alias("_class"), "at", "text", "tokens", F.posexplode("tokens").alias("_j", "_token"))
    index = prefix.select("class", "template", "label", "words", "run", "size", "need", F.posexplode("prefix").alias("_i", "_start"))
    left = F.size("tokens")
    possible = F.least("_i", "_j") + 1 + F.least(F.col("size") - F.col("_i") - 1, left - F.col("_j") - 1)
    # the index is built from the constant templates: a few rows each
    pairs = probes.join(
        F.broadcast(index),
        (F.col("_class") == F.col("class")) & (F.col("_token") == F.col("_start")) & (left >= F.col("need")) & (possible >= F.col("need")),
    ).where(F.size(F.array_intersect("tokens", "words")) >= F.col("need"))
    runs = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("text") - F.col("run") + 1))
    shared = F.array_max(F.transform(runs, lambda at: F.size(F.array_intersect(F.col("words"), F.slice("text", at, F.col("run"))))))
    held = pairs.withColumn("_shared", shared).where(F.col("_shared") >= F.col("need"))
    return held.select("_id", "_row", F.col("at").alias("block"), "template", "label", (F.col("_shared") / F.col("size")).alias("containment")).distinct()


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """_id, n_words, phrase figures, labels (sorted array, phrases and templates) and score of every row.

    The score is the best containment among the matches, 0 without any.
    """
    rows = docs.select(F.col(id_col).alias("_id"), text_key(F.col(text_col)).alias("_row"), license_words(F.col(text_col)).alias("_w"))
    figures = phrase_figures(F.col("_w"))
    base = rows.select("_id", "_row", F.size("_w").cast("long").alias("n_words"), *[c.alias(n) for n, c in figures.items()])
    found = template_matches(docs, id_col, text_col, **how).groupBy(F.col("_id").alias("_k"), F.col("_row").alias("_r"))
    found = written(found.agg(F.collect_set("label").alias("_found"), F.max("containment").alias("score")), "license-matches")
    joined = base.join(found, F.col("_id").eqNullSafe(F.col("_k")) & (F.col("_row") == F.col("_r")), "left")
    labels = F.array_sort(F.array_union("base_labels", F.coalesce("_found", F.array().cast("array<string>"))))
    return joined.select(
        "_id", "n_words", "n_base", "first_word", "last_word", "base_labels", labels.alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score")
    )
