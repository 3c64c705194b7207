"""License scans by diagonal voting, in DataFrame functions only.

All rolling three-word hashes of a text are held against the places of license templates. Matches of
one template at the same offset between text and template lie on a diagonal; diagonals collect
votes, neighbouring ones (a word put in or left out) merge into a span, and a span is verified by
the share of its template that matched word for word. Phrases are templates that must match whole on
one diagonal; they are the base labels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import lower_ascii, stored, table

GRAM = 3
#: Diagonals this many words apart belong to one span.
NEIGHBOUR = 3
#: Share of a template's three-word runs that a span must match.
LEAST = 0.6

# Phrases whose every place counts, with their labels.
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]

# Notices of well-known licenses, as words.
NOTICES = [
    ("mit", "released under the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software "
        "and associated documentation files the software to deal in the software without restriction",
    ),
    ("apache-2", "licensed under the apache license version 2 0"),
    (
        "apache-2",
        "you may not use this file except in compliance with the license you may obtain a copy of "
        "the license at http www apache org licenses license 2 0",
    ),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    (
        "cc-by-nc",
        "this work is licensed under a creative commons attribution noncommercial 4 0 international "
        "license",
    ),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of "
        "the gnu general public license as published by the free software foundation",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
    ),
    (
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
    ),
]

_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, _BREAK), "")


def templates(
    spark, phrases: list[tuple[str, str]] = PHRASES, notices: list[tuple[str, str]] = NOTICES
) -> DataFrame:
    """``template, label, exact, grams, place, gram``: one row for each three-word run of a template.

    Templates are a fixed list; each has at least three words.
    """
    rows = []
    texts = [(label, text, True) for label, text in phrases]
    texts += [(label, text, False) for label, text in notices]
    for no, (label, text, exact) in enumerate(texts):
        words = text.split()
        if len(words) < GRAM:
            raise ValueError(f"a template needs {GRAM} words: {text!r}")
        runs = [words[k : k + GRAM] for k in range(len(words) - GRAM + 1)]
        rows += [(no, label, exact, len(runs), k, gram) for k, gram in enumerate(runs)]
    return spark.createDataFrame(
        rows,
        "template int, label string, exact boolean, grams int, place int, gram array<string>",
    )


def _hits(docs: DataFrame, hashes: list[int]) -> DataFrame:
    """``doc_id, key, n_words, hits``: places whose three-word run has one of the hashes.

    Hashes are taken of fully lower-cased words, which only adds places; ``gram`` has the words with
    A-Z lowered, so the comparison that follows is exact. Lower-casing never changes word borders.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select("doc_id", text.alias("text"), F.md5(text).alias("key"))
    df = df.withColumn("words", _words(F.lower("text"))).withColumn("n_words", F.size("words"))
    rolling = F.when(
        F.col("n_words") >= GRAM,
        F.transform(
            F.sequence(F.lit(1), F.col("n_words") - GRAM + 1),
            lambda k: F.xxhash64(F.slice("words", k, GRAM)),
        ),
    )
    df = df.withColumn("rolling", rolling)
    at = F.filter(
        F.transform("rolling", lambda h, k: F.when(h.isin(hashes), k)), lambda k: k.isNotNull()
    )
    df = df.withColumn("at", at)
    raw = F.when(F.size("at") > 0, _words(F.col("text")))
    df = df.withColumn("raw", raw)
    gram = lambda k: F.transform(F.slice("raw", k + 1, GRAM), lower_ascii)
    hits = F.transform("at", lambda k: F.struct(k.alias("at"), gram(k).alias("gram")))
    return df.select(
        "doc_id", "key", F.col("n_words").cast("long").alias("n_words"),
        F.when(F.size("at") > 0, hits).alias("hits"),
    )


def scan(
    docs: DataFrame,
    phrases: list[tuple[str, str]] = PHRASES,
    notices: list[tuple[str, str]] = NOTICES,
    least: float = LEAST,
) -> DataFrame:
    """One row per document: counts of phrase places, labels, and the best span's share as ``score``.

    A text without matches, a null and an empty text have no labels (empty strings), null places and
    score 0. Equal texts are matched once and repeated rows are kept; ties among spans do not matter,
    as labels are sets. Columns other than ``doc_id`` and ``text`` are not read.
    """
    held = templates(docs.sparkSession, phrases, notices)
    hashes = [r[0] for r in held.select(F.xxhash64("gram")).distinct().collect()]
    light = stored(_hits(docs, hashes))
    votes = (
        light.where("hits IS NOT NULL")
        .dropDuplicates(["key"])
        .select("key", F.explode("hits").alias("hit"))
        .select("key", "hit.at", "hit.gram")
        .join(F.broadcast(held), "gram")
        .withColumn("diagonal", F.col("at") - F.col("place"))
        .groupBy("key", "template", "label", "exact", "grams", "diagonal")
        .agg(F.collect_set("place").alias("places"))
    )
    order = Window.partitionBy("key", "template").orderBy("diagonal")
    reach = F.when(F.col("exact"), 0).otherwise(NEIGHBOUR)
    begins = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > reach, F.lit(True))
    spans = (
        votes.withColumn("begins", begins.cast("int"))
        .withColumn("span", F.sum("begins").over(order))
        .groupBy("key", "template", "label", "exact", "grams", "span")
        .agg(
            F.min("diagonal").alias("first"),
            F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("matched"),
        )
        .withColumn("share", F.col("matched") / F.col("grams"))
        .where(F.when(F.col("exact"), F.col("matched") == F.col("grams")).otherwise(F.col("share") >= least))
    )
    base = F.when(F.col("exact"), F.col("first"))
    joined = lambda labels: F.array_join(F.array_sort(labels), ",")
    by_text = spans.groupBy("key").agg(
        F.count(base).alias("n_base"),
        F.min(base).cast("long").alias("first_word"),
        F.max(base).cast("long").alias("last_word"),
        joined(F.collect_set(F.when(F.col("exact"), F.col("label")))).alias("base_labels"),
        joined(F.collect_set("label")).alias("labels"),
        F.max("share").alias("score"),
    )
    return light.join(by_text, "key", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def op7_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
