"""License scan by diagonal voting, in built-in functions only.

Every run of ``GRAM`` consecutive words of a text meets the same run in any template through a
join on its hash. A meeting votes for the diagonal ``place in text - place in template``: the words
of one occurrence vote for one diagonal, and a word put in or left out moves the rest of them to a
neighbouring one. Votes are added up by diagonal, neighbouring diagonals of a notice are merged to a
span, and the span's votes are compared word by word with the template before its cover counts.

Phrases are templates that must stand word for word, so each diagonal is judged alone and has to
have every vote. Notices are templates that may be edited: a merged span counts once it covers
``COVER`` of the template's word runs, among them the one that tells the license from its relatives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emisplit.functions import inline_table
from emisplit.llm.common import stored
from emisplit.session import tune

#: Words per rolling hash; no template may be shorter.
GRAM = 3
#: Least share of a notice's word runs that a span has to hold.
COVER = 0.75
#: Diagonals of a notice so many words apart or less are one span.
SLACK = 4
#: A notice's diagonal with fewer votes is taken for chance.
LEAST_VOTES = 2

#: What separates words, in a text in lower case and before.
_BETWEEN, _ANY_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Phrases and labels of the contract.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
# Opening or naming sentences of public license texts, and the words of each that no edit may touch.
NOTICES = (
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at", "compliance with the"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "source and binary"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "attribution 4 0"),
    ("gpl-2", "this work is licensed under the gnu general public license version 2", "license version 2"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", "license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gnu general public"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "without fee is"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "free of charge"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "the public domain"),
)

TEMPLATE = "template int, label string, words array<string>, exact boolean, must int"


def templates(spark: SparkSession, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """``template, label, words, exact, must`` of phrases as (label, words) and notices as (label, words, words to keep).

    Words are in lower case with single blanks between them. ``must`` is the place of the run to keep.
    """
    listed = [(label, text.split(), None) for label, text in phrases]
    listed += [(label, text.split(), keep.split()) for label, text, keep in notices]
    rows = []
    for number, (label, words, keep) in enumerate(listed):
        runs = [words[i : i + GRAM] for i in range(len(words) - GRAM + 1)]
        if not runs or keep is not None and keep not in runs:
            raise ValueError(f"{label}: a template has {GRAM} words or more, and those to keep are a run of {GRAM} of them: {words}")
        rows.append((number, label, words, keep is None, 0 if keep is None else runs.index(keep)))
    return inline_table(spark, rows, TEMPLATE)


def _grams(words: str) -> Column:
    """Every run of ``GRAM`` words as an array of structs; empty if there are fewer words."""
    count = F.greatest(F.size(words) - (GRAM - 1), F.lit(0))
    return F.arrays_zip(*[F.slice(words, i + 1, count).alias(f"w{i}") for i in range(GRAM)])


def _hash() -> Column:
    return F.xxhash64(*[F.col(f"gram.w{i}") for i in range(GRAM)])


def _parts(text: Column, between: str) -> tuple[Column, Column, Column]:
    """(what separators cut the text into, number of the first word in it, number of words)."""
    parts = F.split(F.coalesce(text, F.lit("")), between, -1)
    # Only the ends can be empty.
    first = F.when(parts[0] == "", 2).otherwise(1)
    after = F.size(parts) + F.when(F.element_at(parts, -1) == "", 0).otherwise(1)
    return parts, first, F.greatest(after - first, F.lit(0))


def words_of(text: Column) -> Column:
    """Lower-case words of a text; NULL has none."""
    return F.slice(*_parts(F.translate(text, _UPPER, _LOWER), _BETWEEN))


def votes(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``<keys>, template, diagonal, votes`` with an array of ``struct<at, gram>`` per diagonal.

    ``rows`` have key columns and ``text``. A diagonal holds at most one vote per place of the template.
    """
    keys = [c for c in rows.columns if c != "text"]
    asked = known.select("template", F.posexplode(_grams("words")).alias("at", "gram")).select("template", "at", _hash().alias("hash"))
    words = rows.select(*keys, words_of(F.col("text")).alias("words"))
    runs = words.select(*keys, F.posexplode(_grams("words")).alias("place", "gram")).select(*keys, "place", "gram", _hash().alias("hash"))
    met = runs.join(asked, "hash")
    diagonal = (F.col("place") - F.col("at")).alias("diagonal")
    return met.groupBy(*keys, "template", diagonal).agg(F.collect_set(F.struct("at", "gram")).alias("votes"))


def spans(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``<keys>, label, exact, first, end, cover`` of every verified span.

    ``first`` is the number of the span's first word from 0 on, ``end`` that after its last one.
    Repeated rows with equal keys and text give their spans once.
    """
    keys = [c for c in rows.columns if c != "text"]
    found = votes(rows, known).join(known, "template")
    # Word by word, so that runs with the same hash but other words don't count.
    said = lambda v: F.array(*[v["gram"][f"w{i}"] for i in range(GRAM)])
    same = F.filter("votes", lambda v: said(v) == F.slice("words", v["at"] + 1, GRAM))
    at = F.array_sort(F.transform(same, lambda v: v["at"]))
    runs = (F.size("words") - (GRAM - 1)).alias("runs")
    found = found.select(*keys, "template", "label", "exact", "must", "diagonal", at.alias("at"), runs)
    found = found.where(F.when(F.col("exact"), F.size("at") == F.col("runs")).otherwise(F.size("at") >= LEAST_VOTES))
    by_diagonal = Window.partitionBy(*keys, "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(by_diagonal)
    opens = F.col("exact") | gap.isNull() | (gap > SLACK)
    island = F.sum(F.when(opens, 1).otherwise(0)).over(by_diagonal)
    merged = found.withColumn("island", island).groupBy(*keys, "template", "label", "exact", "must", "runs", "island")
    merged = merged.agg(
        F.min(F.col("diagonal") + F.element_at("at", 1)).alias("first"),
        F.max(F.col("diagonal") + F.element_at("at", -1) + GRAM).alias("end"),
        F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"),
    )
    verified = F.expr("array_contains(at, must)") & (F.size("at") >= F.col("runs") * COVER)
    return merged.where(verified).select(*keys, "label", "exact", "first", "end", (F.size("at") / F.col("runs")).alias("cover"))


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` of every row.

    ``n_base`` counts the places of phrases, ``first_word`` and ``last_word`` are the smallest and the
    largest start of one (NULL without any). ``labels`` has those of notices too. ``score`` is the
    largest cover of a span, 0 without any. NULL and empty texts, and texts of fewer words than a run,
    have no spans. Rows are told apart by id and text (two 64-bit hashes of them), a NULL id being an id as any
    other; rows that are equal in both get the same values, each its own row. No rows give no rows.
    Extra columns are not looked at.
    """
    spark = tune(docs.sparkSession)
    known = templates(spark) if known is None else known
    marks = [F.xxhash64("doc_id", "text").alias("key1"), F.xxhash64(F.lit(1), "doc_id", "text").alias("key2")]
    found = spans(docs.select(*marks, "text"), known)
    # An array of labels is bounded by the templates, whatever the number of spans.
    base = lambda value: F.when(F.col("exact"), value)
    found = found.groupBy("key1", "key2").agg(
        F.count(base(F.lit(1))).alias("n_base"),
        F.min(base(F.col("first"))).cast("long").alias("first_word"),
        F.max(base(F.col("first"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(base(F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("cover").alias("score"),
    )
    # Stored, so that the join reads it through a shuffle of its own and copies of one row can be split.
    found = stored(found, "licenses")
    n_words = _parts(F.col("text"), _ANY_BETWEEN)[2].cast("long")
    rows = docs.select("doc_id", n_words.alias("n_words"), *marks).join(found, ["key1", "key2"], "left")
    return rows.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
