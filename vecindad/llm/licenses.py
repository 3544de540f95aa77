"""Licence scan by a positional index of rare template words.

1. One pass over the texts counts words and keeps the places of those that occur in
   some licence template or base phrase.  Phrases are found there: their words must
   follow one another.
2. Document frequencies of the template words over all documents give their inverse
   frequencies; the index holds, for each template, the places of its rarest words and
   of the two rarest of its key phrase.
3. All words of a file that the index has are looked up, however many licences it names;
   postings of a template that agree on where it would begin in the file are intersected
   by that relative position.  As two words of each key phrase are in the index, a
   template whose key phrase stands in its place is always a candidate.
4. A candidate counts if the template's mandatory key phrase stands at its place
   word for word, and half of the template's words at theirs; that share is the score.
   Places lie in the order of the text, so those of a candidate are within a template's
   length of any word that led to it, and only these are looked at: the work is linear
   in the places of a file.

All of it is DataFrame code.  The index has as many rows as the templates have rare
words, whatever the corpus; places found are grouped by file content and template, with
a map-side combine.  Templates and phrases are arguments; those below are the default.

Defined results: null and empty texts have no words, places or labels; repeated rows
have the same result each; a null id stays null; an empty table gives no row; other
columns are left out.
"""

from __future__ import annotations

import math
import string
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecindad.llm.tables import read, stored

#: Rare words of a template in the index, at most; a word in more than one of ten documents is
#: none, unless it is the rarest.  And words of the key phrase that are always in the index.
RARE_WORDS = 10
RARE_IDF = math.log(10)
KEY_WORDS = 2
COVERAGE = 0.5

# Phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Label, passage of the licence or its usual notice, mandatory key phrase.
TEMPLATES = [
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", "permission is hereby granted free of charge"),
    ("apache-2", "licensed under the apache license version 2 0", "apache license version 2"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at", "except in compliance with the license"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", "creative commons attribution noncommercial"),
    ("cc-by-nc", "creative commons attribution non commercial license", "creative commons attribution non commercial"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", "creative commons attribution sharealike"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4"),
    ("cc0", "cc0 1 0 universal public domain dedication", "public domain dedication"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gnu general public license as published"),
    ("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("epl", "made available under the terms of the eclipse public license", "eclipse public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    ("all-rights-reserved", "all rights reserved", "all rights reserved"),
]

_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Rows of label, passage and key phrase, in lower case, words parted by one space.
Templates = Sequence[tuple[str, str, str]]


def vocabulary(templates: Templates = TEMPLATES, phrases: Mapping[str, str] = PHRASES) -> list[str]:
    return sorted({w for p in phrases for w in p.split()} | {w for _, text, _ in templates for w in text.split()})


def _lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def places(docs: DataFrame, known: list[str] | None = None) -> DataFrame:
    """doc_id, n_words, and the places (w, i) of vocabulary words in the order of the text."""
    known = vocabulary() if known is None else known
    words = F.array_remove(F.split(_lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), _NO_WORD), "")
    found = F.array_compact(
        F.transform("_words", lambda w, i: F.when(w.isin(known), F.struct(w.alias("w"), i.alias("i"))))
    )
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .withColumn("_words", words)
        .select("doc_id", F.size("_words").cast("long").alias("n_words"), found.alias("_places"))
    )


def _starts(phrase: str) -> Column:
    """Where the phrase's words stand one after the other; all of them are in the vocabulary."""
    at = F.col("_places")

    def here(x: Column, k: Column) -> Column:
        whole = x["w"] == phrase.split()[0]
        for step, word in enumerate(phrase.split()[1:], 1):
            other = F.get(at, k + step)
            whole = whole & F.coalesce((other["w"] == word) & (other["i"] == x["i"] + step), F.lit(False))
        return F.when(whole, x["i"])

    return F.array_compact(F.transform(at, here))


def index(
    frequencies: DataFrame, n_docs: int, rare_words: int = RARE_WORDS, templates: Templates = TEMPLATES
) -> DataFrame:
    """(w, template, place): the rarest words of each template and of its key, at each of their places in it."""
    spark = frequencies.sparkSession
    rows = [(t, k, w, w in key.split()) for t, (_, text, key) in enumerate(templates) for k, w in enumerate(text.split())]
    words = spark.createDataFrame(rows, "template int, place int, w string, in_key boolean")
    idf = F.log((F.lit(n_docs) + 1) / (F.coalesce("df", F.lit(0)) + 1))
    ranked = words.join(frequencies, "w", "left").withColumn("idf", idf)
    each = ranked.groupBy("template", "w", "in_key").agg(F.max("idf").alias("idf"))

    def first(some: DataFrame, n: int) -> DataFrame:
        rarest = F.slice(F.sort_array(F.collect_list(F.struct("idf", "w")), asc=False), 1, n)
        return some.groupBy("template").agg(rarest.alias("_best")).select("template", F.posexplode("_best").alias("_rank", "_b"))

    rare = first(each, rare_words).where((F.col("_rank") == 0) | (F.col("_b.idf") >= RARE_IDF))
    best = rare.union(first(each.where("in_key"), KEY_WORDS)).select("template", F.col("_b.w").alias("w")).distinct()
    return ranked.join(best, ["template", "w"]).select("w", "template", "place")


def candidates(files: DataFrame, postings: DataFrame) -> DataFrame:
    """(_file, template, start, _near): where the postings of two or more rare words agree (of all, if there are fewer).

    _near is where one of these words stands among the file's places.
    """
    needed = postings.groupBy("template").agg(F.least(F.lit(2), F.count_distinct("w")).alias("_need"))
    hits = (
        files.select("_file", F.posexplode("_places").alias("_near", "_p"))
        .select("_file", "_near", F.col("_p.w").alias("w"), F.col("_p.i").alias("i"))
        .join(F.broadcast(postings), "w")
    )
    # Two different words: the least is not the greatest.
    return (
        hits.groupBy("_file", "template", (F.col("i") - F.col("place")).alias("start"))
        .agg(F.min("_near").alias("_near"), F.min("w").alias("_least"), F.max("w").alias("_most"))
        .join(F.broadcast(needed), "template")
        .where((F.col("_need") < 2) | (F.col("_least") < F.col("_most")))
        .select("_file", "template", "start", "_near")
    )


def verified(
    found: DataFrame, files: DataFrame, coverage: float = COVERAGE, templates: Templates = TEMPLATES
) -> DataFrame:
    """(_file, labels, score) of candidates whose key phrase and enough of whose words stand in their places."""
    spark = files.sparkSession
    rows = []
    for t, (label, text, key) in enumerate(templates):
        words = text.split()
        first = f" {text} ".index(f" {key} ")
        at = len(text[:first].split())
        rows.append((t, label, words, list(range(at, at + len(key.split())))))
    table = F.broadcast(
        spark.createDataFrame(rows, "template int, label string, _words array<string>, _key array<int>")
    )
    # Places before and after _near that a template of this length can reach.
    size = F.size("_words")
    around = F.slice("_places", F.greatest(F.lit(1), F.col("_near") + 2 - size), 2 * size - 1)
    there = F.filter(
        F.transform(around, lambda p: F.when(F.get("_words", p["i"] - F.col("start")) == p["w"], p["i"] - F.col("start"))),
        lambda k: k.isNotNull(),
    )
    return (
        found.join(files, "_file")
        .join(table, "template")
        .select("_file", "label", "_key", size.alias("_size"), there.alias("_there"))
        .withColumn("_share", F.size("_there") / F.col("_size"))
        .where((F.col("_share") >= coverage) & (F.size(F.array_except("_key", "_there")) == 0))
        .groupBy("_file")
        .agg(F.collect_set("label").alias("_added"), F.max("_share").alias("_share"))
    )


def _checked(templates: Templates) -> None:
    for label, text, key in templates:
        if not key.split() or f" {key} " not in f" {text} ":
            raise ValueError(f"the key phrase of {label!r} is no part of its passage: {key!r}")


def scan(docs: DataFrame, templates: Templates = TEMPLATES, phrases: Mapping[str, str] = PHRASES) -> DataFrame:
    _checked(templates)
    rows = stored(places(docs, vocabulary(templates, phrases)).withColumn("_file", F.xxhash64("_places")))
    # Files with the same places have the same candidates: they are looked up once.
    files = rows.where(F.size("_places") > 0).groupBy("_file").agg(F.first("_places").alias("_places"))
    frequencies = stored(
        rows.select(F.explode(F.array_distinct("_places.w")).alias("w")).groupBy("w").agg(F.count("*").alias("df"))
    )
    # One row per vocabulary word, and one number.
    postings = stored(index(frequencies, rows.count(), templates=templates))
    method = verified(candidates(files, postings), files, templates=templates)

    starts = {phrase: f"_at{k}" for k, phrase in enumerate(phrases)}
    out = rows
    for phrase, name in starts.items():
        out = out.withColumn(name, _starts(phrase))
    every = F.concat(*starts.values())
    base = F.array_compact(F.array(*[F.when(F.size(name) > 0, F.lit(phrases[p])) for p, name in starts.items()]))
    both = F.array_union(base, F.coalesce("_added", F.array().cast("array<string>")))
    return out.join(method, "_file", "left").select(
        "doc_id",
        "n_words",
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(both), ",").alias("labels"),
        F.when(F.size(every) > 0, 1.0).otherwise(F.coalesce("_share", F.lit(0.0))).alias("score"),
    )


def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return scan(read(spark, folder, "documents"))
