"""License scan by diagonal voting, with DataFrame functions only.

Templates are short notices and phrases. Every run of ``K`` words of every document is joined, by hash and then by its
words, to the places of the same run in the templates. A hit votes for the diagonal (its place in the document less that
in the template); votes are counted per diagonal. A single diagonal is a span: a copy without edits, whatever stands
beside it. Of templates longer than one run, diagonals that lie at most ``NEAR`` words apart are also merged, which bridges
inserted and dropped words, as a whole and in parts that end where the template's words start over, so that copies close
together stay copies. A span is verified by the share of the template's words that its hits cover and by its length.
Phrases of two or three words are matched as one run.

The templates are a few hundred words, so their side of the join is small whatever the corpus; only hits and one row per
document with its length are shuffled. Defined results: a null or empty text has no words, no label and score 0; repeated rows have equal results;
words are compared after lower-casing A-Z; an empty table gives no rows; only id and text are read.
"""

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import materialize, query, table

K = 4
NEAR = 3
#: Share of a template's words that a span must cover, and how many times the template's length it may have.
COVERED, LONGER = 0.7, 1.6
#: Fixed value: base phrases and labels.
PHRASES = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]
#: Fixed value: texts of public license notices, and the label of each.
NOTICES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
            "conditions and the following disclaimer."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
               "with the License. You may obtain a copy of the License at"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
            "later version."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "All rights reserved."),
]
#: What stands between words, before lower-casing.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Template number of the row that only tells a document's length.
LENGTH = -1


def lowered(text):
    return F.translate(text, UPPER, LOWER)


def words(text):
    """Words of a text, not yet lower-cased; splitting takes one pass, extracting matches copies the text for each."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BETWEEN), lambda w: w != "")


def template_rows(spark):
    """template, label, base, n_words, words of every phrase and notice."""
    texts = [(label, True, text) for text, label in PHRASES] + [(label, False, text) for label, text in NOTICES]
    rows = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(base).alias("base"), F.lit(text).alias("text"))
        for i, (label, base, text) in enumerate(texts)])))
    w = words(lowered(F.col("text")))
    return rows.select("template", "label", "base", F.size(w).alias("t_words"), w.alias("words"))


def _runs(w, places, size):
    """Runs of words as structs (at, gram) at the places that have so many words left."""
    return F.transform(F.filter(places, lambda i: i <= F.size(w) - size), lambda i: F.struct(
        i.alias("at"), lowered(F.array_join(F.slice(w, i + 1, size), " ")).alias("gram")))


def template_index(spark):
    """gram, its hash, template and place, one row per run of every template; phrases shorter than K have one run."""
    rows = template_rows(spark).withColumn("places", F.sequence(F.lit(0), F.col("t_words") - 1))
    size = F.least(F.col("t_words"), F.lit(K))
    index = None
    for n in range(2, K + 1):
        part = rows.filter(size == n).select("template", F.explode(_runs(F.col("words"), F.col("places"), n)).alias("g"))
        index = part if index is None else index.unionByName(part)
    length = spark.range(1).select(F.lit(LENGTH).alias("template"), F.struct(F.lit(0).alias("at"), F.lit("").alias("gram")).alias("g"))
    return index.unionByName(length).select("template", F.col("g.at").alias("t_at"), "g.gram", F.xxhash64("g.gram").alias("hash"))


def _starts():
    """First and second words of all template runs."""
    texts = [re.findall(r"[0-9a-z]+", t.lower()) for t in [p for p, _ in PHRASES] + [t for _, t in NOTICES]]
    last = [max(1, len(w) - K + 1) for w in texts]
    return tuple(sorted({w[i + k] for w, n in zip(texts, last) for i in range(n)}) for k in (0, 1))


def hits(docs):
    """Places where a run of a document is a run of a template: doc, template, place in each.

    Each document also has one row of template ``LENGTH`` whose place is its number of words. Runs that start with two
    words that no template run starts with are left out before they are written down.
    """
    first, second = _starts()
    w, places = F.col("words"), F.col("places")
    two = F.sequence(F.lit(0), F.greatest(F.size(w) - 2, F.lit(0)))
    grams = docs.select("doc", words(F.col("text")).alias("words")) \
        .select("doc", "words", F.filter(two, lambda i: F.lower(F.get(w, i)).isin(first)
                                         & F.lower(F.get(w, i + 1)).isin(second)).alias("places")) \
        .select("doc", F.explode(F.concat(*[_runs(w, places, n) for n in range(2, K + 1)], F.array(
            F.struct(F.size(w).alias("at"), F.lit("").alias("gram"))))).alias("g")) \
        .select("doc", "g.*", F.xxhash64("g.gram").alias("hash"))
    index = template_index(docs.sparkSession)
    same = (grams["hash"] == index["hash"]) & (grams["gram"] == index["gram"])
    return grams.join(index, same).select("doc", "template", "at", "t_at")


def spans(found, templates):
    """Verified spans: doc, template, first word, words covered, score; ``found``: hits. Spans of one place may overlap."""
    sizes = templates.select("template", "label", "base", "t_words")
    hit = found.withColumn("diagonal", F.col("at") - F.col("t_at"))

    def gathered(rows, *more):
        return rows.groupBy("doc", "template", *more) \
            .agg(F.min("at").alias("lo"), F.max("at").alias("hi"), F.collect_set("t_at").alias("t")).drop(*more)

    by = Window.partitionBy("doc", "template").orderBy("diagonal")
    fresh = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by) > NEAR, F.lit(True))
    chained = hit.join(sizes.filter(F.col("t_words") > K).select("template"), "template", "left_semi") \
        .withColumn("fresh", fresh.cast("int")).withColumn("chain", F.sum("fresh").over(by))
    order = Window.partitionBy("doc", "template", "chain").orderBy("at", "t_at")
    again = F.coalesce(F.col("t_at") <= F.lag("t_at").over(order), F.lit(False))
    parted = chained.withColumn("again", again.cast("int")).withColumn("part", F.sum("again").over(order))
    merged = gathered(hit, "diagonal").unionByName(gathered(chained, "chain")).unionByName(gathered(parted, "chain", "part"))
    size = F.least(F.col("t_words"), F.lit(K))
    covered = F.size(F.array_distinct(F.flatten(F.transform("t", lambda p: F.sequence(p, p + size - 1)))))
    score = covered / F.col("t_words")
    return merged.join(sizes, "template") \
        .withColumn("score", score).filter((F.col("score") >= COVERED)
                                           & (F.col("hi") + size - F.col("lo") <= LONGER * F.col("t_words")))


def scan(docs):
    """Per document: n_words, base places and labels, all labels, score of the best span."""
    keyed = docs.select("doc_id", "text", F.struct("doc_id", F.xxhash64("text").alias("text_hash")).alias("doc"))
    found = hits(keyed.select("doc", "text")).distinct()
    found = materialize(found, "license-hits")
    templates = template_rows(docs.sparkSession)
    real = found.filter(F.col("template") != LENGTH)
    base = real.join(templates.filter("base").select("template", "label"), "template") \
        .groupBy("doc").agg(F.count(F.lit(1)).alias("n_base"), F.min("at").alias("first"), F.max("at").alias("last"),
                            F.collect_set("label").alias("base_set"))
    more = spans(real, templates).groupBy("doc").agg(F.collect_set("label").alias("set"), F.max("score").alias("best"))
    lengths = found.filter(F.col("template") == LENGTH).select("doc", F.col("at").cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    labels = F.array_sort(F.array_union(F.coalesce("base_set", none), F.coalesce("set", none)))
    whole = lengths.join(base, "doc", "left").join(more, "doc", "left")
    return keyed.select("doc_id", "doc").join(whole, "doc").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        F.col("first").cast("long").alias("first_word"), F.col("last").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.coalesce("base_set", none)), ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"), F.least(F.lit(1.0), F.coalesce("best", F.lit(0.0))).alias("score"))


@query("op10_license_diagonals")
def op10(spark, sf):
    return scan(table(spark, sf, "documents"))
