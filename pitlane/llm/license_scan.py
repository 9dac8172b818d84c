"""License scans by diagonal voting, with DataFrame functions only."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: (label, words, whether it is a base phrase). The base phrases, and openings of public licences.
TEMPLATES = (
    ("cc-by", "cc by", True),
    ("gpl", "general public license", True),
    ("reserved", "all rights reserved", True),
    ("apache-2.0", "licensed under the apache license version 2 0", False),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at", False),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", False),
    ("cc-by-nc", "licensed under cc by nc 4 0", False),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", False),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", False),
    ("gpl", "this work is licensed under the gnu general public license version 3", False),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", False),
    ("mit", "released under the mit license", False),
    ("mit", "licensed under the mit license", False),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", False),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", False),
    ("unlicense", "this is free and unencumbered software released into the public domain", False),
)
#: Words in a rolling gram: 2 for base phrases, GRAM for longer templates.
GRAM = 3
#: Diagonals at most this far apart belong to one span (words put in or left out).
NEAR = 3
#: Part of a template's grams that must stand in a span for its label.
COVER = 0.6

_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text):
    """Words of a text column: A-Z lower-cased, runs of a-z, 0-9 and non-ASCII characters.

    `lower` also lowers letters beyond ASCII; that moves no word boundary, and no template word holds such a letter."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _BREAKS), lambda x: x != "")


def _positions(spark: SparkSession, templates) -> DataFrame:
    """One row for each template gram: its words, place, and the template's data; one row with no words that every document meets."""
    rows = [(-1, "", False, 0, 0, 0, [])]
    for t, (label, words, base) in enumerate(templates):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", words)
        k = min(len(words), 2 if base else GRAM)
        rows += [(t, label, base, len(words) - k + 1, k, at, words[at: at + k]) for at in range(len(words) - k + 1)]
    df = spark.createDataFrame(rows, "tid int, label string, base boolean, grams int, k int, tpos int, gram array<string>")
    return df.withColumn("h", F.when(F.col("k") == 0, F.lit(0).cast("long")).when(F.col("k") == 2, F.xxhash64(F.get("gram", F.lit(0)), F.get("gram", F.lit(1))))
                         .otherwise(F.xxhash64(*[F.get("gram", F.lit(j)) for j in range(GRAM)])))


def license_spans(docs: DataFrame, id_col: str, text_col: str, templates=TEMPLATES) -> DataFrame:
    """Spans of licence templates in whole texts: (row, id, n_words, label, base, start, end, cover).

    All rolling word grams of every document are joined to the grams' places in
    the templates; matches are counted by diagonal (place in the document minus
    place in the template), neighbouring diagonals merge into one span, and a
    span is kept when its grams, compared word by word and not by hash alone,
    cover enough of the template. A base phrase needs all its grams on one
    diagonal. Every document has one further row without a label, so documents
    without spans, with empty or null text, stay. Rows are told apart by `row`,
    not by their id, so repeated and null ids are kept; other columns are ignored.

    The template side is a constant of a few hundred rows and is broadcast; the
    documents' grams are probed where they are read and only matches move, by
    document, so neither a hot source nor a common phrase gathers in a task."""
    t = _positions(docs.sparkSession, templates)
    d = docs.select(F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("w")).withColumn("row", F.monotonically_increasing_id())
    d = d.withColumn("n_words", F.size("w").cast("long"))
    n = F.size("w")
    grams = lambda k: F.when(n >= k, F.transform(F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(*[F.get("w", i + j) for j in range(k)]))).otherwise(F.array().cast("array<bigint>"))
    d = d.withColumn("hs", F.concat(F.array(F.lit(0).cast("long")), grams(2), grams(GRAM)))
    d = d.select("row", "id", "n_words", "w", F.posexplode("hs").alias("at", "h"))
    two = F.greatest(F.col("n_words") - 1, F.lit(0))
    hit = d.join(F.broadcast(t), "h")
    hit = hit.withColumn("dpos", F.when(F.col("at") <= two, F.col("at") - 1).otherwise(F.col("at") - 1 - two))
    kept = F.when(F.col("k") == 0, F.col("at") == 0).otherwise(
        (F.col("k") == F.when(F.col("at") <= two, 2).otherwise(GRAM)) & (F.slice("w", F.greatest(F.col("dpos") + 1, F.lit(1)).cast("int"), F.greatest("k", F.lit(1))) == F.col("gram")))
    hit = hit.where(kept).select("row", "id", "n_words", "tid", "label", "base", "grams", "tpos", "k", "dpos", (F.col("dpos") - F.col("tpos")).alias("diag"))
    doc = ["row", "id", "n_words", "tid", "label", "base", "grams"]
    diags = (hit.repartition("row").groupBy(*doc, "diag")
             .agg(F.count("*").alias("votes"), F.min("dpos").alias("start"), F.max(F.col("dpos") + F.col("k")).alias("end")))
    along = W.partitionBy("row", "tid").orderBy("diag")
    gap = F.col("diag") - F.lag("diag").over(along)
    diags = diags.withColumn("new", F.when(F.col("base") | gap.isNull() | (gap > NEAR), 1).otherwise(0))
    diags = diags.withColumn("span", F.sum("new").over(along))
    spans = diags.groupBy(*doc, "span").agg(F.sum("votes").alias("votes"), F.min("start").alias("start"), F.max("end").alias("end"))
    cover = F.when(F.col("tid") >= 0, F.least(F.lit(1.0), F.col("votes") / F.col("grams")))
    spans = spans.withColumn("cover", cover)
    enough = F.when(F.col("base"), F.col("votes") == F.col("grams")).otherwise((F.col("cover") >= COVER) & (F.col("end") - F.col("start") <= 2 * (F.col("grams") + GRAM)))
    spans = spans.where((F.col("tid") < 0) | enough)
    none = F.col("tid") < 0
    return spans.select("row", "id", "n_words", *[F.when(~none, F.col(c)).alias(c) for c in ("label", "base", "start", "end", "cover")])


def license_digest(spans: DataFrame, id_name: str = "doc_id") -> DataFrame:
    """The contract's row for each document from `license_spans`."""
    base = F.col("base") & F.col("label").isNotNull()
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return (spans.groupBy("row").agg(
        F.first("id").alias(id_name), F.max("n_words").alias("n_words"),
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"), F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"), joined("label").alias("labels"),
        F.coalesce(F.max("cover"), F.lit(0.0)).alias("score")).drop("row"))
