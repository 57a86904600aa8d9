"""License scans by diagonal voting, with DataFrame functions only.

Texts are read as words. Every run of PAIR words is met, by a rolling hash, with the runs of short phrases, and
every run of RUN words with the runs of longer templates; a match at word p of the text and word q of the template
votes for the diagonal p - q. Words inserted or left out move a match to a diagonal near by, so diagonals up
to GAP apart are merged and cut into spans where votes lie more than a template's length apart. A phrase is
found where a diagonal has all its votes, a template where a span's votes cover SHARE percent of its words.
Each vote's words are compared with the template's, so no result rests on a hash.

Texts are scanned once. The votes, few, are written to the shared folder with one row per text, and all
that follows is one shuffle of them by text.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import scratch_path

PAIR = 2
RUN = 4
GAP = 8
SHARE = 60
# Template runs are broadcast up to this many, and joined as Spark sees fit beyond.
BROADCAST_RUNS = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Phrases and the labels they give.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# Notices of well-known public licenses and the labels they give.
TEMPLATES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
    "files the software to deal in the software without restriction including without limitation the rights to use copy modify "
    "merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is "
    "furnished to do so subject to the following conditions": "mit",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
    "you may obtain a copy of the license at": "apache",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is "
    "basis without warranties or conditions of any kind either express or implied": "apache",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
    "published by the free software foundation either version 3 of the license or at your option any later version": "gpl",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public "
    "license as published by the free software foundation": "lgpl",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
    "conditions are met": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided "
    "that the above copyright notice and this permission notice appear in all copies": "isc",
    "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed "
    "with this file you can obtain one at": "mpl",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa",
    "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile "
    "sell or distribute this software": "unlicense",
    "all rights reserved no part of this publication may be reproduced distributed or transmitted in any form or by any means "
    "without the prior written permission of the publisher": "all-rights-reserved",
}


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, UPPER, LOWER)


def with_runs(df: DataFrame, text: Column) -> DataFrame:
    """Add `w`, the words, and `pairs` and `runs`, the hashes of PAIR and of RUN words from every word on."""

    def rolled(hashes: str, step: int, length: Column) -> Column:
        left, right = (F.slice(hashes, F.lit(start), F.greatest(length, F.lit(0))) for start in (1, 1 + step))
        return F.zip_with(left, right, lambda a, b: F.xxhash64(a, b))

    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), _BETWEEN), "")
    hashed = df.withColumn("w", words).withColumn("h", F.transform("w", lambda word: F.xxhash64(F.lower(word))))
    paired = hashed.withColumn("pairs", rolled("h", 1, F.size("h") - 1)).drop("h")
    return paired.withColumn("runs", rolled("pairs", PAIR, F.size("w") - (RUN - 1)))


def template_runs(spark: SparkSession, phrases: Mapping[str, str], templates: Mapping[str, str]) -> tuple[DataFrame, int]:
    """(template, label, size, n, q, code, run): the runs of all phrases (size PAIR) and templates (size RUN), and their number.

    One more row, of size 0, meets the row that stands for a whole text.
    """
    entries = [(PAIR, text, label) for text, label in phrases.items()] + [(RUN, text, label) for text, label in templates.items()]
    for size, text, _ in entries:
        if len(text.split()) < size:
            raise ValueError(f"phrases need {PAIR} words and templates {RUN}: {text!r}")
    listed = [F.struct(F.lit(at).alias("template"), F.lit(s).alias("size"), F.lit(t).alias("text"), F.lit(b).alias("label")) for at, (s, t, b) in enumerate(entries)]
    one = spark.range(1)
    whole = one.select(
        F.lit(-1).alias("template"), F.lit(None).cast("string").alias("label"), F.lit(0).alias("size"), F.lit(0).alias("n"),
        F.lit(0).alias("q"), F.lit(0).cast("long").alias("code"), F.lit("").alias("run"),
    )
    if not listed:
        return whole, 1
    split = with_runs(one.select(F.explode(F.array(*listed)).alias("e")).select("e.*"), F.col("text"))
    rows = split.select("*", F.posexplode(F.when(F.col("size") == PAIR, F.col("pairs")).otherwise(F.col("runs"))).alias("q", "code"))
    run = lowered(F.concat_ws(" ", F.slice("w", F.col("q") + 1, F.col("size"))))
    return rows.select("template", "label", "size", F.size("w").alias("n"), "q", "code", run.alias("run")).unionByName(whole), sum(len(t.split()) for _, t, _ in entries)


def votes(df: DataFrame, key: str, text: str, phrases: Mapping[str, str], templates: Mapping[str, str]) -> DataFrame:
    """(key, th, n_words, template, label, size, n, q, p), stored: all matches, and a row of size 0 for each row of `df`."""
    spark = df.sparkSession
    docs = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    split = with_runs(docs.withColumn("th", F.xxhash64("text")), F.col("text")).drop("text")
    n_pairs = F.size("pairs")
    whole = F.array(F.lit(0).cast("long"))
    met = split.select("key", "th", "w", n_pairs.alias("n_pairs"), F.posexplode(F.concat(whole, "pairs", "runs")).alias("at", "code"))
    known, runs = template_runs(spark, phrases, templates)
    known = known.withColumnRenamed("code", "known_code")
    known = F.broadcast(known) if runs <= BROADCAST_RUNS else known
    kind = F.when(F.col("at") == 0, 0).when(F.col("at") <= F.col("n_pairs"), PAIR).otherwise(RUN)
    joined = met.join(known, (F.col("code") == F.col("known_code")) & (F.col("size") == kind))
    p = F.when(F.col("size") == 0, 0).when(F.col("size") == PAIR, F.col("at") - 1).otherwise(F.col("at") - 1 - F.col("n_pairs"))
    placed = joined.withColumn("p", p)
    same = (F.col("size") == 0) | (lowered(F.concat_ws(" ", F.slice("w", F.col("p") + 1, F.greatest("size", F.lit(1))))) == F.col("run"))
    path = scratch_path(spark, "licenses")
    placed.where(same).select("key", "th", F.size("w").alias("n_words"), "template", "label", "size", "n", "q", "p").write.parquet(path)
    return spark.read.parquet(path)


def spans_of(found: DataFrame, share: int = SHARE) -> DataFrame:
    """(key, th, label, size, first_word, end_word, share) from votes; a phrase's share is 1."""
    dealt = found.where("size > 0").repartition("key", "th").dropDuplicates(["key", "th", "template", "p", "q"])
    dealt = dealt.withColumn("diagonal", F.col("p") - F.col("q"))
    by = ["key", "th", "template", "label", "size", "n"]
    phrase = dealt.where(F.col("size") == PAIR).groupBy(*by, "diagonal").agg(F.count(F.lit(1)).alias("n_votes"))
    phrase = phrase.where(F.col("n_votes") == F.col("n") - (PAIR - 1))
    phrase = phrase.select(*by[:2], "label", "size", F.col("diagonal").alias("first_word"), (F.col("diagonal") + F.col("n")).alias("end_word"), F.lit(1.0).alias("share"))
    own = Window.partitionBy("key", "th", "template").orderBy("diagonal", "q")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(own) > GAP, F.lit(True))
    merged = dealt.where(F.col("size") == RUN).withColumn("apart", apart.cast("int")).withColumn("band", F.sum("apart").over(own))
    along = Window.partitionBy("key", "th", "template", "band").orderBy("p", "q")
    far = F.coalesce(F.col("p") - F.lag("p").over(along) > F.col("n"), F.lit(True))
    cut = merged.withColumn("far", far.cast("int")).withColumn("part", F.sum("far").over(along))
    spans = cut.groupBy(*by, "band", "part").agg(F.min("p").alias("first_word"), (F.max("p") + RUN).alias("end_word"), F.collect_set("q").alias("at"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("at", lambda q: F.sequence(q, q + (RUN - 1))))))
    spans = spans.withColumn("covered", covered).where(F.col("covered") * 100 >= F.col("n") * share)
    return phrase.unionByName(spans.select(*by[:2], "label", "size", "first_word", "end_word", (F.col("covered") / F.col("n")).alias("share")))


def license_spans(
    df: DataFrame, key: str = "doc_id", text: str = "text", phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, str] = TEMPLATES, share: int = SHARE
) -> DataFrame:
    """(key, th, label, size, first_word, end_word, share) of every phrase (size PAIR) and template (size RUN) found.

    `th` is the hash of the text; equal rows (key and text) give their spans once. Otherwise as `scan_licenses`.
    """
    return spans_of(votes(df, key, text, phrases, templates), share)


def scan_licenses(
    df: DataFrame, key: str = "doc_id", text: str = "text", phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, str] = TEMPLATES, share: int = SHARE
) -> DataFrame:
    """(key, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row of `df`.

    n_base counts the places of phrases, first_word and last_word are the first and last of them (words from 0, NULL if none);
    base_labels are the phrases' labels, labels those of templates too, sorted, with commas. score is the largest share of a
    phrase's or template's words that was found together, 0 if none was.

    NULL and empty texts have no words. Equal rows each get their row; rows that share a key are told apart by their
    texts; NULL keys are kept. A long text is one row, its votes are one task's work. Where places overlap or two templates match, all count.
    An empty table gives no row. Other columns are not read, whatever their names.
    """
    found = votes(df, key, text, phrases, templates)
    whole = found.where("size = 0").groupBy("key", "th").agg(F.first("n_words").alias("n_words"), F.count(F.lit(1)).alias("copies"))
    base = F.col("size") == PAIR

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(labels), ",")

    marked = spans_of(found, share).groupBy("key", "th").agg(
        F.count(F.when(base, F.lit(1))).alias("n_base"),
        F.min(F.when(base, F.col("first_word"))).alias("first_word"),
        F.max(F.when(base, F.col("first_word"))).alias("last_word"),
        joined(F.collect_set(F.when(base, F.col("label")))).alias("base_labels"),
        joined(F.collect_set("label")).alias("labels"),
        F.max("share").alias("score"),
    )
    marked = marked.withColumnsRenamed({"key": "marked_key", "th": "marked_th"})
    same = whole["key"].eqNullSafe(F.col("marked_key")) & whole["th"].eqNullSafe(F.col("marked_th"))
    rows = whole.join(marked, same, "left").select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return rows.select(
        F.col("key").alias(key),
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
