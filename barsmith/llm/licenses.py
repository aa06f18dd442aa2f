"""License scans by diagonal voting, with DataFrame functions only.

Every run of k words of a document is joined by hash with the positions of the same run in license
templates. A hit votes for a diagonal: word number in the document minus word number in the template.
Votes are counted per diagonal, neighbouring diagonals (a few words were added or left out) are
merged, and a merged span is accepted if it covers enough of the template within a length that fits.
A phrase of a few words must stand whole on one diagonal.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases that must stand whole, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Opening sentences of well-known licenses, and their labels.
TEXTS = {
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
    "public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
    "the license": "apache",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met": "bsd",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl",
}


@dataclass(frozen=True)
class Settings:
    k: int = 2
    drift: int = 3        # diagonals this close are merged
    cover: float = 0.8    # share of a text's runs that a span must have
    stretch: float = 1.5  # longest span, in lengths of the template
    most_words: int = 20_000  # templates up to this many words are broadcast


def words_of(text: Column) -> Column:
    """Words of digits, letters and everything beyond ASCII, in lower case."""
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), SEPARATORS), "")


def template_runs(spark: SparkSession, phrases: dict[str, str], texts: dict[str, str], settings: Settings) -> DataFrame:
    """template, label, whole (a phrase), runs (their number), place, hash and words of every run."""
    rows = []
    for number, (text, label, whole) in enumerate(
            [(t, v, True) for t, v in phrases.items()] + [(t, v, False) for t, v in texts.items()]):
        words = text.split()
        if len(words) < settings.k:
            raise ValueError(f"a template needs {settings.k} words at least: {text}")
        n = len(words) - settings.k + 1
        for place in range(n):
            rows.append(F.struct(
                F.lit(number).alias("template"), F.lit(label).alias("label"), F.lit(whole).alias("whole"),
                F.lit(n).alias("runs"), F.lit(place).alias("place"),
                F.array(*[F.lit(w) for w in words[place : place + settings.k]]).alias("run")))
    made = spark.range(1).select(F.explode(F.array(*rows)).alias("t")).select("t.*")
    made = made.withColumn("hash", F.xxhash64(*[F.col("run")[i] for i in range(settings.k)]))
    return F.broadcast(made) if len(rows) <= settings.most_words else made


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] | None = None,
         texts: dict[str, str] | None = None, settings: Settings = Settings()) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts the places of phrases, first_word and last_word are the smallest and largest start
    of one (words from 0; null without any). base_labels are the labels of phrases found, labels those
    of accepted spans too; both distinct, sorted, comma-joined. score is the largest share of a
    template that an accepted span covers, 0 without any. A null text counts as empty. Rows that
    repeat id and text repeat the result; other columns are not read.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    source = source.select("doc_id", F.xxhash64("text").alias("mark"), words_of(F.col("text")).alias("words"))
    templates = template_runs(spark, PHRASES if phrases is None else phrases, TEXTS if texts is None else texts, settings)
    parts = [f"w{i}" for i in range(settings.k)]
    runs = source.where(F.size("words") >= settings.k) \
        .select("doc_id", "mark", F.posexplode(F.arrays_zip(
            F.col("words").alias("w0"),
            *[F.slice("words", F.lit(i + 1), F.size("words")).alias(f"w{i}") for i in range(1, settings.k)])).alias("at", "run")) \
        .select("doc_id", "mark", "at", "run.*") \
        .withColumn("hash", F.xxhash64(*parts))
    same_words = [F.col(p) == F.col("run")[i] for i, p in enumerate(parts)]
    hits = runs.join(templates, "hash").where(reduce(and_, same_words)).select(
        "doc_id", "mark", "template", "label", "whole", "runs", "place", "at",
        (F.col("at") - F.col("place")).alias("diagonal"))
    document = ["doc_id", "mark"]
    kind = [*document, "template", "label", "whole", "runs"]
    # Repeated rows vote once: the places of a diagonal are a bit set.
    votes = hits.groupBy(*kind, "diagonal").agg(
        F.collect_set("place").alias("places"), F.min("at").alias("low"), F.max("at").alias("high"))
    base = votes.where(F.col("whole") & (F.size("places") == F.col("runs")))
    base = base.groupBy(*document).agg(
        F.count("*").alias("n_base"), F.min("diagonal").alias("first_word"), F.max("diagonal").alias("last_word"),
        F.collect_set("label").alias("base"))
    line = Window.partitionBy(*document, "template").orderBy("diagonal")
    merged = votes.where("NOT whole") \
        .withColumn("new", F.coalesce(F.col("diagonal") - F.lag("diagonal").over(line) > settings.drift, F.lit(True))) \
        .withColumn("group", F.sum(F.col("new").cast("int")).over(line)) \
        .groupBy(*kind, "group").agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("covered"),
            (F.max("high") - F.min("low") + settings.k).alias("length"))
    share = F.col("covered") / F.col("runs")
    spans = merged.where((share >= settings.cover)
                         & (F.col("length") <= settings.stretch * (F.col("runs") + settings.k - 1))) \
        .groupBy(*document).agg(F.collect_set("label").alias("more"), F.max(share).alias("cover"))
    none = F.array().cast("array<string>")
    spans = spans.select(F.col("doc_id").alias("id"), F.col("mark").alias("m"), "more", "cover")
    found = base.join(spans, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("m")), "full") \
        .select(F.coalesce("doc_id", "id").alias("id"), F.coalesce("mark", "m").alias("m"),
                "n_base", "first_word", "last_word", F.coalesce("base", none).alias("base"),
                F.coalesce("more", none).alias("more"),
                F.greatest(F.when(F.col("n_base") > 0, 1.0), F.col("cover")).alias("score"))
    all_rows = source.select("doc_id", "mark", F.size("words").cast("long").alias("n_words"))

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(labels), ",")

    return all_rows.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("m")), "left") \
        .select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
                F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
                F.coalesce(joined(F.col("base")), F.lit("")).alias("base_labels"),
                F.coalesce(joined(F.array_union("base", "more")), F.lit("")).alias("labels"),
                F.coalesce("score", F.lit(0.0)).alias("score"))
