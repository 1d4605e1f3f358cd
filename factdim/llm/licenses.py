"""License scan by diagonal voting, in DataFrame expressions only.

Every rolling word k-gram of a text is hashed and joined to the positions of the same k-gram in a small
set of templates.  A hit votes for the diagonal text position - template position.  The votes of a
diagonal, merged with those of neighbouring diagonals (which differ by inserted or missing words), tell
how much of the template stands there.  Hits are verified word by word, so hash collisions do not count.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factdim.llm.common import text_or_empty

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    """Words of a license text or phrase; a phrase counts only whole and in one piece."""

    label: str
    words: str
    phrase: bool = False


# The phrases and their labels.
PHRASES = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
)

#: Openings of common license texts.
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Template("apache", "licensed under the apache license version 2 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license"),
    Template("cc-by", "this work is licensed under a creative commons attribution license"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
)


def template_grams(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """A row per k-gram of each template: template, at, words, size (k-grams of the template), label, phrase."""
    rows = []
    for t, template in enumerate(templates):
        words = template.words.split()
        grams = [words[i : i + GRAM] for i in range(len(words) - GRAM + 1)]
        for i, gram in enumerate(grams):
            row = {"template": t, "at": i, "size": len(grams), "label": template.label, "phrase": template.phrase}
            named = [F.lit(v).alias(k) for k, v in row.items()]
            rows.append(F.struct(*named, F.array(*map(F.lit, gram)).alias("words")))
    return spark.range(1).select(F.inline(F.array(*rows))).withColumn("hash", gram_hash(F.col("words"), F.lit(0)))


def gram_hash(words: Column, at: Column) -> Column:
    return F.xxhash64(*[F.get(words, at + i) for i in range(GRAM)])


def license_labels(
    docs: DataFrame,
    templates: tuple[Template, ...] = NOTICES,
    min_score: float = 0.7,
    drift: int = 3,
) -> DataFrame:
    """Licenses named or quoted in each text.

    Returns doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.  A-Z are
    lowered; words are runs of ASCII letters, digits and non-ASCII characters.  n_base counts the places of
    the phrases in ``PHRASES``; first_word and last_word are their smallest and largest start (null if there
    is none), base_labels their labels.  labels adds those of ``templates`` of which at least ``min_score``
    of the k-grams lie on diagonals that neighbours no more than ``drift`` words apart join.  score is the
    largest such part, 1 for a phrase, 0 without a hit.

    A null or empty text has no words and no labels (empty strings).  Every row gives a row; rows that share
    a doc_id and text (null is an id too) have equal results.  Other columns are ignored; an empty table
    gives no rows.
    """
    spark = docs.sparkSession
    grams = template_grams(spark, (*PHRASES, *templates)).withColumnRenamed("words", "gram")
    words = F.regexp_extract_all(F.translate(text_or_empty(), UPPER, LOWER), F.lit(WORD), F.lit(0))
    # every k-gram is hashed and looked up; those found leave with their own words, the others stay behind
    known = [r[0] for r in grams.select("hash").distinct().collect()]  # as many as the templates have
    places = F.filter(
        F.transform("words", lambda _, i: i), lambda i: gram_hash(F.col("words"), i).isin(known)
    )
    hits = F.transform(places, lambda i: F.struct(
        i.alias("place"), gram_hash(F.col("words"), i).alias("key"), F.slice("words", i + 1, GRAM).alias("found")
    ))
    # a row without a place carries the document itself through the same pass
    itself = F.array(F.lit(None).cast("struct<place: int, key: bigint, found: array<string>>"))
    same = (F.col("hit.key") == F.col("hash")) & (F.col("hit.found") == F.col("gram"))  # verified word by word
    votes = (
        docs.select("doc_id", F.xxhash64(text_or_empty()).alias("mark"), words.alias("words"))
        .select("doc_id", "mark", F.size("words").cast("long").alias("n_words"), F.explode(F.concat(itself, hits)).alias("hit"))
        .join(F.broadcast(grams), same, "left")
        .where(F.col("hit").isNull() | F.col("template").isNotNull())
        .select(
            "doc_id", "mark", "template", "label", "phrase", "size", "at",
            (F.col("hit.place") - F.col("at")).cast("long").alias("diagonal"),
            F.when(F.col("hit").isNull(), F.col("n_words")).alias("n_words"),
        )
    )
    diagonals = votes.groupBy("doc_id", "mark", "template", "label", "phrase", "size", "diagonal").agg(
        F.count_distinct("at").alias("n"), F.max("n_words").alias("n_words"), F.count("n_words").alias("copies")
    )
    in_order = Window.partitionBy("doc_id", "mark", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(in_order) > drift, F.lit(True)) | F.col("phrase")
    spans = (
        diagonals.withColumn("span", F.sum(apart.cast("int")).over(in_order))
        .groupBy("doc_id", "mark", "template", "label", "phrase", "size", "span")
        .agg(
            F.least(F.lit(1.0), F.sum("n") / F.col("size")).alias("part"),
            F.min("diagonal").alias("start"),
            F.max("n_words").alias("n_words"),
            F.max("copies").alias("copies"),
        )
    )
    whole = F.col("phrase") & (F.col("part") == 1)
    found = whole | (~F.col("phrase") & (F.col("part") >= min_score))
    names = lambda which: F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")
    return (
        spans.groupBy("doc_id", "mark")
        .agg(
            F.max("n_words").alias("n_words"),
            F.count(F.when(whole, 1)).alias("n_base"),
            F.min(F.when(whole, F.col("start"))).alias("first_word"),
            F.max(F.when(whole, F.col("start"))).alias("last_word"),
            names(whole).alias("base_labels"),
            names(found).alias("labels"),
            F.coalesce(F.max(F.when(whole | ~F.col("phrase"), F.col("part"))), F.lit(0.0)).alias("score"),
            F.max("copies").alias("_copies"),
        )
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
        .drop("mark", "_copies", "_copy")
    )
