"""License scans by diagonal voting, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


GRAM = 3
#: Diagonals at most this far apart are votes for one place of a template.
SHIFT = 2
#: Share of a template's words that a place must hold, and how much longer than
#: the template it may be.
LEAST_COVER, MOST_STRETCH = 0.8, 1.5

# Phrases whose exact places are reported, with their labels.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
# Notices that are found also when a few words differ.
NOTICES = (
    ("mit", "released under the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction",
    ),
    ("apache-2", "licensed under the apache license version 2 0"),
    (
        "apache-2",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
    ),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    (
        "gpl-3",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published "
        "by the free software foundation either version 3 of the license or at your option any later version",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided "
        "that the following conditions are met",
    ),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)

#: Between words: ASCII but letters and digits. Upper-case letters are lowered word by word.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _gram(first: Column, second: Column, third: Column) -> Column:
    return F.xxhash64(F.lower(first), F.lower(second), F.lower(third))


def _template_grams(spark: SparkSession) -> DataFrame:
    """Every word gram of the templates with its place; a constant of some 150 rows."""
    rows = []
    for number, (label, text, exact) in enumerate(
        [(*x, True) for x in PHRASES] + [(*x, False) for x in NOTICES]
    ):
        words = text.split(" ")
        for at in range(len(words) - GRAM + 1):
            rows.append(
                F.struct(
                    F.lit(number).alias("template"),
                    F.lit(label).alias("label"),
                    F.lit(exact).alias("exact"),
                    F.lit(len(words)).alias("length"),
                    F.lit(at).alias("at"),
                    *[F.lit(w).alias(f"t{i}") for i, w in enumerate(words[at : at + GRAM])],
                )
            )
    exploded = spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return exploded.withColumn("gram", _gram(F.col("t0"), F.col("t1"), F.col("t2")))


def scan_licenses(documents: DataFrame, text: str = "text") -> DataFrame:
    """Every document with the license phrases and notices that its text holds.

    Adds ``n_words``, ``n_base`` (places of the exact phrases), ``first_word`` and
    ``last_word`` (their smallest and largest start, else null), ``base_labels`` and
    ``labels`` (sorted, comma-joined; the second with the notices found), ``places``
    ((label, start, end, cover) of verified notices, in words) and ``score`` (the
    best cover), replacing columns of these names.

    All three-word grams of a text are joined with the templates' by hash, and a
    match is kept if the words are equal. Matches vote for the diagonal, the
    difference of the two positions. A phrase stands where all its grams are on
    one diagonal. For notices, neighbouring diagonals are merged, and the place
    counts if it covers enough of the template in not much more words.

    Only matches are shuffled, with one row for each document, which carries its
    other columns; a document's rows then stay in one task. Work and memory are in
    proportion to the longest text. Null and empty texts
    have no words. Repeated rows each get their result. No rows give no rows.
    """
    ours = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "places", "score")
    base = documents.drop(*[c for c in ours if c != text])
    kept = [c for c in base.columns if c != text]
    row, held = "_row", "_kept"
    split = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), BETWEEN), lambda w: w != "")
    worded = base.select(
        F.monotonically_increasing_id().alias(row),
        F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(kept)], F.lit(0).alias("none")).alias(held),
        split.alias("_words"),
    )
    size = F.size("_words")
    word = F.col("_words")
    # A gram carries its own words, and the marker what belongs to the document, so that
    # what the explode copies doesn't grow with the text.
    marker = F.struct(
        F.lit(-1).alias("pos"),
        F.lit(0).cast("long").alias("gram"),
        F.lit("").alias("said"),
        F.struct(F.col(held), size.cast("long").alias("n_words")).alias("of"),
    )
    none = F.when(F.lit(False), marker["of"])
    grams = F.transform(
        F.when(size >= GRAM, F.sequence(F.lit(0), size - GRAM)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(
            i.alias("pos"),
            _gram(word[i], word[i + 1], word[i + 2]).alias("gram"),
            F.concat_ws(" ", word[i], word[i + 1], word[i + 2]).alias("said"),
            none.alias("of"),
        ),
    )
    exploded = worded.select(row, F.explode(F.concat(F.array(marker), grams)).alias("_g")).select(
        row, "_g.pos", "_g.gram", "_g.said", f"_g.of.{held}", "_g.of.n_words"
    )
    templates = _template_grams(documents.sparkSession)
    markers = templates.limit(1).select(
        F.lit(-1).alias("template"),
        F.lit("").alias("label"),
        F.lit(False).alias("exact"),
        F.lit(0).alias("length"),
        F.lit(0).alias("at"),
        *[F.lit("").alias(f"t{i}") for i in range(GRAM)],
        F.lit(0).cast("long").alias("gram"),
    )
    joined = exploded.join(F.broadcast(templates.union(markers)), "gram")
    marked = F.col("template") < 0
    equal = F.translate("said", _UPPER, _LOWER) == F.concat_ws(" ", *[f"t{i}" for i in range(GRAM)])

    matches = (
        joined.where(F.when(marked, F.col("pos") < 0).otherwise((F.col("pos") >= 0) & equal))
        .select(
            row,
            F.when(marked, F.col(held)).alias(held),
            F.when(marked, F.col("n_words")).alias("n_words"),
            "template",
            "label",
            "exact",
            "length",
            (F.col("pos") - F.col("at")).cast("long").alias("diagonal"),
            "at",
        )
        .repartition(row)
    )
    votes = matches.groupBy(row, "template", "label", "exact", "length", "diagonal").agg(
        F.any_value(held, ignoreNulls=True).alias(held),
        F.max("n_words").alias("n_words"),
        F.collect_list("at").alias("at"),
    )
    whole = F.col("exact") & (F.size("at") == F.col("length") - GRAM + 1)
    ordered = Window.partitionBy(row, "template").orderBy("diagonal")
    merged = (
        votes.withColumn("phrase", whole)
        .withColumn(
            "opens",
            F.coalesce(F.col("diagonal") - F.lag("diagonal").over(ordered) > SHIFT, F.lit(True)).cast("int"),
        )
        .withColumn("place", F.sum("opens").over(ordered))
        .groupBy(row, "template", "label", "exact", "length", "place")
        .agg(
            F.any_value(held, ignoreNulls=True).alias(held),
            F.max("n_words").alias("n_words"),
            F.count_if("phrase").alias("phrases"),
            F.min(F.when(F.col("phrase"), F.col("diagonal"))).alias("first"),
            F.max(F.when(F.col("phrase"), F.col("diagonal"))).alias("last"),
            F.min(F.col("diagonal") + F.array_min("at")).alias("start"),
            F.max(F.col("diagonal") + F.array_max("at") + GRAM).alias("end"),
            F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"),
        )
    )
    covered = F.array_distinct(F.flatten(F.transform("at", lambda a: F.sequence(a, a + GRAM - 1))))
    judged = merged.withColumn("cover", F.when(F.col("length") > 0, F.size(covered) / F.col("length")).otherwise(0.0))
    found = (
        ~F.col("exact")
        & (F.col("length") > 0)
        & (F.col("cover") >= LEAST_COVER)
        & (F.col("end") - F.col("start") <= MOST_STRETCH * F.col("length"))
    )
    phrase_label = F.when(F.col("phrases") > 0, F.col("label"))
    place = F.struct("label", "start", "end", "cover")
    per_row = judged.groupBy(row).agg(
        F.any_value(held, ignoreNulls=True).alias(held),
        F.max("n_words").alias("n_words"),
        F.sum("phrases").alias("n_base"),
        F.min("first").alias("first_word"),
        F.max("last").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(phrase_label)), ",").alias("base_labels"),
        F.array_join(
            F.array_sort(F.collect_set(F.coalesce(phrase_label, F.when(found, F.col("label"))))), ","
        ).alias("labels"),
        F.array_sort(F.collect_list(F.when(found, place))).alias("places"),
        F.coalesce(
            F.max(F.when(F.col("phrases") > 0, 1.0).when(found, F.least(F.col("cover"), F.lit(1.0)))), F.lit(0.0)
        ).alias("score"),
    )
    return per_row.select(
        *[F.col(f"{held}.c{i}").alias(c) for i, c in enumerate(kept)], *ours
    )
