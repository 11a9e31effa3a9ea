"""License scan by diagonal voting.

Every pair of consecutive words of a text is joined to the places of the same
pair in the templates. A hit votes for the diagonal (place in the text minus
place in the template). A diagonal that holds every pair of a short phrase is
an exact occurrence. For long templates, neighbouring diagonals are merged, so
that inserted or lost words do not end a match, and the merged span is
verified by how much of the template it holds and how long it is.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import whole_text

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Opening passages of well-known licences (public texts, fixed values).
PASSAGES = {
    "mit_text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software without restriction""",
    "apache_text": """Unless required by applicable law or agreed to in writing, software distributed under the
        License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND""",
    "gpl_text": """This program is free software: you can redistribute it and/or modify it under the terms of the
        GNU General Public License as published by the Free Software Foundation""",
    "bsd_text": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met""",
}

MERGE = 3  # diagonals this near are one match
COVER = 0.6  # share of a template's pairs that a match must hold
STRETCH = 1.5  # longest span of a match, in lengths of its template


def templates(spark: SparkSession) -> DataFrame:
    """(template, label, exact, pairs, place, pair): one row per word pair of a template."""
    rows = []
    texts = [(text, label, True) for text, label in PHRASES.items()]
    texts += [(text, label, False) for label, text in PASSAGES.items()]
    for number, (text, label, exact) in enumerate(texts):
        words = re.findall(WORD, text.lower())
        pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
        rows += [(number, label, exact, len(pairs), i, p) for i, p in enumerate(pairs)]
    return spark.createDataFrame(rows, "template int, label string, exact boolean, pairs int, place int, pair string").withColumn(
        "hash", F.xxhash64("pair")
    )


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_words, n_base, first_word,
    last_word, base_labels, labels, score.

    Null texts count as empty: no words, no labels, score 0. Repeated rows
    give repeated results. ``score`` is 1 for an exact phrase, else the
    largest covered share of a passage, 0 when none passed.

    The templates are a fixed table of a few hundred rows, so broadcasting
    them is bounded. Rows of text never move: only hits are shuffled, one row
    per document, template and diagonal. Hits on one pair are compared as
    text too, so a hash collision cannot vote.
    """
    spark = docs.sparkSession
    spec = templates(spark)
    lowered = F.translate(whole_text(), UPPER, LOWER)
    words = docs.select("doc_id", F.md5(whole_text()).alias("text_key"), F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0)).alias("words"))
    # The last pair lacks its second word and is null.
    pairs = F.zip_with("words", F.slice("words", F.lit(2), F.greatest(F.size("words"), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    # The pair at place -1 stands for the row itself.
    exploded = words.select("doc_id", "text_key", F.size("words").alias("n_words"), F.posexplode(F.concat(F.array(F.lit("")), pairs)).alias("at", "pair"))
    marked = spec.select("template", "place", "pair", "hash").unionByName(
        spark.createDataFrame([(-1, 0, "")], "template int, place int, pair string").withColumn("hash", F.xxhash64("pair"))
    )
    hits = exploded.withColumn("hash", F.xxhash64("pair")).join(F.broadcast(marked), ["hash", "pair"]).select(
        "doc_id", "text_key", "n_words", "template", "place", (F.col("at") - 1 - F.col("place")).alias("diagonal")
    )
    row = ["doc_id", "text_key"]
    votes = hits.groupBy(*row, "template", "diagonal").agg(
        F.count("*").alias("votes"), F.collect_set("place").alias("places"), F.max("n_words").alias("n_words")
    )
    info = F.broadcast(spec.groupBy("template").agg(F.first("label").alias("label"), F.first("exact").alias("exact"), F.first("pairs").alias("pairs")))
    votes = votes.join(info, "template", "left")
    # Neighbouring diagonals of a passage get one group; a phrase or the row itself is its own.
    along = Window.partitionBy(*row, "template").orderBy("diagonal")
    new = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > F.when(F.col("exact") | F.col("label").isNull(), 0).otherwise(MERGE), F.lit(True))
    merged = (
        votes.withColumn("new", new.cast("int"))
        .withColumn("group", F.sum("new").over(along))
        .groupBy(*row, "template", "group", "label", "exact", "pairs")
        .agg(
            F.sum("votes").alias("votes"),
            F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("covered"),
            F.min(F.col("diagonal") + F.array_min("places")).alias("start"),
            F.max(F.col("diagonal") + F.array_max("places")).alias("end"),
            F.max("n_words").alias("n_words"),
        )
    )
    exact = F.col("exact") & (F.col("covered") == F.col("pairs"))
    passage = ~F.col("exact") & (F.col("covered") >= COVER * F.col("pairs")) & (F.col("end") - F.col("start") <= STRETCH * F.col("pairs"))
    per_row = merged.groupBy(*row).agg(
        F.max(F.when(F.col("template") == -1, F.col("votes"))).alias("copies"),
        F.max("n_words").cast("bigint").alias("n_words"),
        F.coalesce(F.sum(F.when(exact, F.expr("votes div pairs"))), F.lit(0)).alias("hits"),
        F.min(F.when(exact, F.col("start"))).cast("bigint").alias("first_word"),
        F.max(F.when(exact, F.col("start"))).cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(exact, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(exact | passage, F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(exact, 1.0).when(passage, F.col("covered") / F.col("pairs"))), F.lit(0.0)).alias("score"),
    )
    # Rows that are repeated voted together; each gets its own result.
    return per_row.select(
        "doc_id", "n_words", F.expr("hits div copies").alias("n_base"), "first_word", "last_word", "base_labels", "labels", "score",
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy"),
    ).drop("copy")

