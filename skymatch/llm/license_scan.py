"""License scans by diagonal voting, in DataFrame functions only.

Every document is cut into words, every two neighbouring words are hashed, and the hashes are joined to the
positions of the same word pairs in a fixed table of license phrases and notices; the words themselves are compared with the
template's. A hit at document position p and template position t lies on diagonal p - t. Hits vote for their diagonal, and
each diagonal is merged with the neighbours up to MAX_SHIFT behind it (an inserted or dropped word shifts the diagonal). A
merged span holds those words of its template that stand, with a neighbour, within MAX_SHIFT places of where the span has
them; each counts once. It counts as a notice if these are a share of MIN_COVER of the template's words. Phrases count only if
all their words stand on one diagonal, that is, consecutively.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import ascii_lower

# Phrases that give base labels.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Longer notices in common use; their labels are the method's own.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "licensed under the apache license": "apache",
    "you may not use this file except in compliance with the license": "apache",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis": "apache",
    "this work is licensed under the gnu general public license": "gpl",
    "you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "licensed under cc by nc": "cc-by-nc",
    "licensed under a creative commons attribution noncommercial license": "cc-by-nc",
    "licensed under cc by": "cc-by",
    "licensed under a creative commons attribution license": "cc-by",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "all rights reserved": "all-rights-reserved",
}
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: Share of a notice's words that a merged span must hold: one may lack in 7 words, two in 14, three in 20.
MIN_COVER = 0.85
#: A diagonal is merged with those that lie up to this far behind it.
MAX_SHIFT = 2


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def word_pairs(w: Column) -> Column:
    """Every two neighbouring words and their hash."""
    n = F.greatest(F.size(w) - 1, F.lit(0))
    pair = lambda a, b: F.struct(F.xxhash64(a, b).alias("gram"), a.alias("a"), b.alias("b"))
    return F.zip_with(F.slice(w, F.lit(1), n), F.slice(w, F.lit(2), n), pair)


def template_positions(spark) -> DataFrame:
    """One row per word pair of each template: template, its label, whether it is a base phrase, its words, position, hash, pair."""
    rows = [(t, label, base, phrase.split()) for t, (phrase, label, base) in enumerate([(p, x, True) for p, x in BASE_PHRASES.items()] + [(p, x, False) for p, x in NOTICES.items()])]
    df = spark.createDataFrame(rows, "template int, label string, base boolean, w array<string>")
    return df.select("template", "label", "base", F.size("w").alias("length"), F.posexplode(word_pairs(F.col("w"))).alias("t_pos", "t")).select("*", F.col("t.gram").alias("gram")).drop("w")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Verified license spans of every document, and one row without a span (``template`` null) for each document.

    Returns row (a key of the input row), doc_id, n_words, template, label, base, start, n_covered, cover. Spans of one
    template that begin within MAX_SHIFT of each other are one place, the best of them (of equal ones the first). Of notices that begin at
    the same word, those with most words there are kept ("cc by nc" is no "cc by"). Null text counts as empty; rows that share a
    doc_id, repeated rows too, are scanned each for itself; very long texts only make more rows; other columns of the input are
    ignored, whatever their names; no rows give no rows.
    """
    spark = docs.sparkSession
    cut = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), words(F.col(text_col)).alias("w"))
    # The last element, which no template has, keeps each document in the result without a second scan.
    every = F.concat(word_pairs(F.col("w")), F.array(F.lit(None).cast("struct<gram:bigint,a:string,b:string>")))
    grams = cut.select("row", "doc_id", F.size("w").cast("long").alias("n_words"), F.posexplode(every).alias("pos", "pair")).select("*", F.col("pair.gram").alias("gram"))
    # The template table is a constant of a few hundred rows, so it may be sent to every executor.
    known = template_positions(spark)
    same = (F.col("pair.a") == F.col("t.a")) & (F.col("pair.b") == F.col("t.b"))
    hits = grams.join(F.broadcast(known), "gram", "left").where(same | F.col("gram").isNull())
    hits = hits.select("row", "doc_id", "n_words", "template", "label", "base", "length", "t_pos", "pos", (F.col("pos") - F.col("t_pos")).alias("diagonal"))
    merged = F.when(F.col("base") | F.col("template").isNull(), F.array("diagonal")).otherwise(F.sequence(F.col("diagonal") - MAX_SHIFT, F.col("diagonal")))
    # At most one entry per pair of a template.
    seen = F.collect_set("t_pos")
    spans = (
        hits.withColumn("anchor", F.explode(merged))
        .groupBy("row", "doc_id", "n_words", "template", "label", "base", "length", "anchor")
        .agg(seen.alias("seen"), F.min("pos").alias("first"))
        .withColumn("n_covered", F.size(F.array_union("seen", F.transform("seen", lambda t: t + 1))))
    )
    enough = F.when(F.col("base"), F.col("n_covered") == F.col("length")).otherwise(F.col("n_covered") >= MIN_COVER * F.col("length"))
    found = spans.where(F.col("template").isNull() | enough)
    by = W.partitionBy("row", "template").orderBy("anchor")
    last = F.lag("anchor").over(by)
    begins = F.when(F.col("base") | last.isNull() | (F.col("anchor") - last > MAX_SHIFT), 1).otherwise(0)
    places = (
        found.withColumn("begins", begins)
        .withColumn("place", F.sum("begins").over(by.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy("row", "doc_id", "n_words", "template", "label", "base", "length", "place")
        .agg(F.max(F.struct("n_covered", (-F.col("anchor")).alias("early"), F.col("first").cast("long").alias("start"))).alias("best"))
        .select("row", "doc_id", "n_words", "template", "label", "base", F.when(F.col("template").isNotNull(), F.col("best.start")).alias("start"), "best.n_covered", (F.col("best.n_covered") / F.col("length")).alias("cover"))
    )
    most = F.max(F.when(~F.col("base"), F.col("n_covered"))).over(W.partitionBy("row", "start"))
    return places.withColumn("most", most).where(F.col("template").isNull() | F.col("base") | (F.col("n_covered") == F.col("most"))).drop("most")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts, first and last place of base phrases, labels, and the best cover as score.

    Nulls, empty and very long texts, repeated rows, clashing names and empty tables are as in :func:`scan`; with nothing found the labels are empty and the score is 0.
    """
    base = F.col("base")
    labels = lambda which: F.array_join(F.array_sort(F.collect_set(which)), ",")
    return (
        scan(docs, id_col, text_col)
        .groupBy("row", "doc_id", "n_words")
        .agg(
            F.count(F.when(base, 1)).alias("n_base"),
            F.min(F.when(base, F.col("start"))).alias("first_word"),
            F.max(F.when(base, F.col("start"))).alias("last_word"),
            labels(F.when(base, F.col("label"))).alias("base_labels"),
            labels(F.col("label")).alias("labels"),
            F.coalesce(F.max("cover"), F.lit(0.0)).alias("score"),
        )
        .drop("row")
    )
