"""License scan by diagonal voting, with DataFrame functions only.

Every run of K words of every text (two words for templates of two words, else three) is joined
to the places of the same words in the templates. A hit at word ``p`` of a text and place ``t`` of
a template votes for the diagonal ``p - t``, the word at which that template would begin. Votes
are summed by (row, template, diagonal); a diagonal that holds all of a template's runs is a place
where its words stand consecutively. Neighbouring diagonals, as words put in or left out make
them, are merged, and a merged span is verified: enough of the template's runs, each found word by
word, within a length that fits the template.

The template table is a parameter of at most a few hundred runs, so it goes out as a broadcast;
the texts' words never shuffle, only hits do, by row, and each task sums its own first. A row is
told by a number given before the hits are written, so equal or null ids do not mix.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.llm.common import keep

#: Words: runs of digits, letters a to z (A to Z lower-cased) and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Template:
    """``base`` templates count as they stand; others may also match in part, up to ``MOST`` words."""

    label: str
    text: str
    base: bool = False


#: Fixed values of the contract.
BASE = (
    Template("cc-by", "cc by", True),
    Template("gpl", "general public license", True),
    Template("reserved", "all rights reserved", True),
)
#: Openings of well-known notices and the usual one-line statements.
NOTICES = (
    Template("agpl", "gnu affero general public license"),
    Template("apache-2.0", "licensed under the apache license version 2 0"),
    Template("apache-2.0", "you may not use this file except in compliance with the license"),
    Template("artistic", "licensed under the artistic license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("bsd", "released under the bsd license"),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    Template("cc-by-sa", "licensed under cc by sa 4 0"),
    Template("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights"),
    Template("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    Template("gpl-3.0", "licensed under the gnu general public license version 3"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("lgpl", "gnu lesser general public license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    Template("mit", "released under the mit license"),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
)
TEMPLATES = BASE + NOTICES

#: Words of a template at most: its places fit the bits of a long.
MOST = 62
#: Share of a template's runs that a span must hold, and its length at most, in template lengths.
SHARE, STRETCH = 0.6, 2.0


def words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _runs(w: Column) -> Column:
    """Structs (a, b, c) of each word and the two after it; null beyond the end."""
    n = F.greatest(F.size(w), F.lit(0))
    return F.arrays_zip(w.alias("a"), F.slice(w, 2, n).alias("b"), F.slice(w, 3, n).alias("c"))


def _grams(spark: SparkSession, templates: tuple[Template, ...]) -> tuple[DataFrame, DataFrame]:
    """Templates (tid, label, base, size, runs) and their runs grouped by words, for the join."""
    for t in templates:
        n = len(re.findall(WORD, t.text.lower()))
        if not 2 <= n <= MOST:
            raise ValueError(f"template {t.text!r}: {n} words; 2 to {MOST} are possible")
    literal = F.array(*[F.struct(F.lit(i).alias("tid"), F.lit(t.label).alias("label"), F.lit(t.text).alias("text"), F.lit(t.base).alias("base")) for i, t in enumerate(templates)])
    table = (spark.range(1).select(F.inline(literal)).withColumn("w", words(F.col("text"))).withColumn("size", F.size("w"))
             .withColumn("k", F.least(F.col("size"), F.lit(3))).withColumn("runs", F.col("size") - F.col("k") + 1))
    grams = (table.select("tid", "label", "base", "size", "k", "runs", F.posexplode(_runs(F.col("w"))).alias("place", "g")).where(F.col("place") < F.col("runs"))
             .withColumn("third", F.when(F.col("k") == 3, F.col("g.c")))
             .groupBy("k", F.col("g.a").alias("first"), F.col("g.b").alias("second"), "third")
             .agg(F.collect_list(F.struct("tid", "label", "base", "size", "runs", "place")).alias("at"))
             .withColumn("hash", F.xxhash64("first", "second", F.coalesce("third", F.lit("")))))
    return table, grams


def hits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Votes as they fall, written to the shared folder.

    One row for each (row, id, n_words, template, diagonal, place) hit, and at least one for each
    row of ``docs`` (with null template columns). Null and empty texts have no words. Repeated
    rows and equal or null ids stay apart; other columns of ``docs`` play no part.
    """
    _, grams = _grams(docs.sparkSession, templates)
    rows = (docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), words(F.col(text_col)).alias("w"))
            .select("row", "id", F.size("w").cast("long").alias("n_words"), F.posexplode_outer(_runs(F.col("w"))).alias("pos", "g"))
            .select("row", "id", "n_words", "pos", F.col("g.a").alias("w0"), F.col("g.b").alias("w1"), F.col("g.c").alias("w2"))
            .withColumn("h3", F.xxhash64("w0", "w1", "w2")).withColumn("h2", F.xxhash64("w0", "w1", F.lit(""))))
    three = grams.where("k = 3").select(F.col("hash").alias("t3"), F.col("first").alias("f3"), F.col("second").alias("s3"), F.col("third").alias("d3"), F.col("at").alias("at3"))
    two = grams.where("k = 2").select(F.col("hash").alias("t2"), F.col("first").alias("f2"), F.col("second").alias("s2"), F.col("at").alias("at2"))
    met = (rows.join(F.broadcast(three), (F.col("h3") == F.col("t3")) & (F.col("w0") == F.col("f3")) & (F.col("w1") == F.col("s3")) & (F.col("w2") == F.col("d3")), "left")
           .join(F.broadcast(two), (F.col("h2") == F.col("t2")) & (F.col("w0") == F.col("f2")) & (F.col("w1") == F.col("s2")), "left")
           .where(F.col("at3").isNotNull() | F.col("at2").isNotNull() | F.coalesce(F.col("pos") == 0, F.lit(True))))
    none = F.array().cast(grams.schema["at"].dataType)
    at = met.select("row", "id", "n_words", "pos", F.explode_outer(F.concat(F.coalesce("at3", none), F.coalesce("at2", none))).alias("t"))
    return keep(at.select("row", "id", "n_words", F.col("t.tid").alias("tid"), F.col("t.label").alias("label"), F.col("t.base").alias("base"), F.col("t.size").alias("size"),
                          F.col("t.runs").alias("runs"), (F.col("pos") - F.col("t.place")).cast("long").alias("diagonal"), F.col("t.place").alias("place")), "license-hits")


def diagonals(found: DataFrame) -> DataFrame:
    """(row, tid, ..., diagonal, votes, places): how many of the template's runs stand on each diagonal."""
    return (found.where(F.col("tid").isNotNull()).groupBy("row", "tid", "label", "base", "size", "runs", "diagonal")
            .agg(F.count("*").alias("votes"), F.bit_or(F.expr("shiftleft(1L, place)")).alias("places"), F.min("place").alias("low"), F.max("place").alias("high")))


def spans(voted: DataFrame, share: float = SHARE, stretch: float = STRETCH) -> DataFrame:
    """Verified spans (row, tid, label, base, first_word, last_word, share).

    Diagonals of one row and template merge while each lies within a quarter of the template's
    words of the one before. A base template is a span only where it stands whole.
    """
    w = Window.partitionBy("row", "tid").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(w)) > F.floor(F.col("size") / 4)
    merged = (voted.where((~F.col("base")) | (F.col("votes") == F.col("runs")))
              .withColumn("opens", F.coalesce(apart, F.lit(True)).cast("long")).withColumn("group", F.sum("opens").over(w))
              .groupBy("row", "tid", "label", "base", "size", "runs", "group")
              .agg(F.bit_count(F.bit_or("places")).alias("held"), F.max("votes").alias("best"),
                   F.min(F.col("diagonal") + F.col("low")).alias("first_word"), F.max(F.col("diagonal") + F.col("high") + F.least(F.col("size"), F.lit(3)) - 1).alias("last_word")))
    length = F.col("last_word") - F.col("first_word") + 1
    fits = ((F.col("held") >= share * F.col("runs")) & (length <= stretch * F.col("size"))) | (F.col("best") >= share * F.col("runs"))
    return merged.where(fits).select("row", "tid", "label", "base", "first_word", "last_word", (F.col("held") / F.col("runs")).cast("double").alias("share"))


def _joined(labels: Column) -> Column:
    return F.array_join(F.sort_array(labels), ",")


def digest(found: DataFrame) -> DataFrame:
    """One row for each row of the documents: base places, labels and score.

    ``score`` is the largest share of a template that a verified span of the row holds, 0 without
    one. ``first_word`` and ``last_word`` are the starts of the first and last base place, else
    null; without labels the label columns are empty strings.
    """
    voted = diagonals(found)
    places = voted.where(F.col("base") & (F.col("votes") == F.col("runs"))).select(
        "row", F.lit(1).cast("long").alias("place"), F.col("diagonal").alias("start"), F.col("label").alias("base_label"), "label", F.lit(1.0).alias("share"))
    method = spans(voted.where(~F.col("base"))).select("row", "label", "share")
    every = (found.groupBy("row").agg(F.max("id").alias("id"), F.max("n_words").alias("n_words"))
             .unionByName(places, allowMissingColumns=True).unionByName(method, allowMissingColumns=True))
    return (every.groupBy("row").agg(F.max("id").alias("doc_id"), F.max("n_words").alias("n_words"), F.count("place").alias("n_base"),
                                     F.min("start").alias("first_word"), F.max("start").alias("last_word"),
                                     _joined(F.collect_set("base_label")).alias("base_labels"), _joined(F.collect_set("label")).alias("labels"),
                                     F.coalesce(F.max("share"), F.lit(0.0)).alias("score")).drop("row"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """All verified spans of whole texts: id, label, base, first_word, last_word (inclusive), share."""
    found = hits(docs, id_col, text_col, templates)
    ids = found.groupBy("row").agg(F.max("id").alias(id_col))
    return spans(diagonals(found)).join(ids, "row").select(id_col, "label", "base", "first_word", "last_word", "share")
