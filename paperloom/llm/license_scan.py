"""License scan: exact containment join of text blocks with license templates.

Blocks are the lines of a text and, with ``across``, overlapping runs of words over
the whole text, so that a notice wrapped over lines lies within one. Template words are put in one global order, rarest
first by the number of documents that hold them. A block that contains at least
``c`` of a template's ``m`` distinct words must hold one of its ``m - c + 1`` rarest
(prefix filter) and must have ``c`` distinct words at all (length filter). A block's
words stand in the same order: a meeting of its ``j``-th of ``n`` with the template's
``i``-th, taken as the first that they share, can lead to ``min(n - j, m - i)`` shared
words at most, and goes if that is below ``c`` (positional filter). Blocks and templates meet by a join on those prefix words;
what passes is counted exactly. The templates are fixed, so what they broadcast is
bounded by their text. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.graph import written
from paperloom.llm.url_templates import lower_ascii

#: Fixed phrases and their labels: a place where the words stand in a row counts.
PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]

#: Templates of the set-similarity join: the customary notice of each license.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-2", "redistribute it and or modify it under the terms of the gnu general public license version 2"),
    ("lgpl-3", "this work is licensed under the gnu lesser general public license version 3"),
    ("bsd-3", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc0", "this work is dedicated to the public domain under cc0 1 0 universal"),
    ("rights-reserved", "all rights reserved no part may be reproduced without permission"),
]
#: Share of a template's distinct words that a block must hold, in percent.
CONTAINMENT = 90

#: Characters between words: ASCII except digits and small letters, after lower-casing.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def needed(m: int, percent: int) -> int:
    return -(-percent * m // 100)


def candidates(blocks: DataFrame, order: list[str], prefix: DataFrame, whole: DataFrame) -> DataFrame:
    """Meetings of blocks (``uid, id, block, words``) with the prefixes of templates that may reach the threshold.

    ``order`` lists the vocabulary, rarest first; ``prefix`` has ``t, word, i`` and
    ``whole`` ``t, m, c`` and more per template, both as small as the templates are.
    """
    ranked = blocks.withColumn("words", F.array_intersect(F.array(*map(F.lit, order)), "words"))
    entry = ranked.select("uid", "id", "block", "words", F.posexplode("words").alias("j", "word"))
    met = entry.join(F.broadcast(prefix), "word").join(F.broadcast(whole), "t")
    return met.where(F.least(F.size("words") - F.col("j"), F.col("m") - F.col("i")) >= F.col("c"))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, templates=TEMPLATES, percent: int = CONTAINMENT, across: bool = False) -> tuple[DataFrame, DataFrame]:
    """Two tables: per row its scan, and every block that meets a template.

    The first has ``id, n_words, n_base, first_word, last_word, base_labels,
    labels, score``; ``score`` is the largest containment found, 1 for a phrase, 0
    for none. The second has ``id, block`` (line from 0, with its row's ``uid``),
    ``label, containment``. With ``across`` the runs of texts of several lines are
    blocks too, numbered down from -1: twice as many words as the longest template,
    each half a run after the one before. Null and empty texts have no words, places or blocks.
    Each row is scanned by itself, so null and repeated ids come back as they are.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("id", lower_ascii(F.col("text")).alias("text"))
    sets = [(label, sorted(set(t.split(" ")))) for label, t in templates]
    vocabulary = sorted({w for _, ws in sets for w in ws})
    flat = F.trim(F.regexp_replace("text", BETWEEN, " "))
    body = rows.select("id", "text", flat.alias("flat")).select("id", "text", "flat", F.concat(F.lit(" "), F.col("flat"), F.lit(" ")).alias("spaced"))
    n_words = F.when(F.col("flat") == "", 0).otherwise(F.length("spaced") - F.length(F.replace("spaced", F.lit(" "))) - 1).cast("long")
    # Places of a phrase, their number, first and last word index: blanks before the first and after the last one.
    blanks = lambda c: (F.length(c) - F.length(F.replace(c, F.lit(" ")))).cast("long")
    places = []
    for phrase, _ in phrases:
        size = len(phrase.split(" "))
        found = F.split("spaced", f" {phrase}(?= )")
        first, last = blanks(F.element_at(found, 1)), F.col("n_words") - (blanks(F.element_at(found, -1)) - 1) - size
        spot = F.struct((F.size(found) - 1).cast("long").alias("n"), first.alias("first"), last.alias("last"))
        places.append(F.when(F.contains("spaced", F.lit(f" {phrase} ")), spot))
    names = [label for _, label in phrases]
    body = body.select("id", "text", "spaced", n_words.alias("n_words"))
    scanned = body.select("id", "text", "n_words", F.array(*places).alias("places"))
    # Of a line only template words matter; lines with fewer than the least threshold meet none.
    held_words = lambda ws: F.array_intersect(F.array_distinct(ws), F.array(*map(F.lit, vocabulary))).alias("words")
    lines = F.transform(F.split("text", "\n"), lambda line, i: F.struct(i.alias("block"), held_words(F.split(F.regexp_replace(line, BETWEEN, " "), " "))))
    if across:
        half = max(len(t.split(" ")) for _, t in templates)
        scanned = scanned.withColumn("run_words", F.when(F.contains("text", F.lit("\n")), F.split(F.trim(F.regexp_replace("text", BETWEEN, " ")), " ")).otherwise(F.array().cast("array<string>")))
        starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil((F.size("run_words") - half) / F.lit(half)).cast("int") - 1))
        lines = F.concat(lines, F.transform(starts, lambda i: F.struct((-1 - i).alias("block"), held_words(F.slice("run_words", i * half + 1, F.lit(2 * half))))))
    least = min(needed(len(ws), percent) for _, ws in sets)
    held = scanned.select("id", "n_words", "places", F.filter(lines, lambda b: F.size(b["words"]) >= least).alias("blocks"))
    held = written(held.withColumn("uid", F.monotonically_increasing_id()), "license-blocks")
    blocks = held.select("uid", "id", F.explode("blocks").alias("b")).select("uid", "id", "b.block", "b.words")
    # Documents per template word: the global order; at most one row per word of the vocabulary.
    seen = held.select("uid", F.explode(F.array_distinct(F.flatten("blocks.words"))).alias("word")).groupBy("word").count().collect()
    times = {r["word"]: r["count"] for r in seen}
    order = sorted(vocabulary, key=lambda w: (times.get(w, 0), w))
    place = {w: i for i, w in enumerate(order)}
    spark = docs.sparkSession
    prefixes, wholes = [], []
    for t, (label, ws) in enumerate(sets):
        ranked, c = sorted(ws, key=place.__getitem__), needed(len(ws), percent)
        wholes.append((t, label, ranked, len(ranked), c))
        prefixes += [(t, w, i) for i, w in enumerate(ranked[: len(ranked) - c + 1])]
    prefix = spark.createDataFrame(prefixes, "t int, word string, i int")
    whole = spark.createDataFrame(wholes, "t int, label string, template array<string>, m int, c int")
    met = candidates(blocks, order, prefix, whole).where(F.size(F.array_intersect("words", "template")) >= F.col("c"))
    common = F.size(F.array_intersect("words", "template"))
    met = met.groupBy("uid", "id", "block", "t").agg(F.first("label").alias("label"), F.first(common / F.col("m")).alias("containment"))
    met = written(met.groupBy("uid", "id", "block", "label").agg(F.max("containment").alias("containment")), "license-blocks-met")
    per = met.groupBy("uid").agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    base = F.array_compact(F.array(*[F.when(F.col("places")[i].isNotNull(), name) for i, name in enumerate(names)]))
    found = F.array_compact("places")
    total = F.aggregate(found, F.lit(0).cast("long"), lambda t, p: t + p["n"])
    out = held.select("uid", "id", "n_words", total.alias("n_base"), F.array_min(F.transform(found, lambda p: p["first"])).alias("first_word"), F.array_max(F.transform(found, lambda p: p["last"])).alias("last_word"), F.array_sort(F.array_distinct(base)).alias("base")).join(per, "uid", "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    out = out.select(
        "id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
    return out, met
