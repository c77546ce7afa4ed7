"""License phrases and license texts in documents, with DataFrame functions alone.

Method: diagonal voting. Every rolling k-gram of a document's words is joined
with the places of the templates' k-grams. A hit votes for the diagonal where the
template would start; votes are counted per diagonal, neighbouring diagonals of a
template are merged, which lets words be added or left out, and the merged spans
are verified by the words that the hits cover.

Templates are a fixed table of a few hundred k-grams, so the join moves no
document, and only hits are grouped. Voting, merging and verifying work on the array of a
document's hits, which is no longer than its words times the templates that share a k-gram.
"""

from __future__ import annotations

import json
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAM = 3
# Diagonals this far apart belong to one span; part of a template that a span must cover.
APART = 3
COVERED = 0.75
# Separators of words.
_GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Fixed values. Phrases that give a label wherever their words stand consecutively.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Sentences of license notices; most of one, with small changes, gives its label.
NOTICES = {
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "either version 3 of the license or at your option any later version": "gpl-3",
    "licensed under the apache license version 2 0 the license": "apache-2",
    "you may not use this file except in compliance with the license": "apache-2",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "released under the mit license": "mit",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2",
}


def words_of(text: str = "text") -> Column:
    """Words in lower case. Only A-Z can become a-z: the kelvin sign, the other letter that would, is replaced."""
    plain = F.replace(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit("\u212a"), F.lit("\u0138"))
    return F.array_remove(F.split(F.lower(plain), _GAPS), "")


def template_grams(
    spark: SparkSession, base: dict[str, str], notices: dict[str, str]
) -> tuple[DataFrame, list[list[str]], list[tuple[str, bool, int]]]:
    """(hash, places): one row per hash of a k-gram, with the templates and places it has.

    Also the words at each place of a k-gram, and each template's label, kind and size.
    """
    rows, templates = [], []
    for phrases in (base, notices):
        for phrase, label in sorted(phrases.items()):
            words = phrase.split()
            if len(words) < GRAM:
                raise ValueError(f"a template needs {GRAM} words: {phrase!r}")
            for at in range(len(words) - GRAM + 1):
                rows.append({"gram": " ".join(words[at : at + GRAM]), "template": len(templates), "at": at})
            templates.append((label, phrases is base, len(words)))
    # Bounded by the fixed templates; read from a literal, so that no Python worker is started for them.
    table = F.from_json(F.lit(json.dumps(rows)), "array<struct<gram string, template int, at int>>")
    grams = spark.range(0, 1, numPartitions=1).select(F.inline(table))
    names = F.split("gram", " ")
    place = F.struct("gram", "template", "at")
    grams = grams.groupBy(F.xxhash64(*[names[i] for i in range(GRAM)]).alias("hash"))
    by_place = [sorted({r["gram"].split()[i] for r in rows}) for i in range(GRAM)]
    return grams.agg(F.collect_list(place).alias("places")), by_place, templates


def _hits(docs: DataFrame, templates: DataFrame, by_place: list[list[str]], doc_id: str, text: str) -> DataFrame:
    """A row for every hit of a template's gram, and one at least for every document."""
    words = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), words_of(text).alias("words")
    )

    def gram(word: Column, at: Column) -> Column:
        """The gram that starts here; null if a template has one of its words at no such place."""
        own = [word, *[F.get("words", at + i) for i in range(1, GRAM)]]
        known = reduce(and_, [w.isin(place) for w, place in zip(own, by_place)])
        return F.when(known, F.struct(at.alias("pos"), *[w.alias(f"w{i}") for i, w in enumerate(own)]))

    # Only grams that may be hits become rows; a document without one keeps a row.
    grams = F.array_compact(F.transform("words", gram))
    rolled = words.select("row", "doc_id", F.size("words").alias("n"), F.posexplode_outer(grams).alias("number", "gram"))
    rolled = rolled.select("row", "doc_id", "n", F.coalesce("number", F.lit(0)).alias("number"), "gram.*")
    rolled = rolled.withColumn("hash", F.xxhash64(*[f"w{i}" for i in range(GRAM)]))
    joined = rolled.join(F.broadcast(templates), "hash", "left").filter("number = 0 or places is not null")
    found = F.concat_ws(" ", *[f"w{i}" for i in range(GRAM)]).alias("found")
    hits = joined.select("row", "doc_id", "n", "number", "pos", found, F.explode_outer("places").alias("p"))
    # Equal hashes are not enough: the words must be the same.
    true = F.col("p.gram") == F.col("found")
    return hits.filter(true | (F.col("number") == 0)).select(
        "row", "doc_id", "n", "pos", F.when(true, F.col("p")).alias("p")
    )


def _with_spans(rows: DataFrame, templates: list[tuple[str, bool, int]]) -> DataFrame:
    """The rows with spans from hits (template, diagonal, at, pos), all by functions on the row's own array."""
    table = F.array(*[F.struct(*map(F.lit, t)).cast("struct<label string, base boolean, size int>") for t in templates])
    rows = rows.withColumn("hits", F.array_sort("hits"))

    def opens(hit: Column, i: Column) -> Column:
        before = F.get("hits", i - 1)
        # A base phrase must stand on one diagonal; a notice may go on at a close one.
        apart = F.when(F.get(table, hit["template"])["base"], F.lit(0)).otherwise(F.lit(APART))
        new = (hit["template"] != before["template"]) | (hit["diagonal"] - before["diagonal"] > apart)
        return F.when((i == 0) | new, i + 1)

    rows = rows.withColumn("starts", F.array_compact(F.transform("hits", opens)))

    def part(start: Column, i: Column) -> Column:
        end = F.coalesce(F.get("starts", i + 1), F.size("hits") + 1)
        return F.slice("hits", start, end - start)

    def span(part: Column) -> Column:
        template = F.get(table, F.get(part, F.lit(0))["template"])
        words = F.flatten(F.transform(part, lambda h: F.sequence(h["at"], h["at"] + GRAM - 1)))
        score = F.size(F.array_distinct(words)) / template["size"]
        places = F.transform(part, lambda h: h["pos"])
        found = F.struct(
            template["label"].alias("label"),
            template["base"].alias("base"),
            F.array_min(places).cast("long").alias("first"),
            (F.array_max(places) + GRAM - 1).cast("long").alias("last"),
            score.alias("score"),
        )
        return F.when(score >= F.when(template["base"], F.lit(1.0)).otherwise(F.lit(COVERED)), found)

    found = F.array_compact(F.transform(F.transform("starts", part), span))
    return rows.withColumn("spans", F.array_sort(found))


def scan_licenses(
    docs: DataFrame,
    base: dict[str, str] = BASE,
    notices: dict[str, str] = NOTICES,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """License spans of every document; one row per input row.

    Words are runs of ASCII letters and digits and all non-ASCII characters, A-Z
    in lower case. Columns: doc_id, n_words, spans (label, base, first and last
    word from 0, score). A base phrase gives a span with score 1 at each place
    where its words stand consecutively; a notice gives one for each region that
    covers at least COVERED of its words, with that part as score.

    A null text counts as empty and has no words and no spans. Phrases that
    overlap all count. Other columns are not looked at. Templates are at least
    GRAM words in lower case.
    """
    grams, by_place, templates = template_grams(docs.sparkSession, base, notices)
    hits = _hits(docs, grams, by_place, doc_id, text)
    hit = F.struct("p.template", (F.col("pos") - F.col("p.at")).alias("diagonal"), "p.at", "pos")
    # One grouping, by row of the input; its tasks hold one sorter each, and not one for each step of the voting.
    rows = hits.groupBy("row", "doc_id", "n").agg(F.collect_list(F.when(F.col("p").isNotNull(), hit)).alias("hits"))
    rows = _with_spans(rows, templates)
    return rows.select("doc_id", F.col("n").cast("long").alias("n_words"), "spans")
