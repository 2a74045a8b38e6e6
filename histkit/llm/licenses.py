"""License scans by diagonal voting, in DataFrame functions only.

Every text is cut into words, and the hashes of all its rolling word k-grams are joined to the
places of the same k-grams in license templates. A hit at word p of the text and word q of a
template votes for the diagonal p - q: a verbatim copy puts all its votes on one diagonal, a
copy with words put in or left out spreads them over neighbouring ones, which are merged. A
span counts when the words that its hits cover make up enough of the template.

Hits are compared word by word in the join, so a hash only narrows the search. The join's small
side is the template table, whose size does not depend on the data; texts and k-grams are never
shuffled, only hits and one row per document.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Templates of at most this many words are phrases: all their words must stand consecutively.
PHRASE_WORDS = 6
#: Words of a k-gram, of phrases and of longer templates.
PHRASE_GRAM, TEXT_GRAM = 2, 4
#: Neighbouring diagonals that are merged, and the share of a template's words to be covered.
GAP, LEAST = 8, 0.7
#: Template k-grams up to this number are broadcast (about 10 MB); more are joined as Spark decides.
BROADCAST_GRAMS = 100_000


@dataclass(frozen=True)
class Template:
    """Words that name or make up a license. ``base`` marks the phrases that are always reported."""

    label: str
    text: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return "".join(c if c.isalnum() else " " for c in self.text.lower()).split()

    @property
    def phrase(self) -> bool:
        return len(self.words) <= PHRASE_WORDS


# The base phrases and their labels.
BASE = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
)

# Names and public notices of well-known licenses.
OTHERS = (
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("mpl", "mozilla public license"),
    Template("cc-by", "creative commons attribution"),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The "
        "above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software.",
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution.",
    ),
    Template(
        "apache",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF "
        "ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    Template(
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    Template(
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
)

TEMPLATES = BASE + OTHERS


def text_words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; none for null."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def gram_rows(templates: Sequence[Template]) -> list[tuple]:
    """(template, place, words of the k-gram, label, is base, is phrase, words of the template)."""
    rows = []
    for number, t in enumerate(templates):
        words, k = t.words, PHRASE_GRAM if t.phrase else TEXT_GRAM
        if len(words) < k:
            raise ValueError(f"a template needs {k} words or more: {t.text!r}")
        rows += [(number, i, words[i : i + k], t.label, t.base, t.phrase, len(words)) for i in range(len(words) - k + 1)]
    return rows


GRAMS = "template int, place int, gram_words array<string>, label string, base boolean, phrase boolean, template_words int"


def _gram(words: Column, at: Column, k: int) -> Column:
    """Hash of ``k`` words; null where fewer are left."""
    return F.when(at + k <= F.size(words), F.xxhash64(*[F.get(words, at + i) for i in range(k)]))


def hits(docs: DataFrame, templates: Sequence[Template]) -> DataFrame:
    """Every place of a template's k-gram in a text, and one row without a template per document.

    All in one pass over the texts: element 0 of the exploded words stands for the document.
    """
    spark = docs.sparkSession
    rows = gram_rows(templates)
    known = spark.createDataFrame(rows, GRAMS)
    zero = F.lit(0)
    known = known.withColumn("gram", F.when(F.size("gram_words") == PHRASE_GRAM, _gram(F.col("gram_words"), zero, PHRASE_GRAM)).otherwise(_gram(F.col("gram_words"), zero, TEXT_GRAM)))
    known = known.unionByName(spark.createDataFrame([(0,)], "gram long"), allowMissingColumns=True)
    words = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_words(F.col("text")).alias("words"))
    each = words.select("row", "doc_id", "words", F.posexplode(F.concat(F.array(F.lit("")), "words")).alias("at", "word")).drop("word")
    at = F.col("at") - 1
    grams = F.when(F.col("at") == 0, F.array(F.lit(0).cast("long"))).otherwise(F.array(_gram(F.col("words"), at, PHRASE_GRAM), _gram(F.col("words"), at, TEXT_GRAM)))
    each = each.select("row", "doc_id", "words", at.alias("at"), F.explode(grams).alias("gram"))
    same = F.when(F.col("template").isNull(), F.col("at") == -1).otherwise(F.slice("words", F.greatest(F.col("at"), zero) + 1, F.size("gram_words")) == F.col("gram_words"))
    found = each.join(F.broadcast(known) if len(rows) <= BROADCAST_GRAMS else known, "gram").where(same)
    none = F.col("template").isNull()
    return found.select(
        "row",
        F.when(none, F.col("doc_id")).alias("doc_id"),
        F.when(none, F.size("words").cast("long")).alias("n_words"),
        "template",
        "label",
        "base",
        "phrase",
        "template_words",
        F.size("gram_words").alias("k"),
        "place",
        (F.col("at") - F.col("place")).alias("diagonal"),
    )


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, gap: int = GAP, least: float = LEAST) -> DataFrame:
    """One row per document (doc_id and text; other columns are ignored): doc_id, n_words and
    ``spans``, an array of (first_word, end_word, label, base, coverage) in that order.

    A phrase is a span when all its k-grams vote for one diagonal. A longer template is one when
    the k-grams on diagonals at most ``gap`` apart cover at least ``least`` of its words; of
    neighbouring diagonals the one with the most coverage stands for the span, the first of
    equals. A null or empty text has no words, a repeated row is scanned again, an empty table
    gives no rows. What one task holds at once is at most one document's hits.
    """
    found = hits(docs, templates).repartition("row")  # serves every step below
    lines = found.groupBy("row", "template", "diagonal").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("n_words").alias("n_words"),
        *[F.first(c).alias(c) for c in ("label", "base", "phrase", "template_words", "k")],
        F.collect_list("place").alias("places"),
    )
    near = Window.partitionBy("row", "template").orderBy("diagonal").rangeBetween(-gap, gap)
    places = F.when(F.col("phrase"), F.col("places")).otherwise(F.flatten(F.collect_list("places").over(near)))
    lines = lines.withColumn("merged", F.array_distinct(places))
    covered = F.size(F.array_distinct(F.flatten(F.transform("merged", lambda p: F.sequence(p, p + F.col("k") - 1)))))
    lines = lines.withColumn("coverage", F.when(F.col("template").isNotNull(), covered / F.col("template_words")))
    best = F.max(F.struct("coverage", -F.col("diagonal"))).over(near)
    whole = F.when(F.col("phrase"), F.size("places") == F.col("template_words") - F.col("k") + 1).otherwise(
        (F.col("coverage") >= least) & (best["coverage"] == F.col("coverage")) & (best["col2"] == -F.col("diagonal"))
    )
    first = F.greatest(F.col("diagonal") + F.array_min("merged"), F.lit(0)).cast("long")
    end = (F.col("diagonal") + F.array_max("merged") + F.col("k")).cast("long")
    span = F.struct(first.alias("first_word"), end.alias("end_word"), "label", "base", "coverage")
    return (
        lines.withColumn("span", F.when(whole, span))
        .groupBy("row")
        .agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.array_sort(F.collect_list("span")).alias("spans"))
        .drop("row")
    )


def summary(scanned: DataFrame) -> DataFrame:
    """Counts and labels of :func:`scan`'s rows: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels (distinct, sorted, comma-joined) and score, the largest coverage or 0."""
    base = F.filter("spans", lambda s: s["base"])

    def joined(spans: Column) -> Column:
        return F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))))

    starts = F.transform(base, lambda s: s["first_word"])
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["coverage"])), F.lit(0.0)).alias("score"),
        "spans",
    )
