"""License scan as an exact set-similarity join of text blocks and templates.

A text's words are dealt into overlapping blocks, one every half block.  A
template is the set of its words; a block matches when it holds at least the
template's threshold of them (containment).  Templates of up to half BLOCK words
are sought in blocks of BLOCK words, longer ones in the first doubling of BLOCK
that is twice as long as they are, so some block holds a whole copy wherever it stands.

* Token order: the templates' words are counted over all documents; the rarest
  come first.
* Prefix filter: a block that reaches ``need`` of a template's n words shares one
  of its first n - need + 1 in this order, so only blocks with such a word are
  joined with the index (word, template, place).
* Length and positional filters: a candidate goes when the words left in the
  block or in the template after the shared one can't reach ``need``.
* What is left is verified on the full sets; all of it is exact.

The base phrases are templates with threshold 1 whose words must also stand
consecutively, counted at every place: a phrase is at most half a block long, so
the block in whose first half it starts holds all of it.

Only words of some template are kept of a text, with their places; the index is
bounded by the templates.  All of it is SQL expressions.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

BLOCK = 64
APART = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Texts of licences and notices.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall
be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY
KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER
IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND
THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.
IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER
RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT
OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin
of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in
a product, an acknowledgment in the product documentation would be appreciated but is not required. Altered source versions must
be plainly marked as such, and must not be misrepresented as being the original software. This notice may not be removed or
altered from any source distribution."""

#: Label, text and share of the words (without STOP words) that a block must hold.
TEMPLATES = (
    ("all-rights-reserved", "all rights reserved", 1.0),
    ("apache-notice", "licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License", 0.8),
    ("bsd-notice", "Redistribution and use in source and binary forms, with or without modification, are permitted", 0.8),
    ("cc-by-nc", "CC BY-NC", 1.0),
    ("cc-by-sa", "CC BY-SA", 1.0),
    ("cc-notice", "licensed under a Creative Commons Attribution License", 0.8),
    ("gpl-notice", "free software: you can redistribute it and/or modify it under the terms of the GNU General Public License", 0.8),
    ("isc-text", ISC, 0.8),
    ("mit-notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", 0.8),
    ("mit-text", MIT, 0.8),
    ("zlib-text", ZLIB, 0.8),
)
STOP = frozenset("a an and any are can in is it may not of or the this to under use with you".split())


def words_of(text: str) -> list[str]:
    return re.findall("[0-9a-z]+", text.lower())


def block_length(n_words: int) -> int:
    """BLOCK, doubled until half of it holds a template of so many words."""
    length = BLOCK
    while length // 2 < n_words:
        length *= 2
    return length


def catalogue(templates: Iterable[tuple[str, str, float]] = TEMPLATES) -> list[dict]:
    """Base phrases first, then the templates, each with its set of words.
    Templates of STOP words only are left out: any block would hold them."""
    rows = [{"label": label, "phrase": words_of(p), "words": sorted(set(words_of(p))), "least": 1.0, "length": block_length(len(words_of(p)))}
            for p, label in BASE.items()]
    rows += [{"label": label, "phrase": None, "words": sorted(set(words_of(text)) - STOP), "least": least, "length": block_length(len(words_of(text)))}
             for label, text, least in templates if set(words_of(text)) - STOP]
    return [r | {"id": k, "need": max(1, math.ceil(r["least"] * len(r["words"]) - 1e-9))} for k, r in enumerate(rows)]


def _literal(words: list[str]) -> Column:
    return F.array(*map(F.lit, words))


def _words_kept(docs: DataFrame, known: list[str]) -> DataFrame:
    """doc_id, n_words and hits: place and word of the templates' words."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), APART), lambda w: w != "")
    longest = max(map(len, known))
    # short words only are lowered and looked up; the place comes first to keep the order
    low = F.transform(F.col("w"), lambda w, i: F.when(F.length(w) <= longest, F.struct(
        i.alias("p"), F.translate(w, UPPER, LOWER).alias("w"))))
    hits = F.filter(low, lambda x: x.isNotNull() & x["w"].isin(known))
    spotted = F.coalesce("text", F.lit("")).rlike(f"(?i)(?<![^{APART[1:-2]}])(?:" + "|".join(known) + ")")  # at a word's start
    none = F.array().cast("array<struct<p:int,w:string>>")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), words.alias("w"), spotted.alias("spotted")).select(
        "doc_id", F.size("w").cast("bigint").alias("n_words"), F.when(F.col("spotted"), hits).otherwise(none).alias("hits"))


def scan(docs: DataFrame, templates: DataFrame | Iterable[tuple[str, str, float]] = TEMPLATES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_base (all
    places of base phrases), first_word and last_word (their smallest and
    largest start, null without any), base_labels, labels (with the
    templates'; both distinct, sorted, comma-joined) and score (the largest
    containment among the matches, 0 without any).

    A null text is empty; an empty text has no words and no labels.  Rows that
    repeat are each told on their own.  An empty table gives an empty result;
    other columns are not read.

    ``templates`` are rows (label, text, share of its words), a list or a table: a
    catalogue, which is collected and broadcast, of texts of ASCII words.
    """
    spark = docs.sparkSession
    if isinstance(templates, DataFrame):
        templates = [tuple(r) for r in templates.select("label", "text", "share").collect()]
    rules = catalogue(templates)
    known = sorted({w for r in rules for w in r["words"]})
    rows = stored(_words_kept(docs, known).withColumn("row", F.monotonically_increasing_id()), "license-words")

    seen = rows.select(F.explode(F.array_distinct(F.transform("hits", lambda x: x["w"]))).alias("w")).groupBy("w").count()
    count = dict.fromkeys(known, 0) | {r["w"]: r["count"] for r in seen.collect()}  # at most one row for each known word
    rank = {w: k for k, w in enumerate(sorted(known, key=lambda w: (count[w], w)))}
    for r in rules:
        r["words"] = sorted(r["words"], key=rank.__getitem__)
    index = [(w, r["length"], r["id"], k + 1, len(r["words"]), r["need"]) for r in rules
             for k, w in enumerate(r["words"][: len(r["words"]) - r["need"] + 1])]
    first = sorted({w for w, *_ in index})

    ranks = F.create_map(*(F.lit(x) for w, k in rank.items() for x in (w, k)))
    def blocks_of(length: int) -> Column:
        """The blocks of this length that hold a word of a prefix."""
        leads = F.filter("hits", lambda x: x["w"].isin(sorted({w for w, n, *_ in index if n == length})))
        half = F.transform(leads, lambda x: F.floor(x["p"] * 2 / length))
        return F.transform(F.array_distinct(F.flatten(F.transform(half, lambda h: F.array(h, F.greatest(h - 1, F.lit(0)))))),
                           lambda h: F.struct(F.lit(length).alias("length"), h.alias("block")))

    at = F.concat(*map(blocks_of, sorted({r["length"] for r in rules})))
    blocks = rows.where(F.exists("hits", lambda x: x["w"].isin(first))) \
        .select("row", "hits", F.explode(at).alias("at")).select("row", "hits", "at.length", "at.block")
    half = F.floor(F.col("length") / 2)
    start = F.col("block") * half
    blocks = blocks.withColumn("hits", F.filter("hits", lambda x: (x["p"] >= start) & (x["p"] < start + F.col("length"))))
    # the block's set in the global order
    ordered = F.transform(F.array_sort(F.array_distinct(F.transform("hits", lambda x: F.struct(
        F.element_at(ranks, x["w"]).alias("k"), x["w"].alias("w"))))), lambda x: x["w"])
    blocks = blocks.withColumn("words", ordered)

    prefix = F.broadcast(spark.createDataFrame(index, "w string, length int, id int, j int, n int, need int"))  # bounded by the templates
    pairs = blocks.select("row", "length", "block", "hits", "words", F.posexplode("words").alias("i", "w")).join(prefix, ["w", "length"])
    room = 1 + F.least(F.size("words") - F.col("i") - 1, F.col("n") - F.col("j"))
    # positions count from the first shared word of the prefix, where nothing is matched yet
    template = F.element_at(F.array(*(_literal(r["words"]) for r in rules)), F.col("id") + 1)
    before = F.size(F.array_intersect(F.slice("words", F.lit(1), F.col("i")), template))
    pairs = pairs.where((F.size("words") >= F.col("need")) & (before == 0) & (room >= F.col("need")))
    shared = F.size(F.array_intersect("words", template))
    found = pairs.withColumn("score", shared / F.col("n")).where(shared >= F.col("need"))

    phrase = F.element_at(F.array(*(_literal(r["phrase"] or []).cast("array<string>") for r in rules)), F.col("id") + 1)
    label = F.element_at(_literal([r["label"] for r in rules]), F.col("id") + 1)
    held = F.transform("hits", lambda x: F.concat_ws(":", x["p"].cast("string"), x["w"]))
    starts = F.filter(F.transform("hits", lambda x: x["p"]), lambda p: (p < start + half) & F.forall(
        F.transform(phrase, lambda w, k: F.concat_ws(":", (p + k).cast("string"), w)), lambda y: F.array_contains(held, y)))
    found = found.withColumn("starts", F.when(F.size(phrase) > 0, starts).otherwise(F.array().cast("array<int>"))) \
        .withColumn("label", label).where((F.size(phrase) == 0) | (F.size("starts") > 0))
    base = F.size(phrase) > 0
    per_row = found.groupBy("row").agg(
        F.sum(F.size("starts")).cast("bigint").alias("n_base"), F.min(F.array_min("starts")).cast("bigint").alias("first_word"),
        F.max(F.array_max("starts")).cast("bigint").alias("last_word"),
        F.collect_set(F.when(base, F.col("label"))).alias("base"), F.collect_set("label").alias("all"), F.max("score").alias("score"))
    joined = lambda c: F.coalesce(F.array_join(F.array_sort(c), ","), F.lit(""))
    return (rows.select("row", "doc_id", "n_words").join(per_row, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        joined("base").alias("base_labels"), joined("all").alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score")))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
