"""License scans: short phrases, and a set-similarity join of text blocks with license templates.

A block is a paragraph: text up to a blank line, or up to a line that ends a sentence. A template is
found in a block when the block holds at least the required share of the template's distinct words
(containment). The join is exact and looks at few pairs:

* words are ordered by how many blocks hold them, rarest first;
* a block that meets the threshold holds one of the first m - r + 1 words of a template of m words of
  which r are required, so only these prefixes are looked up;
* a block with fewer template words than r is out by its length;
* the places of the common word in both ordered sets bound the whole overlap.

Defined results: null and empty texts have no words, empty labels and score 0. Repeated rows are
answered alike. Other columns are not read. Only words of the templates are kept of a block; the
order is a row per such word, so what the driver gets is bounded by the templates.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger.functions.text import contains_any, let
from roomledger.llm.common import stored, text_of

#: What separates words: all of ASCII but digits and small letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What separates blocks.
BLOCKS = r"\n[ \t\r]*\n\s*|(?<=[.!?:;])[ \t\r]*\n"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    #: Share of the template's distinct words that a block must hold.
    share: float = 0.8

    @property
    def words(self) -> list[str]:
        return sorted(set(self.text.split()))

    @property
    def required(self) -> int:
        return math.ceil(self.share * len(self.words) - 1e-9)


# Phrases with their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Sentences of well-known license notices, lower case and without marks.
TEMPLATES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    Template("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", 0.9),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
    Template("apache-2.0", "licensed under the apache license version 2 0", 1.0),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", 1.0),
    Template("cc-by-nc", "licensed under cc by nc", 1.0),
    Template("cc-by-sa", "licensed under cc by sa", 1.0),
)


def _phrase_places(words: Column, phrases: Sequence[tuple[str, str]]) -> Column:
    """(place, label) of every phrase, in order of place."""

    def label(word: Column, i: Column) -> Column:
        out = F.lit(None).cast("string")
        for phrase, name in phrases:
            first, *more = phrase.split()
            match = word == first
            for k, other in enumerate(more, 1):
                match = match & (F.get(words, i + k) == other)
            out = F.when(match, F.lit(name)).otherwise(out)
        return F.struct(i.cast("long").alias("place"), out.alias("label"))

    return F.filter(F.transform(words, label), lambda x: x["label"].isNotNull())


def _block_words(text: Column, vocabulary: Sequence[str], least: int) -> Column:
    blocks = F.transform(
        F.split(text, BLOCKS),
        lambda b, i: F.struct(
            i.alias("block"),
            F.array_distinct(F.filter(F.split(b, BETWEEN), lambda w: w.isin(*vocabulary))).alias("words"),
        ),
    )
    return F.filter(blocks, lambda b: F.size(b["words"]) >= least)


def _prefixes(templates: Sequence[Template], order: list[str]) -> list[tuple]:
    """(template, label, size, required, ranks, rank, place) for the words of every prefix."""
    rank = {w: i for i, w in enumerate(order)}
    rows = []
    for t, template in enumerate(templates):
        ranks = sorted(rank[w] for w in template.words)
        for place in range(len(ranks) - template.required + 1):
            rows.append((t, template.label, len(ranks), template.required, ranks, ranks[place], place))
    return rows


def found_blocks(blocks: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """(_row, block, label, containment) of every block that meets a template's threshold.

    `blocks` is a stored table of (_row, blocks); it is read twice.
    """
    spark = blocks.sparkSession
    vocabulary = sorted({w for t in templates for w in t.words})
    each = blocks.select("_row", F.explode("blocks").alias("b"))
    # At most a row per word of the templates.
    counts = {r[0]: r[1] for r in each.select(F.explode("b.words").alias("w")).groupBy("w").count().collect()}
    order = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    prefixes = _prefixes(templates, order)
    table = spark.createDataFrame(
        prefixes,
        "template int, label string, m int, required int, ranks array<int>, rank int, place int",
    )
    early = sorted({order[p[5]] for p in prefixes})
    places = F.array(*map(F.lit, order))
    ranked = each.where(F.arrays_overlap("b.words", F.array(*map(F.lit, early)))).select(
        "_row", "b.block",
        F.sort_array(F.transform("b.words", lambda w: (F.array_position(places, w) - 1).cast("int"))).alias("own"),
    )
    left, right = F.least("place", "at"), F.least(F.col("m") - F.col("place"), F.size("own") - F.col("at"))
    return (
        ranked.select("_row", "block", "own", F.posexplode("own").alias("at", "rank"))
        .join(F.broadcast(table), "rank")  # templates times prefix words, a parameter
        .where(F.size("own") >= F.col("required"))
        .where(left + right >= F.col("required"))
        .select("_row", "block", "label", "m", "required", F.size(F.array_intersect("own", "ranks")).alias("both"))
        .where("both >= required")
        .groupBy("_row", "block", "label").agg(F.max(F.col("both") / F.col("m")).alias("containment"))
    )


def telling_words(phrases: Sequence[tuple[str, str]]) -> list[str]:
    """A few words of which every phrase has one: a text without any of them holds no phrase."""
    left, chosen = [phrase.split() for phrase, _ in phrases], []
    while left:
        counts = Counter(word for words in left for word in dict.fromkeys(words))
        chosen.append(max(counts, key=lambda word: (counts[word], len(word))))
        left = [words for words in left if chosen[-1] not in words]
    return chosen


def scanned(
    docs: DataFrame,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    templates: Sequence[Template] = TEMPLATES,
    id_column: str = "doc_id",
) -> DataFrame:
    """One row per document: words, phrase places, labels of phrases and templates, and a score.

    The score is 1 where a phrase stands, else the largest containment found, else 0.
    """
    vocabulary = sorted({w for t in templates for w in t.words})
    least = min(t.required for t in templates)
    telling = telling_words(phrases)
    # Full lower case: beyond A-Z it changes letters outside ASCII only, which no phrase has.
    text = F.lower(text_of(docs))

    def fields(t: Column) -> Column:
        words = F.array_remove(F.split(t, BETWEEN), "")
        may = contains_any(t, telling) if telling else F.lit(False)
        return let(
            words,
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.when(may, _phrase_places(w, phrases)).otherwise(
                    F.expr("cast(array() as array<struct<place:bigint,label:string>>)")
                ).alias("places"),
                _block_words(t, vocabulary, least).alias("blocks"),
            ),
        )

    rows = stored(
        docs.select(
            docs[id_column].alias("doc_id"), let(text, fields).alias("f")
        ).select("doc_id", F.monotonically_increasing_id().alias("_row"), "f.*"),
        "license-rows",
    )
    hits = (
        found_blocks(rows.select("_row", "blocks"), templates)
        .groupBy("_row").agg(F.collect_set("label").alias("found"), F.max("containment").alias("containment"))
    )
    names = F.array_distinct(F.transform("places", lambda p: p["label"]))
    own = F.coalesce("found", F.expr("cast(array() as array<string>)"))
    joined = lambda labels: F.array_join(F.sort_array(labels), ",")
    return rows.join(hits, "_row", "left").select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.get("places", F.lit(0))["place"].alias("first_word"),
        F.when(F.size("places") > 0, F.element_at("places", -1)["place"]).alias("last_word"),
        joined(names).alias("base_labels"), joined(F.array_union(names, own)).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )
