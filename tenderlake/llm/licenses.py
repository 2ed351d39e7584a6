"""License scans: exact set-similarity join of text blocks with license templates, in DataFrame operations only.

A document's words are read in blocks of 64, each starting 32 words after the last, so that every
run of up to 33 words lies whole in the block that owns its first word. A block meets a template if it
contains at least the template's threshold of its distinct words. Words are ordered by the number of
documents that hold them, rarest first. Then

- length: a block must hold as many template words as are asked for;
- prefix: block and template must share one of the first few words of this order, few enough that what
  remains could not reach the threshold without them;
- position: what follows the shared word on either side must suffice.

Pairs that pass are verified by counting the shared words. Phrases are templates with threshold 1
whose words must also stand one after another, which is checked in the matched blocks. Every template
that a block meets gives its label, but for one whose shared words are all among those that the block
shares with a better contained template of its family (the notice of one license of a family is nearly
that of another).

Null and empty texts have no words. Rows equal in key and text give equal rows. Texts of any length are
read whole; blocks keep what is compared of bounded size. Templates contained alike both give their labels.
Other columns are ignored, whatever their names. An empty table gives no rows. The templates are the
only broadcast table; their number is a parameter of the operator, not of the data.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.llm.common import WORD_PATTERN, lowered

STEP = 32
_SPAN = 2 * STEP


@dataclass(frozen=True)
class Template:
    label: str
    family: str
    words: tuple[str, ...]
    threshold: float
    phrase: bool = False

    @property
    def distinct(self) -> list[str]:
        return sorted(set(self.words))

    @property
    def needed(self) -> int:
        return math.ceil(self.threshold * len(set(self.words)) - 1e-9)


def _phrase(text: str, label: str) -> Template:
    return Template(label, f"phrase {text}", tuple(text.split()), 1.0, True)


def _notice(label: str, family: str, text: str, threshold: float = 0.8) -> Template:
    return Template(label, family, tuple(text.split()), threshold)


# Phrases with their labels, and opening sentences of public license notices.
PHRASES = (
    _phrase("mit license", "mit"),
    _phrase("apache license", "apache"),
    _phrase("general public license", "gpl"),
)
NOTICES = (
    _notice("agpl-3.0", "gnu", "you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    _notice("all-rights-reserved", "reserved", "all rights reserved", 1.0),
    _notice("apache-2.0", "apache", "licensed under the apache license version 2 0"),
    _notice("bsd", "bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    _notice("cc-by-4.0", "cc", "licensed under cc by 4 0"),
    _notice("cc-by-nc-4.0", "cc", "licensed under cc by nc 4 0"),
    _notice("cc-by-sa-4.0", "cc", "licensed under cc by sa 4 0"),
    _notice("cc0-1.0", "cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights"),
    _notice("gpl-3.0", "gnu", "this work is licensed under the gnu general public license version 3"),
    _notice("isc", "isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    _notice("lgpl-3.0", "gnu", "you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    _notice("mit-notice", "mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    _notice("mpl-2.0", "mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)


def _texts(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _tokens(docs: DataFrame, key: str, text: str) -> DataFrame:
    found = F.regexp_extract_all(lowered(F.col(text)), F.lit(f"({WORD_PATTERN})"), F.lit(1))
    return docs.select(F.col(key).alias("key"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("doc"), found.alias("words"))


def _order(rows: DataFrame, vocabulary: list[str]) -> list[str]:
    """The templates' words by the number of documents that hold them; the result is as small as the templates."""
    held = rows.select(F.explode(F.array_intersect(_texts(vocabulary), F.col("words"))).alias("word"))
    counts = {r["word"]: r["count"] for r in held.groupBy("word").count().collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def matches(docs: DataFrame, templates: Sequence[Template], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every block that meets a template: key, doc (hash of the text), block, template (its place), contained (share of its words), shared (those words), starts.

    `starts` are the words where a phrase that the block owns begins.
    """
    if any(len(t.words) > STEP for t in templates):
        raise ValueError(f"templates may have up to {STEP} words")
    rows = _tokens(docs, key, text)
    vocabulary = sorted({w for t in templates for w in t.words})
    order = _order(rows, vocabulary)
    rank = {w: i for i, w in enumerate(order)}
    least = min(t.needed for t in templates)
    entries, first_words = [], set()
    for place, t in enumerate(templates):
        ordered = sorted(t.distinct, key=rank.__getitem__)
        for i, word in enumerate(ordered[: len(ordered) - t.needed + 1]):
            first_words.add(word)
            entries.append((word, place, i, len(ordered), t.needed, ordered, list(t.words) if t.phrase else []))
    index = docs.sparkSession.createDataFrame(entries, "word string, template int, i int, size int, needed int, ordered array<string>, phrase array<string>")
    blocks = rows.where(F.arrays_overlap("words", _texts(sorted(first_words))))
    starts = F.sequence(F.lit(0), F.size("words") - 1, F.lit(STEP))
    blocks = blocks.select("key", "doc", F.posexplode(F.transform(starts, lambda i: F.slice("words", i + 1, F.lit(_SPAN)))).alias("block", "here"))
    blocks = blocks.withColumn("held", F.array_intersect(_texts(order), F.col("here"))).where(F.size("held") >= least)
    prefix = F.slice("held", F.lit(1), F.size("held") - (least - 1))
    keyed = blocks.select("key", "doc", "block", "here", "held", F.posexplode(prefix).alias("j", "word"))
    reach = F.least(F.col("size") - F.col("i"), F.size("held") - F.col("j"))
    pairs = keyed.join(F.broadcast(index), "word").where((F.size("held") >= F.col("needed")) & (reach >= F.col("needed")))
    pairs = pairs.withColumn("shared", F.array_intersect("ordered", "held")).where(F.size("shared") >= F.col("needed"))
    n = F.size("phrase")
    places = F.filter(F.sequence(F.lit(1), F.least(F.lit(STEP), F.size("here"))), lambda p: F.slice("here", p, n) == F.col("phrase"))
    at = F.when(n > 0, F.transform(places, lambda p: (F.col("block") * STEP + p - 1).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    pairs = pairs.select("key", "doc", "block", "template", (F.size("shared") / F.col("size")).alias("contained"), "shared", at.alias("starts"))
    return pairs.dropDuplicates(["key", "doc", "block", "template"])


def labelled(docs: DataFrame, phrases: Sequence[Template] = PHRASES, notices: Sequence[Template] = NOTICES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: words, places of phrases, the phrases' labels, all labels, and a score.

    The score is the highest containment of a template that gave a label, 1 for a phrase.
    """
    templates = [*phrases, *notices]
    about = docs.sparkSession.createDataFrame([(i, t.label, t.family, t.phrase) for i, t in enumerate(templates)], "template int, label string, family string, is_phrase boolean")
    found = matches(docs, templates, key, text).join(F.broadcast(about), "template")
    found = found.where(~F.col("is_phrase") | (F.size("starts") > 0))
    best = found.groupBy("key", "doc", "block", "family").agg(
        F.max("contained").alias("contained"),
        F.collect_list(F.struct("contained", "label", "shared")).alias("all"),
        F.first("is_phrase").alias("is_phrase"),
        F.flatten(F.collect_list("starts")).alias("starts"),
    )
    within = lambda x, y: (y["contained"] > x["contained"]) & (F.size(F.array_except(x["shared"], y["shared"])) == 0)
    top = F.transform(F.filter("all", lambda x: ~F.exists("all", lambda y: within(x, y))), lambda x: x["label"])
    nothing = F.array().cast("array<string>")
    starts = F.col("starts")
    by_doc = best.select("key", "doc", "contained", top.alias("top"), "is_phrase", F.size(starts).alias("n"), F.array_min(starts).alias("low"), F.array_max(starts).alias("high"))
    by_doc = by_doc.groupBy(F.col("key").alias("k"), F.col("doc").alias("d")).agg(
        F.sum("n").alias("n_base"),
        F.min("low").alias("first_word"),
        F.max("high").alias("last_word"),
        F.array_distinct(F.flatten(F.collect_set(F.when(F.col("is_phrase"), F.col("top"))))).alias("base"),
        F.array_distinct(F.flatten(F.collect_set("top"))).alias("labels"),
        F.max("contained").alias("score"),
    )
    rows = _tokens(docs, key, text).select("key", "doc", F.size("words").cast("long").alias("n_words"))
    joined = rows.join(by_doc, F.col("key").eqNullSafe(F.col("k")) & (F.col("doc") == F.col("d")), "left")
    line = lambda c: F.array_join(F.sort_array(F.coalesce(F.col(c), nothing)), ",")
    return joined.select(
        F.col("key").alias(key),
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        line("base").alias("base_labels"),
        line("labels").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
