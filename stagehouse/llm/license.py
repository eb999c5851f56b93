"""License scans: an exact set-similarity join of text blocks with license templates.

A template is a set of words and the share of it (``least``) that a block must contain.
A text is cut into overlapping blocks of twice as many words as the template's class
has (``STEPS``), one every class size, so whatever a template's words span lies whole
in some block. Words are ordered by how often the whole corpus has them, rarest first,
and only blocks that hold one of a template's first ``size - need + 1`` words can contain ``need`` of
them (prefix filter). Of those, blocks with fewer than ``need`` known words go (length filter), then those whose
words from the first common one on are too few on either side (positional filter); the rest are counted exactly.
Each pair of block and template is looked at once, from its rarest common word.

The three base phrases are templates that must be contained whole; their blocks are then
checked for places where the words stand consecutively, and a place counts for the block
whose first half it begins in.

Texts are cut into segments before any of it, so no row holds more than a segment's known words. The join runs inside
tasks against the templates (a table of fixed size); only what matched is shuffled.

Defined cases: a null text is empty and has no words; rows that share an id, or have none,
are scanned each on its own; no label is the empty string; score is the largest contained share
of a matched template, else 0; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagehouse.llm.common import lower_ascii, read_table
from stagehouse.session import materialize

TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    least: float = 0.8
    phrase: bool = False

    @property
    def sequence(self) -> list[str]:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in self.text)
        return re.findall(TOKEN, low)

    @property
    def words(self) -> set[str]:
        return set(self.sequence)

    @property
    def need(self) -> int:
        return max(1, math.ceil(round(self.least * len(self.words), 9)))

    @property
    def step(self) -> int:
        return next(s for s in STEPS if s >= len(self.sequence))


# Words a template of each class may have; a segment is a multiple of each.
STEPS = (4, 16, 64)
SEGMENT = 512

# Phrases whose places are counted, and their labels.
PHRASES = (
    Template("cc-by", "cc by", 1.0, True),
    Template("gpl", "general public license", 1.0, True),
    Template("reserved", "all rights reserved", 1.0, True),
)
# Notices of public licenses, with the share of their words a block must have.
NOTICES = (
    Template("apache", "licensed under the Apache License, Version 2.0", 0.85),
    Template("apache", "you may not use this file except in compliance with the License"),
    Template("apache", "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided"),
    Template("cc-by-nc", "licensed under CC BY-NC 4.0", 1.0),
    Template("cc-by-nc", "Creative Commons Attribution NonCommercial International License", 1.0),
    Template("cc-by-sa", "Creative Commons Attribution ShareAlike License", 1.0),
    Template("cc0", "dedicated to the public domain under CC0 waiving all rights"),
    Template("gpl", "licensed under the GNU General Public License, version 3", 0.85),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation",
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    ),
    Template("mit", "released under the MIT License", 1.0),
    Template("mit", "licensed under the MIT License", 1.0),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files, to deal in the Software without restriction",
    ),
    Template("mpl", "subject to the terms of the Mozilla Public License, v. 2.0", 0.85),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
)
TEMPLATES = (*PHRASES, *NOTICES)


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(f"({TOKEN})"), 1)


def known_words(docs: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """Words of the vocabulary by place: a row per segment that has any, and the first one of each document.

    Columns: rid (one per row of ``docs``), doc_id, n_words, segment, hits (pos, word).
    """
    split = docs.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", _tokens(F.col("text")).alias("words")
    ).withColumn("n_words", F.size("words").cast("long"))
    last = F.expr(f"greatest(0, (n_words - 1) div {SEGMENT})")
    cut = split.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("segment")).withColumn(
        "words", F.slice("words", F.col("segment").cast("int") * SEGMENT + 1, SEGMENT + STEPS[-1])
    )
    numbered = F.transform("words", lambda w, i: F.struct((F.col("segment") * SEGMENT + i).alias("pos"), w.alias("word")))
    hits = F.filter(numbered, lambda h: h["word"].isin(list(vocabulary)))
    return cut.select("rid", "doc_id", "n_words", "segment", hits.alias("hits")).where("segment = 0 OR size(hits) > 0")


def word_counts(segments: DataFrame, vocabulary: Sequence[str]) -> dict[str, int]:
    """How often the corpus has each word of the vocabulary; segments overlap, so only what a segment owns counts."""
    own = segments.select("segment", F.explode("hits").alias("hit")).where(F.col("hit.pos") < (F.col("segment") + 1) * SEGMENT)
    found = {r["word"]: r["count"] for r in own.groupBy(F.col("hit.word").alias("word")).count().collect()}
    return {w: found.get(w, 0) for w in vocabulary}


def _template_table(spark: SparkSession, templates: Sequence[Template], ranks: Mapping[str, int]) -> DataFrame:
    """One row per template and word of its prefix; words are their ranks, rarest first."""
    rows = []
    for n, t in enumerate(templates):
        ordered = sorted(ranks[w] for w in t.words)
        sequence = [ranks[w] for w in t.sequence]
        for rank in ordered[: len(ordered) - t.need + 1]:
            rows.append((n, t.label, t.phrase, t.step, t.need, ordered, sequence, rank))
    schema = "template int, label string, phrase boolean, step int, need int, set array<int>, sequence array<int>, first int"
    return spark.createDataFrame(rows, schema)


def matches(segments: DataFrame, templates: Sequence[Template], counts: Mapping[str, int]) -> DataFrame:
    """Blocks that contain enough of a template: rid, template, label, phrase, share, places (of phrases)."""
    order = sorted(counts, key=lambda w: (counts[w], w))
    ranks = {w: i for i, w in enumerate(order)}
    index = _template_table(segments.sparkSession, templates, ranks)
    rare = sorted({w for t in templates for w in sorted(t.words, key=ranks.get)[: len(t.words) - t.need + 1]})
    rank_of = F.create_map(*[F.lit(v) for w in order for v in (w, ranks[w])])
    ranked = segments.where(F.exists("hits", lambda h: h["word"].isin(rare))).select(
        "rid",
        "segment",
        F.transform("hits", lambda h: F.struct(h["pos"].alias("pos"), F.element_at(rank_of, h["word"]).alias("rank"))).alias("hits"),
    )
    probes = ranked.select("*", F.explode("hits").alias("hit")).join(F.broadcast(index), F.col("hit.rank") == F.col("first"))
    own = (F.col("block") >= 0) & F.expr(f"block * step div {SEGMENT} = segment")
    held = F.filter(
        "hits", lambda h: (h["pos"] >= F.col("block") * F.col("step")) & (h["pos"] < (F.col("block") + 2) * F.col("step"))
    )
    blocks = (
        probes.withColumn("block", F.explode(F.expr("array(hit.pos div step, hit.pos div step - 1)")))
        .where(own)
        .withColumn("held", held)
        .withColumn("words", F.array_distinct(F.transform("held", lambda h: h["rank"])))
    )
    # Words from the probed one on, in the common order, on the block's side and on the template's.
    left = F.size(F.filter("words", lambda w: w >= F.col("first")))
    right = F.size(F.filter("set", lambda w: w >= F.col("first")))
    near = blocks.where(F.size("words") >= F.col("need")).where(F.least(left, right) >= F.col("need"))
    counted = near.withColumn("common", F.array_intersect("set", "words")).where(F.size("common") >= F.col("need"))
    # The same pair comes from every prefix word and place; the rarest word's first place stands for all.
    first_place = F.array_min(F.transform(F.filter("held", lambda h: h["rank"] == F.col("first")), lambda h: h["pos"]))
    once = counted.where((F.element_at("common", 1) == F.col("first")) & (first_place == F.col("hit.pos")))
    follows = lambda h: F.forall(
        F.sequence(F.lit(0), F.size("sequence") - 1),
        lambda k: F.array_contains(
            "held", F.struct((h["pos"] + k).alias("pos"), F.get("sequence", k).alias("rank"))
        ),
    )
    begins = F.filter("held", lambda h: (h["pos"] < (F.col("block") + 1) * F.col("step")) & follows(h))
    places = F.when(F.col("phrase"), F.transform(begins, lambda h: h["pos"]))
    return once.select(
        "rid", "template", "label", "phrase", (F.size("common") / F.size("set")).alias("share"), places.alias("places")
    ).where("NOT phrase OR size(places) > 0")


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """One row per document: words, base places and labels, all labels, score."""
    vocabulary = sorted({w for t in templates for w in t.words})
    segments = materialize(known_words(docs.select("doc_id", "text"), vocabulary), "license-words")
    found = matches(segments, templates, word_counts(segments, vocabulary))
    base = F.when(F.col("phrase"), F.col("label"))
    by_row = found.groupBy("rid").agg(
        F.sum(F.size("places").cast("long")).alias("n_base"),
        F.min(F.array_min("places")).alias("first_word"),
        F.max(F.array_max("places")).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("share").alias("score"),
    )
    none = {"n_base": 0, "base_labels": "", "labels": "", "score": 0.0}
    return (
        segments.where("segment = 0")
        .select("rid", "doc_id", "n_words")
        .join(by_row, "rid", "left")
        .fillna(none)
        .select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    )


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents"))


def _sql_rows() -> str:
    rows = []
    for n, t in enumerate(TEMPLATES):
        words = ", ".join(f"'{w}'" for w in sorted(t.words))
        sequence = ", ".join(f"'{w}'" for w in t.sequence)
        rows.append(f"({n}, '{t.label}', {str(t.phrase).lower()}, {t.step}, {t.need}, [{words}], [{sequence}])")
    return ",\n  ".join(rows)


# Every block against every template, without filters.
ORACLE_SQL = f"""
WITH templates(template, label, phrase, step, need, words, sequence) AS (VALUES
  {_sql_rows()}),
docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
placed AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos, w FROM docs),
vocabulary AS (SELECT DISTINCT unnest(words) AS word FROM templates),
known AS (SELECT placed.* FROM placed JOIN vocabulary USING (word)),
member AS (SELECT template, step, unnest(words) AS word FROM templates),
contained AS (
  SELECT rid, template, block, count(DISTINCT word) AS common
  FROM (SELECT rid, template, word, unnest([pos // step, pos // step - 1]) AS block FROM known JOIN member USING (word))
  WHERE block >= 0 GROUP BY rid, template, block),
places AS (
  SELECT rid, label, pos FROM known JOIN templates ON phrase AND known.word = sequence[1]
  WHERE w[pos + 1 : pos + len(sequence)] = sequence),
found AS (
  SELECT rid, label, NULL AS pos, common / len(words) AS share FROM contained JOIN templates USING (template)
  WHERE NOT phrase AND common >= need
  UNION ALL SELECT rid, label, pos, 1.0 FROM places),
summed AS (
  SELECT rid, count(pos) AS n_base, min(pos) AS first_word, max(pos) AS last_word,
    array_to_string(list_sort(list(DISTINCT label) FILTER (pos IS NOT NULL)), ',') AS base_labels,
    array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(share) AS score
  FROM found GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM docs LEFT JOIN summed USING (rid)
"""
