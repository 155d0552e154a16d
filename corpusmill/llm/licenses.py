"""License scans: phrases in place, and an exact set-similarity join of text blocks with license templates.

DataFrame functions only.  A template is the set of words of a notice; a block is a line of a text and,
as notices are wrapped, the words after it: as many as the template has, and half as many for what stands
between its lines.  A block carries a template's label if it has at least CONTAINED of the template's
words.  Template words are ordered by how often the whole corpus has them.  A block that reaches the threshold must have one of the
template's rarest words, so texts and templates are joined on those alone (prefix filter: as many words as may be
missing, and one); each place of such a word leads to the blocks that hold it.  The block must have enough words
at all (length filter), and, from the word on which it was joined, block and template must both have enough
words left (positional filter).  Survivors are verified by intersection.

Templates are a table (label, wording) of any length: the plan is the same however many they are.
Texts are never gathered into blocks: words are streamed through the join with their places, and a block is cut
where a rare word was met.  Templates are broadcast in portions of at most BROADCAST words, a join each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.store import written

#: share of a template's words that a block must have, in hundredths
CONTAINED = 90
#: words that the templates of one portion hold, a template's counted once for each of its rarest words
BROADCAST = 4_000_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: stands for the end of a line among the words of a lowered text, which has no such letter; \x4E is kept when cutting
_END, _BETWEEN_OR_END = "N", r"[\x00-\x2F\x3A-\x4D\x4F-\x60\x7B-\x7F]+"

#: Phrases of consecutive words and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Labels and the wording of common license notices.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by", "this work is licensed under a creative commons attribution international license"),
    ("cc", "licensed under cc by 4 0"),
    ("cc", "licensed under cc by 3 0"),
    ("cc", "this work is licensed under a creative commons license"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("bsl", "distributed under the boost software license version 1 0"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
    ("cddl", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("ofl", "this font software is licensed under the sil open font license version 1 1"),
    ("odbl", "this database is made available under the open database license"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
)


def lowered(text: Column) -> Column:
    """text, null as empty, with A-Z as a-z.

    Other letters may be lowered too: that changes no word's place, and the two characters whose
    lower form would be an ASCII letter (dotted I, Kelvin) are kept.
    """
    text = F.coalesce(text, F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    odd = text.contains("\u0130") | text.contains("\u212a")
    return F.when(odd, F.translate(text, upper, upper.lower())).otherwise(F.lower(text))


def words(text: Column) -> Column:
    """The words of a lowered text. Cutting between words costs less than half of finding them."""
    return F.array_remove(F.split(text, _BETWEEN), "")


def as_table(spark: SparkSession, templates: tuple = TEMPLATES) -> DataFrame:
    """(label, wording) of templates given in Python."""
    return spark.createDataFrame(list(templates), "label string, wording string")


def template_sets(templates: DataFrame) -> DataFrame:
    """(label, own, need, after): a template's distinct words, how many of them a block must have, and how many words after a line belong to its block.

    Repeated templates count once; those without a label or without words are left out.
    """
    cut = templates.select("label", words(lowered(F.col("wording"))).alias("w"))
    sets = cut.select("label", F.array_sort(F.array_distinct("w")).alias("own"), F.floor(F.size("w") * 3 / 2).cast("int").alias("after"))
    sets = sets.filter(F.col("label").isNotNull() & (F.size("own") > 0)).distinct()
    return sets.select("label", "own", F.ceil(F.size("own") * CONTAINED / 100).cast("int").alias("need"), "after")


def word_order(docs: DataFrame, sets: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): the templates' words and how often the corpus has them. Texts' words meet them before they are counted, in parts first."""
    vocabulary = sets.select(F.explode("own").alias("word")).distinct()
    found = docs.select(F.explode_outer(words(lowered(F.col(text)))).alias("word")).join(vocabulary, "word", "left_semi")
    often = found.groupBy("word").agg(F.count("*").alias("n"))
    return vocabulary.join(often, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n"))


def _places(w: Column) -> Column:
    """(start, label) of every place where a phrase's words stand consecutively, in order of their last words."""

    def at(x, i):
        found = None
        for phrase, label in PHRASES:
            parts = phrase.split()
            same = x == parts[-1]
            for back, part in enumerate(reversed(parts[:-1]), 1):
                same = same & (i >= back) & (F.get(w, i - back) == part)
            value = F.struct((i - (len(parts) - 1)).cast("long").alias("start"), F.lit(label).alias("label"))
            found = F.when(same, value) if found is None else found.when(same, value)
        return found

    return F.filter(F.transform(w, at), lambda p: p.isNotNull())


def _after(text: str) -> int:
    """How many words after a line belong to its block for a template."""
    return len(text.split()) * 3 // 2


def _prefixes(sets: DataFrame, known: Column) -> DataFrame:
    """(prefix, label, own, need, after, left): a row a prefix word of each template, with how many of its words are left from there on. Of templates and all template words, rarest first."""
    ranked = sets.select("label", F.array_intersect(known, F.col("own")).alias("own"), "need", "after")
    first = F.slice("own", F.lit(1), F.size("own") - F.col("need") + 1)
    return ranked.select("label", "own", "need", "after", F.posexplode(first).alias("i", "prefix")).withColumn("left", F.size("own") - F.col("i"))


def _lined(rows: DataFrame) -> DataFrame:
    """(key, v, starts, line): a lowered text's words, the places in them where lines begin (and the end), and each word's line."""
    marked = F.regexp_replace("low", "\n" + _BETWEEN[:-1] + "*+", f" {_END} ")
    cut = rows.select("key", F.array_remove(F.split(marked, _BETWEEN_OR_END), "").alias("w"))
    ends = F.filter(F.transform("w", lambda x, i: F.when(x == _END, i)), lambda p: p.isNotNull())
    parted = cut.select("key", F.array_remove("w", _END).alias("v"), ends.alias("ends"))
    # before the i-th end stand i others, which are no words
    starts = F.concat(F.array(F.lit(0)), F.transform("ends", lambda e, i: e - i), F.array(F.size("v")))
    begun = parted.select("key", "v", starts.alias("starts"))
    line = F.flatten(F.transform("starts", lambda s, i: F.array_repeat(i, F.coalesce(F.get("starts", i + 1) - s, F.lit(0)))))
    return begun.select("key", "v", "starts", line.alias("line"))


def matches(rows: DataFrame, sets: DataFrame, order: DataFrame) -> DataFrame:
    """(key, labels, score) of rows (key, low): the distinct labels of the templates that lowered texts contain, and the largest containment; keys without a match have no row. sets and order are those of template_sets and word_order."""
    by_rank = order.agg(F.array_sort(F.collect_list(F.struct("n", "word"))).alias("all"))
    known = by_rank.select(F.transform("all", lambda x: x["word"])).scalar()
    weight = sets.agg(F.sum(F.size("own") * (F.size("own") - F.col("need") + 1))).first()[0] or 0
    n = -(-weight // BROADCAST) or 1
    portion = F.pmod(F.xxhash64("label", "own"), F.lit(n))
    met = [_met(rows, _prefixes(sets.filter(portion == i), known), known) for i in range(n)]
    found = reduce(DataFrame.unionAll, met)
    return found.groupBy("key").agg(F.collect_set("label").alias("labels"), F.max("score").alias("score"))


def _met(rows: DataFrame, prefixes: DataFrame, known: Column) -> DataFrame:
    """(key, label, score) of every block that has enough of a template's words, met on one of its rarest."""
    # outer, as the optimizer would otherwise cut each text twice, once to see whether it has words
    spread = _lined(rows).select("key", "v", "starts", "line", F.posexplode_outer("v").alias("at", "prefix"))
    joined = spread.join(F.broadcast(prefixes), "prefix")
    # the lines from the first one whose block reaches the place to the one that has it
    reach = F.sequence(F.get("line", F.greatest(F.col("at") - F.col("after"), F.lit(0))), F.get("line", F.col("at")))
    lines = joined.select("key", "v", "starts", "label", "own", "need", "after", "left", "prefix", F.explode(reach).alias("l"))
    start = F.get("starts", F.col("l"))
    block = F.slice("v", start + 1, F.get("starts", F.col("l") + 1) - start + F.col("after"))
    blocks = lines.select("key", "label", "own", "need", "left", "prefix", block.alias("block")).filter((F.size("block") >= F.col("need")) & (F.col("left") >= F.col("need")))
    ranked = blocks.withColumn("ranked", F.array_intersect(known, F.col("block")))
    behind = F.size("ranked") - F.array_position("ranked", F.col("prefix")) + 1
    common = ranked.filter(behind >= F.col("need")).select("key", "label", "need", F.size("own").alias("size"), F.size(F.array_intersect("own", "block")).alias("common"))
    return common.filter("common >= need").select("key", "label", (F.col("common") / F.col("size")).alias("score"))


def _gate(low: Column) -> Column:
    """Whether a text may hold a phrase: for each phrase it must have one of its words, the one that most phrases share."""
    often = lambda w: sum(w in p.split() for p, _ in PHRASES)
    gates = sorted({max(p.split(), key=lambda w: (often(w), len(w), w)) for p, _ in PHRASES})
    return reduce(Column.__or__, [F.contains(low, F.lit(g)) for g in gates])


def licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: DataFrame | None = None) -> DataFrame:
    """One row a document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    templates is a table (label, wording); without one, TEMPLATES are taken.

    n_base counts the places of the phrases; first_word and last_word are their smallest and largest
    start, null without a place.  base_labels are the phrases' labels, labels those and the matched
    templates'; distinct, sorted, comma-joined.  score is 1 with a base place, otherwise the largest
    containment that reaches the threshold, otherwise 0.  Null text counts as empty; equal rows get equal
    results; other columns are not carried; an empty table gives an empty table.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), lowered(F.col(text)).alias("low")).withColumn("key", F.md5("low"))
    sets = written(template_sets(as_table(docs.sparkSession) if templates is None else templates), "templates")
    found = matches(rows, sets, written(word_order(docs, sets, text), "order"))
    none = F.array().cast("array<struct<start:bigint,label:string>>")
    based = rows.withColumn("w", words(F.col("low"))).select("doc_id", "key", F.size("w").cast("long").alias("n_words"), F.when(_gate(F.col("low")), _places(F.col("w"))).otherwise(none).alias("places"))
    starts = F.transform("places", lambda p: p["start"])
    base = F.transform("places", lambda p: p["label"])
    named = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    return based.join(found, "key", "left").select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        named(base).alias("base_labels"),
        named(F.concat(base, F.coalesce("labels", F.array().cast("array<string>")))).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("score", F.lit(0.0))).alias("score"),
    )


def oracle() -> str:
    """The same rows in DuckDB SQL, without any filter: every line's block against every template."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    templates = ", ".join(f"{{'label': '{label}', 'own': [{', '.join(repr(w) for w in sorted(set(t.split())))}], 'after': {_after(t)}}}" for label, t in TEMPLATES)
    phrase = []
    for p, label in PHRASES:
        parts = p.split()
        phrase.append(f"[{{'start': i - 1, 'label': '{label}'}} for i in range(1, len(w) - {len(parts) - 2}) if " + " and ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(parts)) + "]")
    return f"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, low, regexp_extract_all(low, '{WORD}') AS w
  FROM (SELECT doc_id, translate(coalesce(text, ''), '{upper}', '{upper.lower()}') AS low FROM documents)),
placed AS (SELECT r, doc_id, low, w, {' || '.join(phrase)} AS places FROM split),
sized AS (SELECT r, w, [len(regexp_extract_all(x, '{WORD}')) for x in string_split(low, chr(10))] AS sizes FROM placed),
numbered AS (SELECT r, w, sizes, unnest(range(1, len(sizes) + 1)) AS i FROM sized),
lines AS (SELECT r, w, sizes[i] AS n, coalesce(list_sum(sizes[1 : i - 1]), 0)::BIGINT AS start FROM numbered WHERE sizes[i] > 0),
templates AS (SELECT unnest([{templates}], recursive := true)),
matched AS (
  SELECT r, label, len(list_intersect(w[start + 1 : start + n + after], own)) / len(own)::DOUBLE AS score FROM lines, templates
  WHERE len(list_intersect(w[start + 1 : start + n + after], own)) * 100 >= {CONTAINED} * len(own)),
best AS (SELECT r, list(label) AS labels, max(score) AS score FROM matched GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, len(places)::BIGINT AS n_base,
  list_min([p.start for p in places])::BIGINT AS first_word, list_max([p.start for p in places])::BIGINT AS last_word,
  array_to_string(list_sort(list_distinct([p.label for p in places])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct([p.label for p in places] || coalesce(labels, []))), ',') AS labels,
  CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(best.score, 0.0)::DOUBLE END AS score
FROM placed LEFT JOIN best USING (r)"""
