"""License scans: phrases, and an exact set-similarity join of text blocks with license templates.

All of it is DataFrame expressions. A text is a row of words. For templates of up to ``S`` words (``S`` a power
of two) its blocks are ``2 * S`` words long, one every ``S`` words, so each copy of a template lies inside one
block. A block matches a template if it holds at least ``CONTAINMENT`` of the template's distinct words. The
join finds every such pair:

- tokens are the templates' words, in one global order, rarest first, by the number of all documents that hold them
  (a word of no template never counts, so a block keeps only the others, in that order);
- prefix filter: with ``need`` common words required, a pair shares a word among the first ``|T| - need + 1`` of the template
  and the first ``|B| - need + 1`` of the block, so only those are joined;
- length filter: a block with fewer than ``need`` words of templates is dropped;
- positional filter: words before and behind the places of the shared word must suffice for ``need``;
- a pair is counted at its first common word alone, and there the whole overlap is counted. Nothing is grouped.

Documents without any prefix word are left at the first test. Templates are a parameter, at most ``MOST_WORDS`` words
of them (an error beyond); their prefixes are the one table that is broadcast. The narrow rows between the two passes are
staged, which also gives repeated rows and null ids keys of their own.

Defined results: null texts are empty and have no words, no places, score 0; a text of any length is cut into blocks
whole; repeated rows are judged alike, each kept; null ids are kept; other columns are ignored whatever their names;
equal containments of one label are one label; an empty table gives an empty result.
"""

import re
import string

from pyspark.sql import functions as F

from flowcast.llm.frames import texts
from flowcast.sources.staging import stage

CONTAINMENT = (4, 5)
MOST_WORDS = 100_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases whose words in a row make a base place, with their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Public license notices, the wording that is searched.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
                   "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
            "as published by the Free Software Foundation"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
             "License as published by the Free Software Foundation"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
            "conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License."),
    ("cc0", "The person who associated a work with this deed has dedicated the work to the public domain"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]


def words_of(text):
    """Words of a template, as the expressions below cut texts."""
    return re.findall(WORD, text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)))


def need_of(size):
    """Common words that ``size`` distinct template words require."""
    part, whole = CONTAINMENT
    return -(-part * size // whole)


def size_class(words):
    """The smallest power of two that is no less than the template's length, 8 at least."""
    return max(8, 1 << (len(words) - 1).bit_length())


def lowered(text):
    """A-Z in lower case, other letters as they are."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def word_rows(docs, id_col, text_col):
    rows = texts(docs, id_col, text_col)
    return rows.select("id", F.regexp_extract_all(lowered(rows["text"]), F.lit(WORD), F.lit(0)).alias("words"))


def _literal(words):
    return F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")


def token_order(rows, templates):
    """The templates' words, rarest first by the number of rows that hold them; ties by the word."""
    vocabulary = sorted({w for _, words in templates for w in words})
    counted = rows.select(F.explode(F.array_intersect("words", _literal(vocabulary))).alias("word")).groupBy("word").count()
    found = {r["word"]: r["count"] for r in counted.collect()}  # at most one row per template word
    return sorted(vocabulary, key=lambda w: (found.get(w, 0), w))


def _places(words, spaced, phrase, label):
    """Starts of the phrase; only rows that hold it are walked."""
    parts = phrase.split(" ")
    last = F.size(words) - len(parts)

    def stands(i):
        return sum_all([F.get(words, i + k) == part for k, part in enumerate(parts)])

    found = F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), stands)
    starts = F.when(F.contains(spaced, F.lit(f" {phrase} ")), found).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(F.lit(label).alias("label"), i.cast("long").alias("start")))


def sum_all(conditions):
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _blocks(words, size, rare, order):
    """Blocks of one size class that hold a prefix word: (size class, first word, words of templates in global order)."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - size - 1, F.lit(0)), F.lit(size))
    cut = F.transform(starts, lambda i: F.struct(i.alias("start"), F.slice(words, i + 1, F.lit(2 * size)).alias("own")))
    hit = F.filter(cut, lambda b: F.arrays_overlap(b["own"], rare))
    kept = F.transform(hit, lambda b: F.struct(
        F.lit(size).alias("size_class"), b["start"].cast("long").alias("start"),
        F.array_intersect(order, b["own"]).alias("tokens")))
    empty = F.array().cast("array<struct<size_class:int,start:bigint,tokens:array<string>>>")
    return F.when(F.arrays_overlap(words, rare), kept).otherwise(empty)


def scan(docs, templates=TEMPLATES, id_col="doc_id", text_col="text"):
    """(id, n_words, places, matches) per row.

    ``places`` lists (label, start) of every base phrase; ``matches`` (label, start, words, containment) of every
    block, its first word and length, that meets a template.
    """
    spark = docs.sparkSession
    cut = [(label, words_of(text)) for label, text in templates]
    if sum(len(words) for _, words in cut) > MOST_WORDS:
        raise ValueError(f"more than {MOST_WORDS} words of templates; scan in parts")
    cut = [(label, words) for label, words in cut if words]
    rows = word_rows(docs, id_col, text_col)
    order = token_order(rows, cut)
    rank = {w: n for n, w in enumerate(order)}
    classes, entries = {}, []
    for number, (label, words) in enumerate(cut):
        tokens = sorted(set(words), key=rank.get)
        size, need = size_class(words), need_of(len(tokens))
        known = classes.setdefault(size, {"rare": set(), "tokens": set(), "need": need})
        known["tokens"] |= set(tokens)
        known["need"] = min(known["need"], need)
        for i, token in enumerate(tokens[:len(tokens) - need + 1]):
            known["rare"].add(token)
            entries.append(F.struct(
                F.lit(size).alias("t_class"), F.lit(token).alias("t_token"), F.lit(label).alias("label"), F.lit(i).alias("i"),
                F.lit(need).alias("need"), _literal(tokens).alias("t_tokens")))
    words = F.col("words")
    spaced = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    places = [_places(words, F.col("spaced"), phrase, label) for phrase, label in PHRASES.items()]
    blocks = [_blocks(words, size, _literal(sorted(c["rare"])), _literal(sorted(c["tokens"], key=rank.get)))
              for size, c in sorted(classes.items())]
    base = rows.withColumn("spaced", spaced).select(
        F.monotonically_increasing_id().alias("row_key"), "id", F.size("words").cast("long").alias("n_words"),
        F.concat(*places).alias("places"), *([F.concat(*blocks).alias("blocks")] if blocks else []))
    if not blocks:
        empty = F.array().cast("array<struct<label:string,start:bigint,words:int,containment:double>>")
        return base.select(F.col("id").alias(id_col), "n_words", "places", empty.alias("matches"))
    base = stage(base, "license")
    least = F.create_map(*[F.lit(x) for size, c in classes.items() for x in (size, c["need"])])
    block = base.select("row_key", F.inline("blocks")).withColumn("b", F.size("tokens"))
    block = block.withColumn("prefix", F.col("b") - least[F.col("size_class")] + 1).where("prefix > 0")
    prefix = block.select("row_key", "size_class", "start", "tokens", "b",
                          F.posexplode(F.slice("tokens", F.lit(1), F.col("prefix"))).alias("j", "token"))
    table = spark.range(1).select(F.inline(F.array(*entries)))
    pairs = prefix.join(F.broadcast(table), (F.col("size_class") == F.col("t_class")) & (F.col("token") == F.col("t_token")))
    pairs = pairs.where((F.col("j") <= F.col("b") - F.col("need")) & (
        F.least("i", "j") + 1 + F.least(F.size("t_tokens") - 1 - F.col("i"), F.col("b") - 1 - F.col("j")) >= F.col("need")))
    common = pairs.withColumn("common", F.array_intersect("tokens", "t_tokens"))
    found = common.where((F.size("common") >= F.col("need")) & (F.get("common", F.lit(0)) == F.col("token")))
    match = F.struct("label", "start", (2 * F.col("size_class")).alias("words"),
                     (F.size("common") / F.size("t_tokens")).alias("containment"))
    matches = found.groupBy("row_key").agg(F.array_sort(F.collect_list(match)).alias("matches"))
    empty = F.array().cast(matches.schema["matches"].dataType)
    return base.drop("blocks").join(matches, "row_key", "left").select(
        F.col("id").alias(id_col), "n_words", "places", F.coalesce("matches", empty).alias("matches"))


def digest(found, id_col="doc_id"):
    """Counts, ends, labels and a score of ``scan``'s rows: 1 for a base place, else the largest containment."""
    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    base, added = F.col("places.label"), F.col("matches.label")
    return found.select(
        id_col, "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").alias("first_word"), F.array_max("places.start").alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, added)).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max("matches.containment"), F.lit(0.0))).alias("score"))


def oracle():
    """The same in DuckDB SQL: every block against every template, without any filter."""
    def text(words):
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"

    known = [(label, words_of(t)) for label, t in TEMPLATES]
    rows = ", ".join(
        f"('{label}', {size_class(w)}, {need_of(len(set(w)))}, {text(sorted(set(w)))})" for label, w in known)
    phrases = ", ".join(f"('{label}', {text(p.split())})" for p, label in PHRASES.items())
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    return f"""WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{WORD}') AS w FROM documents),
t(label, s, need, ts) AS (VALUES {rows}), p(label, ps) AS (VALUES {phrases}),
b AS (SELECT doc_id, p.label, i - 1 AS start FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d) JOIN p
  ON w[i:i + len(ps) - 1] = ps),
k AS (SELECT doc_id, s, w[i * s + 1:i * s + 2 * s] AS own FROM (SELECT doc_id, w, s, unnest(range(0, greatest(len(w) - s - 1, 0) // s + 1)) AS i
  FROM d, (SELECT DISTINCT s FROM t))),
m AS (SELECT doc_id, label, len(list_intersect(ts, own)) / len(ts) AS c FROM k JOIN t USING (s) WHERE len(list_intersect(ts, own)) >= need),
bs AS (SELECT doc_id, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word FROM b GROUP BY 1),
bl AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS l FROM (SELECT DISTINCT doc_id, label FROM b) GROUP BY 1),
al AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS l
  FROM (SELECT doc_id, label FROM b UNION SELECT doc_id, label FROM m) GROUP BY 1),
ms AS (SELECT doc_id, max(c) AS c FROM m GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
coalesce(bl.l, '') AS base_labels, coalesce(al.l, '') AS labels,
CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(c, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN bs USING (doc_id) LEFT JOIN bl USING (doc_id) LEFT JOIN al USING (doc_id) LEFT JOIN ms USING (doc_id)"""
