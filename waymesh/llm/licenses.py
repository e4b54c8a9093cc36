"""License scans by diagonal voting, in DataFrame operations only.

Every rolling k-gram of a text's words is looked up among the k-grams of the license templates
(a fixed table of some hundred rows, up to a few thousand, which is a literal of the plan). A hit votes for the diagonal
text position - template position. Diagonals of one template that lie within `slack` of each other
are merged (words may be missing or added), and a merged span is verified: the distinct template
positions hit must reach `least` of the template's k-grams. Hits are of the words themselves, so that
no collision of hashes counts.

A row is worked on by itself: its words are cut once, its hits sorted by template and diagonal and
cut into runs, which takes n log n steps for n hits. Nothing is exchanged or joined.

Words are runs of letters and digits (ASCII ones lower-cased, all other characters above 127 count
as letters). Base phrases are found by direct comparison of consecutive words.

Defined cases: null text counts as empty, with no words, no places and score 0; texts shorter than k
words have no k-gram; overlapping phrases all count; repeated rows give repeated rows (spans() names
a span of such rows once); rows with a null id are kept; extra columns pass through in scan(); of a
long text its words and its hits are held, never a copy of all words with each of them.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# said by what the class holds: cutting words by the negated class of all other ASCII takes Java 3.7 times as long
WORD = "[0-9A-Za-z\x80-\U0010FFFF]+"
K = 3

# Phrases and their labels.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# Well-known license notices (label, notice).
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit", "In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the Software"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("gpl", "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
]


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words of a text, with A-Z lower-cased and no other letter."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    # lower() has a fast way for ASCII, where it is the same
    lowered = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def template_grams(templates: list[tuple[str, str]] = TEMPLATES, k: int = K) -> list[tuple[int, str, int, str, int]]:
    """(template, label, position, k-gram, k-grams of the template)."""
    out = []
    for t, (label, notice) in enumerate(templates):
        w = re.findall(WORD, notice.lower())
        out += [(t, label, i, " ".join(w[i : i + k]), len(w) - k + 1) for i in range(len(w) - k + 1)]
    return out


def phrase_places(words: Column, phrase: str) -> Column:
    """Start positions (from 0) of a phrase's words standing consecutively."""
    parts = phrase.split()

    def at(w: Column, i: Column) -> Column:
        hit = w == parts[0]
        for k, p in enumerate(parts[1:], 1):
            hit = hit & F.coalesce(F.get(words, i + k) == p, F.lit(False))
        return F.when(hit, i.cast("long"))

    places = F.filter(F.transform(words, at), lambda x: x.isNotNull())
    return F.when(F.array_contains(words, parts[0]), places).otherwise(F.array().cast("array<bigint>"))


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once a row, however often f names it (also inside lambdas)."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def indices(items: Column, holds: Callable[[Column, Column], Column]) -> Column:
    """The indices (from 0) of the elements for which holds(element, index) is true."""
    return F.array_remove(F.transform(items, lambda x, i: F.when(holds(x, i), i).otherwise(F.lit(-1))), F.lit(-1))


def template_hits(words: Column, templates: list[tuple[str, str]] = TEMPLATES, k: int = K) -> Column:
    """Hits of the words' k-grams in the templates' ones (template, diagonal, t_pos, pos), in this order."""
    rows: dict[str, list[str]] = {}
    for t, _, i, gram, _ in template_grams(templates, k):
        rows.setdefault(gram, []).append(f"named_struct('template', {t}, 't_pos', {i})")
    if not rows:
        return F.expr("cast(array() as array<struct<template: int, diagonal: int, t_pos: int, pos: int>>)")
    # one hash set of k-grams decides; those of first and last words only spare most places building theirs
    first, last = ({g.split(" ")[j] for g in rows} for j in (0, -1))
    table = F.expr("map(" + ", ".join(f"'{gram}', array({', '.join(at)})" for gram, at in rows.items()) + ")")
    gram = lambda i: F.array_join(F.slice(words, i + 1, F.lit(k)), " ")
    places = indices(words, lambda w, i: w.isin(first) & F.get(words, i + (k - 1)).isin(last) & gram(i).isin(list(rows)))

    def of(pos: Column) -> Column:
        return F.transform(F.element_at(table, gram(pos)), lambda at: F.struct(at["template"].alias("template"), (pos - at["t_pos"]).alias("diagonal"), at["t_pos"].alias("t_pos"), pos.alias("pos")))

    return F.array_sort(F.flatten(F.transform(places, of)))


def spans_of(words: Column, templates: list[tuple[str, str]] = TEMPLATES, k: int = K, slack: int = 3, least: float = 0.5) -> Column:
    """The verified spans of license text in a text's words: array of label, template, first_word, last_word, share."""
    labels = F.lit([label for label, _ in templates]).cast("array<string>")
    n_grams = F.lit([len(re.findall(WORD, notice)) - k + 1 for _, notice in templates]).cast("array<int>")

    def span(run: Column) -> Column:
        template = F.get(run, F.lit(0))["template"]
        pos = F.transform(run, lambda h: h["pos"])
        # a run of neighbouring diagonals is merged by the distinct template positions it covers
        votes = F.size(F.array_distinct(F.transform(run, lambda h: h["t_pos"])))
        return F.struct(
            F.get(labels, template).alias("label"), template.alias("template"), F.array_min(pos).cast("long").alias("first_word"),
            (F.array_max(pos) + (k - 1)).cast("long").alias("last_word"), (votes / F.get(n_grams, template)).alias("share"),
        )

    def merged(hits: Column) -> Column:
        def fresh(h: Column, i: Column) -> Column:
            before = F.get(hits, i - 1)
            return (i == 0) | (h["template"] != before["template"]) | (h["diagonal"] - before["diagonal"] > slack)

        runs = lambda starts: F.transform(starts, lambda s, j: F.slice(hits, s + 1, F.coalesce(F.get(starts, j + 1), F.size(hits)) - s))
        return F.transform(let(indices(hits, fresh), runs), span)

    return F.filter(let(template_hits(words, templates, k), merged), lambda s: s["share"] >= least)


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] = TEMPLATES, k: int = K, slack: int = 3, least: float = 0.5) -> DataFrame:
    """id, text_hash, label, template, first_word, last_word, share: the verified spans of license text."""
    found = let(words_of(F.col(text_col)), lambda w: spans_of(w, templates, k, slack, least))
    # explode_outer: explode would have the spans found a second time, in a filter below it
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.explode_outer(found).alias("span"))
    return rows.filter(F.col("span").isNotNull()).select("id", "text_hash", "span.*").distinct()


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs with n_words, n_base, first_word, last_word, base_labels, labels and license_score added."""
    added = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "license_score"]
    base = docs.drop(*added) if set(added) & set(docs.columns) else docs

    def found(words: Column) -> Column:
        places = F.array(*[phrase_places(words, phrase) for phrase, _ in PHRASES])
        return F.struct(F.size(words).cast("long").alias("n_words"), places.alias("places"), spans_of(words, **options).alias("spans"))

    base = base.withColumn("__wm_found", let(words_of(F.col(text_col)), found))
    every = F.flatten("__wm_found.places")
    named = F.array_compact(F.array(*[F.when(F.size(F.col("__wm_found.places")[j]) > 0, F.lit(label)) for j, (_, label) in enumerate(PHRASES)]))
    both = F.array_sort(F.array_union(named, F.transform("__wm_found.spans", lambda s: s["label"])))
    share = F.array_max(F.transform("__wm_found.spans", lambda s: s["share"]))
    return base.withColumns(
        {
            "n_words": F.col("__wm_found.n_words"),
            "n_base": F.size(every).cast("long"),
            "first_word": F.array_min(every),
            "last_word": F.array_max(every),
            "base_labels": F.array_join(F.array_sort(F.array_distinct(named)), ","),
            "labels": F.array_join(both, ","),
            "license_score": F.when(F.size(every) > 0, 1.0).otherwise(F.coalesce(share, F.lit(0.0))),
        }
    ).drop("__wm_found")


def oracle(k: int = K, slack: int = 3, least: float = 0.5) -> str:
    """The same result as DuckDB SQL, by plain SQL over the words."""
    grams = ", ".join(f"({t}, '{label}', {i}, '{g}', {n})" for t, label, i, g, n in template_grams(k=k))
    hit = lambda phrase: " AND ".join(f"words[i + {1 + j}] = '{w}'" for j, w in enumerate(phrase.split()))
    places = " || ".join(f"list_filter(range(len(words)), lambda i: coalesce({hit(p)}, false))" for p, _ in PHRASES)
    labels = ", ".join(f"CASE WHEN len(list_filter(range(len(words)), lambda i: coalesce({hit(p)}, false))) > 0 THEN '{label}' END" for p, label in PHRASES)
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words, row_number() OVER () AS r FROM documents),
g(template, label, t_pos, gram, n_grams) AS (VALUES {grams}),
p AS (SELECT r, words, unnest(range(len(words) - {k - 1})) AS pos FROM d WHERE len(words) >= {k}),
h AS (SELECT r, template, label, n_grams, pos - t_pos AS diagonal, t_pos FROM p JOIN g ON {" || ' ' || ".join(f"words[pos + {1 + j}]" for j in range(k))} = gram),
u AS (SELECT DISTINCT r, template, label, n_grams, diagonal FROM h),
s AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER w <= {slack} THEN 0 ELSE 1 END AS fresh FROM u WINDOW w AS (PARTITION BY r, template ORDER BY diagonal)),
q AS (SELECT *, sum(fresh) OVER (PARTITION BY r, template ORDER BY diagonal) AS run FROM s),
m AS (SELECT q.r, q.label, count(DISTINCT t_pos) / max(q.n_grams) AS share FROM q JOIN h USING (r, template, diagonal) GROUP BY q.r, q.template, q.label, q.run HAVING count(DISTINCT t_pos) / max(q.n_grams) >= {least}),
f AS (SELECT r, list(DISTINCT label) AS found, max(share) AS share FROM m GROUP BY r),
b AS (SELECT r, doc_id, len(words) AS n_words, {places} AS spots, list_filter([{labels}], lambda x: x IS NOT NULL) AS base FROM d)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(spots) AS BIGINT) AS n_base, list_min(spots) AS first_word, list_max(spots) AS last_word,
  array_to_string(list_sort(base), ',') AS base_labels, array_to_string(list_sort(list_distinct(base || coalesce(found, []))), ',') AS labels,
  CASE WHEN len(base) > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM b LEFT JOIN f USING (r)"""
