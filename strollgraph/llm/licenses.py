"""Licence scans: Dice coefficient over word bigrams.

Texts and licence templates are normalised the same way and become sets of word bigrams.  The units compared are the whole text, its
paragraphs and its lines.  A unit of n bigrams reaches the coefficient t only with templates of t n / (2 - t) to (2 - t) n / t
bigrams, so the sizes name the few templates that are intersected with it.

Before any set is built, signal words prune: a unit that reaches t holds at least the share t / (2 - t) of a template's bigrams,
and the signal words of a template touch more bigrams than it may miss.  A unit without any signal word matches nothing.

Everything is column expressions in one pass over the text: no shuffle, and nothing grows but the output.
"""

from __future__ import annotations

from dataclasses import dataclass
import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Licence notices (fixed values, public standard wordings).
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions:",
        "SPDX-License-Identifier: MIT",
    ),
    "BSD-3-Clause": (
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-only",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related rights to this work.",),
}
THRESHOLD = 0.8

_GAP = r"[^\p{L}\p{N}]+"


@dataclass(frozen=True)
class Template:
    licence: str
    bigrams: tuple[str, ...]


def template(licence: str, text: str) -> Template:
    words = [w for w in re.sub(r"[\W_]+", " ", text.lower()).split(" ") if w]
    return Template(licence, tuple(sorted({f"{a} {b}" for a, b in zip(words, words[1:])})))


def load(templates: dict[str, tuple[str, ...]] = TEMPLATES) -> list[Template]:
    return [template(name, text) for name, texts in templates.items() for text in texts]


def size_bounds(n: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Sizes of sets whose Dice coefficient with a set of ``n`` can reach the threshold."""
    return math.ceil(threshold * n / (2 - threshold) - 1e-9), math.floor((2 - threshold) * n / threshold + 1e-9)


def signal_words(templates: list[Template], threshold: float = THRESHOLD) -> list[str]:
    """Words of which every unit that reaches the threshold holds at least one; long words first, shared ones preferred."""
    chosen: set[str] = set()
    touched = lambda t: sum(bool(set(b.split(" ")) & chosen) for b in t.bigrams)
    for t in templates:
        may_miss = len(t.bigrams) - size_bounds(len(t.bigrams), threshold)[0]
        for word in sorted({w for b in t.bigrams for w in b.split(" ")}, key=lambda w: (-len(w), w)):
            if touched(t) > may_miss:
                break
            chosen.add(word)
    return sorted(chosen)


def _bigrams(plain: Column) -> Column:
    """Distinct word bigrams of a normalised text."""
    words = F.array(F.filter(F.split(plain, " "), lambda w: w != ""))
    return F.transform(words, lambda ws: F.array_distinct(F.transform(
        F.slice(ws, 1, F.greatest(F.size(ws) - 1, F.lit(0))), lambda w, i: F.concat_ws(" ", w, F.get(ws, i + 1))
    )))[0]


def scan(docs: DataFrame, templates: list[Template] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, matches`` for every row of ``docs`` (doc_id, text).

    ``matches`` lists (dice, kind, number, licence): kind 0 is the whole text, 1 a paragraph (between empty lines), 2 a line, with numbers from 0;
    every template that the unit reaches is listed, in that order of units and of the templates.  A null or empty text and
    one without two words match nothing.  Equal texts match alike; repeated rows are all returned.
    """
    templates = load() if templates is None else templates
    signal = r"(?<![\p{L}\p{N}])(?:" + "|".join(map(re.escape, signal_words(templates, threshold))) + r")(?![\p{L}\p{N}])"

    def matches(bigrams: Column, kind: Column, number: Column) -> Column:
        n, tests = F.size(bigrams), []
        for t in templates:
            low, high = size_bounds(len(t.bigrams), threshold)
            both = F.size(F.array_intersect(bigrams, F.array(*[F.lit(b) for b in t.bigrams])))
            dice = F.when((n >= low) & (n <= high), 2 * both / (n + len(t.bigrams)))
            tests.append(F.struct(dice.alias("dice"), kind.alias("kind"), number.cast("int").alias("number"), F.lit(t.licence).alias("licence")))
        return F.filter(F.array(*tests), lambda m: m["dice"] >= threshold - 1e-9)

    def numbered(parts: Column, kind: int) -> Column:
        return F.transform(parts, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("number"), x.alias("unit")))

    def units(text: Column) -> Column:
        parts = [F.array(text), F.split(text, "\n[\\x20\\x09-\\x0D]*\n"), F.split(text, "\n")]
        held = [F.filter(numbered(p, kind), lambda u: u["unit"].rlike(signal)) for kind, p in enumerate(parts)]
        return F.flatten(F.transform(
            F.concat(*held),
            lambda u: F.transform(
                F.array(_bigrams(F.regexp_replace(u["unit"], _GAP, " "))), lambda b: matches(b, u["kind"], u["number"])
            )[0],
        ))

    lower = docs.select("doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("_lower"))
    none = "array<struct<dice:double,kind:int,number:int,licence:string>>"
    return lower.select("doc_id", F.when(F.col("_lower").rlike(signal), units(F.col("_lower"))).otherwise(F.array().cast(none)).alias("matches"))


def best_match(matches: Column) -> Column:
    """The highest coefficient; of equal ones the earlier kind of unit, the earlier unit, the first licence."""
    ranked = F.transform(matches, lambda m: F.struct(
        (-m["dice"]).alias("dice"), m["kind"].alias("kind"), m["number"].alias("number"), m["licence"].alias("licence")
    ))
    return F.array_min(ranked)


def scan_sql(templates: list[Template] | None = None, threshold: float = THRESHOLD) -> str:
    """The query op1 in DuckDB's SQL, without pruning."""
    templates = load() if templates is None else templates
    listed = ", ".join(f"({i}, '{t.licence}', {len(t.bigrams)}, '{b}')" for i, t in enumerate(templates) for b in t.bigrams)
    return rf"""
WITH t(id, licence, size, bigram) AS (VALUES {listed}),
raw AS (
  SELECT doc_id, 0 AS kind, 0 AS number, lower(text) AS unit FROM documents
  UNION ALL
  SELECT doc_id, 1, unnest(range(len(p)))::INT, unnest(p)
  FROM (SELECT doc_id, regexp_split_to_array(lower(text), '\n[\x20\x09-\x0D]*\n') AS p FROM documents)
  UNION ALL
  SELECT doc_id, 2, unnest(range(len(p)))::INT, unnest(p) FROM (SELECT doc_id, string_split(lower(text), chr(10)) AS p FROM documents)
), w AS (
  SELECT doc_id, kind, number, list_filter(string_split(regexp_replace(unit, '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda x: x <> '') AS ws FROM raw
), b AS (
  SELECT doc_id, kind, number, list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS bs FROM w WHERE len(ws) > 1
), one AS (
  SELECT doc_id, kind, number, len(bs) AS n, unnest(bs) AS bigram FROM b
), m AS (
  SELECT doc_id, kind, number, id, licence, 2.0::DOUBLE * count(*) / (n + size) AS dice
  FROM one JOIN t USING (bigram) GROUP BY doc_id, kind, number, id, licence, n, size
), k AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, kind, number, licence) AS r, count(*) OVER (PARTITION BY doc_id) AS n_matches
  FROM m WHERE dice >= {threshold} - 1e-9
)
SELECT d.doc_id, coalesce(n_matches, 0)::BIGINT AS n_matches, licence, round(dice, 6) AS dice, kind::INT AS kind, number::INT AS number
FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id AND r = 1
"""
