"""Licence scans: notices compared with templates by Dice's coefficient over word bigrams.

A document's units are its lines, its paragraphs and itself. A unit's normalised words (letters and
digits, lower case) give a set of bigrams. Only templates whose number of bigrams allows the
threshold at all are compared; by far most units share no bigram with any template and go first.
Notices with other words around them are passages: runs of a document's words, of any length up to
the most a template allows. They are looked for only where a document holds enough of a template.
Only DataFrame functions and no shuffle: the templates are a fixed, small list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railpulse.llm.licence_texts import TEXTS

LEAST = 0.8
WORDS = r"[\p{L}\p{N}]+"

# Short notices as licences ask for them, or as they are commonly worded.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
            "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
            "furnished to do so, subject to the following conditions:"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
}
ALL = {name: [*TEMPLATES.get(name, []), *TEXTS.get(name, [])] for name in {**TEMPLATES, **TEXTS}}


def _let(value: Column, then) -> Column:
    """``then(value)``, through a list of one, so that the value is made once."""
    return F.transform(F.array(value), then)[0]


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORDS), F.lit(0))


def _pairs(text: Column) -> Column:
    return _let(_words(text), lambda words: F.when(F.size(words) < 2, words).otherwise(
        F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words)), lambda a, b: F.concat_ws(" ", a, b))))


def bigrams(text: Column) -> Column:
    """The set of word bigrams of a text; a single word is its own bigram."""
    return F.array_distinct(_pairs(text))


def _known(session, templates: dict[str, list[str]]) -> list[tuple[str, int, list[str], int]]:
    rows = [(name, i, text) for name, texts in templates.items() for i, text in enumerate(texts)]
    found = session.createDataFrame(rows, "licence string, no int, text string").select(
        "licence", "no", bigrams(F.col("text")).alias("grams"), F.size(_pairs(F.col("text"))).alias("spread"))
    return [(r.licence, r.no, r.grams, r.spread) for r in found.orderBy("licence", "no").collect()]


def units(docs: DataFrame) -> DataFrame:
    """``doc_id, kind, unit_no, grams`` of the lines, paragraphs and whole texts.

    Bigrams are made before the units become rows, so that no later filter makes them again.
    """
    def unit(kind: str, no: Column, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), no.alias("unit_no"), bigrams(text).alias("grams"))

    lines = F.transform(F.split("text", "\n"), lambda x, i: unit("line", i, x))
    paragraphs = F.when(F.col("text").rlike(r"\n[ \t\r]*\n"), F.transform(
        F.split("text", r"\n[ \t\r]*\n"), lambda x, i: unit("paragraph", i, x)))
    whole = F.when(F.contains("text", F.lit("\n")), F.transform(F.array("text"), lambda x, i: unit("text", i, x)))
    none = F.array().cast("array<struct<kind:string,unit_no:int,grams:array<string>>>")
    return docs.where("text is not null").select("doc_id", F.inline(F.concat(lines, F.coalesce(paragraphs, none), F.coalesce(whole, none))))


def _best(grams: Column, held: Column, least: float) -> Column:
    """``less`` (Dice, negated) and ``licence`` of the template nearest to a unit; null where none has a fitting size."""
    def fitting(n: Column) -> Column:
        return F.filter(held, lambda t: (n >= F.size(t["grams"]) * least / (2 - least)) & (n <= F.size(t["grams"]) * (2 - least) / least))

    return _let(F.size(grams), lambda n: F.array_min(F.transform(fitting(n), lambda t: F.struct(
        (-2.0 * F.size(F.array_intersect(grams, t["grams"])) / (n + F.size(t["grams"]))).alias("less"), t["licence"].alias("licence")))))


def _matched(pieces: Column, held: Column, least: float) -> Column:
    """``less, licence, start, stop`` of the pieces of a text that match as a whole; places count the text's words."""
    scored = F.transform(pieces, lambda x, i: F.struct(_best(bigrams(x), held, least).alias("best"), i.alias("no"), F.size(_words(x)).alias("n")))
    before = lambda all_, i: F.aggregate(F.slice(all_, 1, i), F.lit(0), lambda a, x: a + x["n"])
    return _let(scored, lambda all_: F.transform(
        F.filter(all_, lambda x: F.coalesce(x["best"]["less"] <= -least, F.lit(False))),
        lambda x: _let(before(all_, x["no"]), lambda start: F.struct(
            x["best"]["less"].alias("less"), x["best"]["licence"].alias("licence"), start.alias("start"), (start + x["n"] - 1).alias("stop")))))


def _windows(grams: Column, t: Column, least: float) -> Column:
    """``less, longer, licence, start, stop`` of the runs of words near to a template.

    A best run starts and ends with bigrams of the template, so only these runs are scored.
    """
    need = F.ceil(F.size(t["grams"]) * least / (2 - least) - 1e-9).cast("int")
    reach = F.floor(t["spread"] * (2 - least) / least + 1e-9).cast("int")
    places = F.filter(F.transform(grams, lambda g, i: F.when(F.array_contains(t["grams"], g), i)), lambda i: i.isNotNull())

    def run(start: Column, stop: Column) -> Column:
        return _let(F.array_distinct(F.slice(grams, start + 1, stop - start + 1)), lambda held: F.struct(
            (-2.0 * F.size(F.array_intersect(held, t["grams"])) / (F.size(held) + F.size(t["grams"]))).alias("less"),
            (start - stop).alias("longer"), t["licence"].alias("licence"), start.alias("start"), (stop + 1).alias("stop")))

    def runs(at: Column) -> Column:
        ends = lambda start, k: F.filter(F.slice(at, k + need, reach), lambda stop: stop - start < reach)
        return F.flatten(F.transform(at, lambda start, k: F.transform(ends(start, k), lambda stop: run(start, stop))))

    return F.filter(_let(places, runs), lambda w: w["less"] <= -least)


def _passages(docs: DataFrame, held: Column, any_: list[str], least: float) -> DataFrame:
    """Passages: of those that overlap, the nearest (then the longest) one; none that only repeats what a unit says."""
    def possible(grams: Column) -> Column:
        return _let(F.filter(grams, lambda g: g.isin(any_)), lambda found: F.when(F.size(found) > 0, F.filter(
            held, lambda t: F.size(F.array_intersect(found, t["grams"])) >= F.size(t["grams"]) * least / (2 - least) - 1e-9)))

    # As rows of a list, so that no later filter makes them again.
    pairs = _let(_pairs(F.col("text")), lambda grams: F.struct(grams.alias("grams"), possible(grams).alias("possible")))
    near = docs.where("text is not null").select("doc_id", "text", F.inline(F.array(pairs))).where("size(possible) > 0")
    lines, paragraphs = F.split("text", "\n"), F.split("text", r"\n[ \t\r]*\n")
    found = near.select("doc_id", F.inline(F.array(F.struct(
        F.concat(*[_matched(x, held, least) for x in (lines, paragraphs, F.array("text"))]).alias("units"),
        F.array_sort(F.flatten(F.transform("possible", lambda t: _windows(F.col("grams"), t, least)))).alias("windows")))))
    meet = lambda a, b: (a["start"] <= b["stop"]) & (b["start"] <= a["stop"])
    said = lambda w: F.exists("units", lambda u: meet(u, w) & ((u["less"] <= w["less"]) | (
        (u["licence"] == w["licence"]) & (u["start"] <= w["start"]) & (w["stop"] <= u["stop"]))))
    told = found.select("doc_id", F.inline(F.array(F.struct(F.filter("windows", lambda w: ~said(w)).alias("windows")))))
    none = F.array().cast("array<struct<less:double,longer:int,licence:string,start:int,stop:int>>")
    apart = F.aggregate("windows", none, lambda kept, w: F.when(F.exists(kept, lambda k: meet(k, w)), kept).otherwise(F.concat(kept, F.array(w))))
    return told.where("size(windows) > 0").select("doc_id", F.inline(apart)).select(
        "doc_id", F.lit("passage").alias("kind"), F.col("start").alias("unit_no"), "licence", (-F.col("less")).alias("dice"))


def scan(docs: DataFrame, least: float = LEAST, templates: dict[str, list[str]] = ALL) -> DataFrame:
    """``doc_id, kind, unit_no, licence, dice``: the best licence of every unit that reaches ``least``.

    ``least`` must be above 0. Ties go to the first licence by name. Null and empty texts give no
    row; equal rows give equal rows; other columns are ignored. A unit is a ``line``, a ``paragraph``
    (where blank lines part them) or the whole ``text`` (of more than one line), numbered from 0.
    A notice with other words around it is a ``passage``, numbered by its first word; a passage is not
    listed where it meets a unit that is at least as near, or lies in one with the same licence.
    """
    known = _known(docs.sparkSession, templates)
    sizes = [len(grams) for _, _, grams, _ in known]
    # 2 * min(n, m) / (n + m) >= least bounds the size n of a unit by that of a template, m.
    low, high = min(sizes) * least / (2 - least), max(sizes) * (2 - least) / least
    any_ = sorted({g for _, _, grams, _ in known for g in grams})
    held = F.array(*[F.struct(F.lit(name).alias("licence"), F.array(*map(F.lit, grams)).alias("grams"), F.lit(spread).alias("spread"))
                     for name, _, grams, spread in known])
    seen = units(docs).withColumn("n", F.size("grams"))
    seen = seen.where((F.col("n") >= low) & (F.col("n") <= high)).where(F.exists("grams", lambda g: g.isin(any_)))
    return (seen.withColumn("best", _best(F.col("grams"), held, least)).where(F.col("best.less") <= -least)
            .select("doc_id", "kind", "unit_no", F.col("best.licence").alias("licence"), (-F.col("best.less")).alias("dice"))
            .unionAll(_passages(docs, held, any_, least)))
