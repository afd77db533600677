"""Licence scan: a paragraph classifier trained here, whose findings templates confirm.

A paragraph is a line, or a line and those that follow it up to a blank one: so much of them as the longest notice has words, for
notices that are wrapped, over however many lines; lines of comment marks only are blank. Of a long line also its parts are paragraphs.
All bear the number of their first line. A paragraph's features are its word one-, two- and three-grams (letters and digits, lower case).
A multinomial logistic regression with lasso penalty learns the families and ``unknown`` (other licences) from notices, whole and with a
word left out here and there, and the class ``none`` from lines of the corpus and from sentences that only sound like a licence. A
temperature calibrates its probabilities: it is chosen on whole notices (``CALIBRATION``) that a first fit has not seen, the last fit
learns from all. A family counts if its probability reaches ``MIN_PROBABILITY`` and one of its templates confirms it: ``MIN_SHARED``
percent of the template's words, ``MIN_ORDERED`` percent of its pairs of neighbouring words and as many of its own words and pairs
(those that no other family's template has) have to be in the paragraph. A paragraph that the classifier takes for a licence, but
that no template confirms, is ``unknown``; one that denies a licence (``DENIALS``) is ``none``.

A confirmed paragraph misses few words of a template, so it holds one of the template's longest words. Only paragraphs with such
a word or one of ``LICENCE_WORDS`` are scored. All of it is column expressions, so whole texts are scanned without a shuffle.

Null and empty texts have no licence. Repeated rows give repeated results, an empty table an empty one. Very long texts and lines are
scanned whole, in time linear in their length. Only ``doc_id`` and ``text`` are read, so other columns may have any name. Of two families
in one text the one whose paragraph begins with the notice goes first, then the likelier, then the earlier.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.stage import staged

NONE = "none"
UNKNOWN = "unknown"
#: Notices of well-known licences, by family.
NOTICES: dict[str, tuple[str, ...]] = {
    "agpl": ("This work is licensed under the GNU Affero General Public License, version 3.",
             "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    "apache": ("Licensed under the Apache License, Version 2.0.",
               "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
               "SPDX-License-Identifier: Apache-2.0"),
    "bsd": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Licensed under the BSD 3-Clause License.", "Released under the 2-Clause BSD License.", "SPDX-License-Identifier: BSD-3-Clause"),
    "cc-by": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc-by-nd": ("Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc0": ("This work is dedicated to the public domain under CC0 1.0 Universal.", "CC0 1.0 Universal Public Domain Dedication"),
    "gpl": ("This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-or-later",
            "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    "isc": ("Released under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    "lgpl": ("This work is licensed under the GNU Lesser General Public License, version 3.",
             "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    "mit": ("Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License 2.0."),
    "reserved": ("All rights reserved.", "No part of this publication may be reproduced without the prior written permission of the publisher."),
    "unlicense": ("This is free and unencumbered software released into the public domain.", "Released under the Unlicense."),
}
#: Notices of licences that are no family of their own.
OTHER_NOTICES = (
    "Licensed under the Eclipse Public License 2.0.", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "SPDX-License-Identifier: EPL-2.0", "Licensed under the EUPL, Version 1.2.", "Licensed under the European Union Public Licence 1.2.",
    "SPDX-License-Identifier: EUPL-1.2", "Distributed under the Boost Software License, Version 1.0.", "Licensed under the Boost Software License 1.0.",
    "SPDX-License-Identifier: BSL-1.0", "Released under the zlib License.", "Licensed under the zlib/libpng license.", "SPDX-License-Identifier: Zlib",
    "This software is provided 'as-is', without any express or implied warranty.", "Licensed under the Artistic License 2.0.",
    "SPDX-License-Identifier: Artistic-2.0", "Licensed under the SIL Open Font License, Version 1.1.", "SPDX-License-Identifier: OFL-1.1",
    "The contents of this file are subject to the terms of the Common Development and Distribution License.", "SPDX-License-Identifier: CDDL-1.0",
    "Released under the PostgreSQL License.", "Licensed under the Microsoft Public License.", "SPDX-License-Identifier: MS-PL",
    "Licensed under the Academic Free License version 3.0.", "Licensed under the Open Software License version 3.0.",
    "Licensed under the Business Source License 1.1.", "Licensed under the Server Side Public License, version 1.",
    "Licensed under the Python Software Foundation License Version 2.", "Licensed under the Open Database License.",
    "Released under the Do What The Fuck You Want To Public License.", "Licensed under CC BY-NC-SA 4.0.", "Licensed under CC BY-NC-ND 4.0.",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
)
#: Whole notices, of several families, that the fit behind the temperature has not seen.
CALIBRATION = (
    "Licensed under the MIT License.", "Licensed under the BSD 3-Clause License.", "Licensed under the Mozilla Public License 2.0.",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC0 1.0 Universal Public Domain Dedication",
    "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "Licensed under the EUPL, Version 1.2.",
    "This work is licensed under the GNU Affero General Public License, version 3.", "Licensed under the Boost Software License 1.0.",
    "Licensed under the Apache License, Version 2.0.", "Released under the zlib License.", "SPDX-License-Identifier: Artistic-2.0",
)
#: Paragraphs with one of these words are scored even if they have no template's words.
LICENCE_WORDS = ("licence", "licensed", "license")
#: A notice is denied by one of the first words right before one of the second.
DENIALS = (("not", "never", "longer"), ("available", "dedicated", "distributed", "granted", "licensed", "released"))
#: Sentences with a licence's words that grant nothing.
SOUNDS_LIKE = (
    "The driver showed a license to the officer at the gate.", "A fishing license is required in this county.", "The license fee is due in March.",
    "She released the new version under her own name.", "The general public was not admitted.", "Version 2.0 of the map shows the river.",
    "The foundation published a report on free software in schools.", "He asked for permission to use the source of the river.",
    "Copies of the file were made for the court.", "The Apache people lived in the south west.", "Students of MIT released a paper.",
    "This work is the result of many years.", "Terms and conditions of the sale are met.", "All rights of way are marked on the map.",
    "The city will license the software to a company under the terms of the contract.", "The license of the program costs money.",
    "They distributed food under the bridge.", "The album was released under a new title.", "He was licensed as a pilot in 1990.",
    "Public access to the file is free of charge.", "Version 1.0 of the program was made available to students.",
)

#: Calibrated on whole notices never seen, the likeliest of 17 classes often has less than a half; a template has to confirm it besides.
MIN_PROBABILITY = 0.15
MIN_SHARED = 70
MIN_ORDERED = 50
LASSO = 0.0002
#: A whole notice counts so much in the fit, each of its forms with a word left out once.
NOTICE_WEIGHT = 5.0
#: A line of the corpus counts so much in the fit; there are many more of them than notices.
LINE_WEIGHT = 0.1
#: Lines of the corpus that teach ``none``: those of so many documents.
CORPUS_DOCUMENTS = 200
#: Lines looked at first behind a line; where they have fewer words than the longest notice, more are.
NEAR = 10
_MARKS = "\t\u000b\f\r.,;:!?\"'`()[]{}<>/\\|@#$%^&*+=~-_–—’“”"


def words_of(text: Column) -> Column:
    """Distinct words are left to the caller; runs of other characters than marks and spaces, lower case."""
    return F.filter(F.split(F.translate(F.lower(text), _MARKS, " " * len(_MARKS)), "[ \n]"), lambda w: w != "")


def grams_of(words: Column) -> Column:
    """Distinct one-, two- and three-grams. ``words`` has to be a column, not an expression."""
    many = lambda k: F.filter(
        F.transform(words, lambda w, i: F.when(i + k <= F.size(words), F.array_join(F.slice(words, i + 1, k), " "))), lambda g: g.isNotNull())
    return F.array_distinct(F.concat(words, many(2), many(3)))


@dataclass(frozen=True)
class Model:
    families: tuple[str, ...]
    intercepts: tuple[float, ...]
    weights: dict[str, tuple[float, ...]]  # of each gram, by family
    temperature: float


def _lines(spark: SparkSession, rows: Sequence[tuple[str, str]]) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(a).alias("family"), F.lit(t).alias("line")) for a, t in rows])).alias("r")).select("r.*")


def longest() -> int:
    """Words of the longest notice."""
    return max(len(_plain_words(t)) for found in (*NOTICES.values(), OTHER_NOTICES) for t in found)


def starts_of(marked: Column) -> Column:
    """Numbers of the lines whose paragraphs can hold a marked line. ``marked`` has to be a column, not an expression."""
    return F.when(F.size(marked) > 0, F.filter(
        F.sequence(F.lit(0), F.size(marked) - 1), lambda i: F.exists(F.slice(marked, i + 1, longest() + 1), lambda m: m)))


def paragraphs_of(lines: Column, starts: Column) -> Column:
    """Structs (no, words, rest: those behind the first line) of the paragraphs that begin at the lines ``starts`` of ``lines`` (words of each
    line), which has to be a column. Any notice in a run of lines lies in one of them: lines up to a blank one have a word each, so as many
    lines as the longest notice has words hold all of it."""
    most = longest()
    empty = F.array().cast("array<string>")
    unit = lambda w, i, rest=empty: F.struct(i.alias("no"), w.alias("words"), rest.alias("rest"))
    bound = lambda column, make: F.flatten(F.transform(F.array(column), make))  # noqa: E731  (computes the column once)

    def behind(i: Column, count: int, make) -> Column:
        """``make`` of the words in the ``count`` lines after line ``i``, up to a blank one, and of whether there is a blank one."""

        def cut(after: Column) -> Column:
            blank = F.array_position(F.transform(after, lambda x: F.size(x)), 0).cast("int")
            return bound(blank, lambda n: make(F.slice(F.flatten(F.slice(after, 1, F.when(n > 0, n - 1).otherwise(count))), 1, most), n > 0))

        return bound(F.slice(lines, i + 2, count), cut)

    def wrapped(w: Column, i: Column) -> Column:
        own = F.slice(w, F.greatest(F.lit(1), F.size(w) - most + 1), most)
        with_rest = lambda more, _: F.when(F.size(more) > 0, F.array(unit(F.concat(own, more), i, more))).otherwise(none)
        near = lambda more, ended: F.when(ended | (F.size(more) >= most), with_rest(more, ended)).otherwise(behind(i, most, with_rest))
        return F.when(F.size(w) > 0, behind(i, NEAR, near))

    def parts(w: Column, i: Column) -> Column:
        return F.when(F.size(w) > 2 * most, F.transform(F.sequence(F.lit(1), F.size(w), F.lit(most)), lambda k: unit(F.slice(w, k, 2 * most), i)))

    none = F.array().cast("array<struct<no:int,words:array<string>,rest:array<string>>>")
    line = lambda i: F.element_at(lines, i + 1)
    return F.flatten(F.transform(starts, lambda i: F.concat(
        F.array(unit(line(i), i)), F.coalesce(wrapped(line(i), i), none), F.coalesce(parts(line(i), i), none))))


def pairs_of(words: Column) -> Column:
    """Pairs of neighbouring words. ``words`` has to be a column, not an expression."""
    return F.array_distinct(F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.size(words)),
                                       lambda a, b: F.concat_ws(" ", a, b)))


def training_lines(docs: DataFrame) -> DataFrame:
    """(family, words, held_out, weight): notices whole and with each word left out, sentences that sound alike, lines of the corpus that no
    template confirms. Notices of ``CALIBRATION`` are held out from the first fit with all their forms."""
    spark = docs.sparkSession
    rows = [(family, t, t in CALIBRATION) for family, found in (*NOTICES.items(), (UNKNOWN, OTHER_NOTICES)) for t in found]
    rows += [(NONE, t, False) for t in SOUNDS_LIKE]
    given = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("family"), F.lit(t).alias("line"), F.lit(held).alias("held_out")) for a, t, held in rows])).alias("r")).select(
        "r.family", words_of(F.col("r.line")).alias("words"), "r.held_out")
    shorter = given.filter((F.col("family") != NONE) & (F.size("words") > 4)).select("*", F.explode(F.sequence(F.lit(1), F.size("words"))).alias("k")).select(
        "family", F.filter("words", lambda w, i: i + 1 != F.col("k")).alias("words"), "held_out")
    some = docs.filter("text is not null").select("doc_id", "text").orderBy(F.xxhash64("doc_id"), "doc_id").limit(CORPUS_DOCUMENTS)
    split = some.select(F.transform(F.split("text", "\n"), words_of).alias("lines"))
    lines = split.select(F.explode(paragraphs_of(F.col("lines"), F.sequence(F.lit(0), F.size("lines") - 1))["words"]).alias("words")).select(F.lit(NONE).alias("family"), "words")
    notice = F.exists("words", lambda w: F.startswith(w, F.lit("licen")) | (w == "copyright"))
    shares = [100 * F.size(F.array_intersect(F.array(*map(F.lit, t.words)), F.col("words"))) >= MIN_SHARED * len(t.words) for found in templates().values() for t in found]
    plain = lines.filter((F.size("words") > 0) & ~notice).filter(~F.array_contains(F.array(*shares), True))
    taught = given.withColumn("weight", F.lit(NOTICE_WEIGHT)).unionByName(shorter.withColumn("weight", F.lit(1.0)))
    return taught.unionByName(plain.withColumn("held_out", F.lit(False)).withColumn("weight", F.lit(LINE_WEIGHT)))


@dataclass(frozen=True)
class Template:
    words: tuple[str, ...]
    pairs: tuple[str, ...]
    own: tuple[str, ...]  # words and pairs of no other family


def templates() -> dict[str, list[Template]]:
    """What confirms a family, from its notices."""
    grams: dict[str, set[str]] = {}
    for family, found in (*NOTICES.items(), (UNKNOWN, OTHER_NOTICES)):
        grams[family] = {g for t in found for g in (*_plain_words(t), *_plain_pairs(t))}
    out = {}
    for family, found in NOTICES.items():
        others = set().union(*(g for f, g in grams.items() if f != family))
        out[family] = [Template(tuple(sorted(set(_plain_words(t)))), tuple(sorted(set(_plain_pairs(t)))),
                                tuple(sorted({*_plain_words(t), *_plain_pairs(t)} - others))) for t in found]
    return out


def fit(docs: DataFrame) -> Model:
    """The classifier. What it learns from is bounded: the notices and the lines of ``CORPUS_DOCUMENTS`` documents."""
    spark = docs.sparkSession
    families = (NONE, *sorted(NOTICES), UNKNOWN)
    numbers = F.create_map(*[x for k, f in enumerate(families) for x in (F.lit(f), F.lit(float(k)))])
    rows = staged(spark, training_lines(docs).withColumn("grams", grams_of(F.col("words"))).withColumn("label", numbers[F.col("family")]).coalesce(2), "notices")
    # Grams of notices and of what sounds alike are features; others tell nothing about a family.
    counter = CountVectorizer(inputCol="grams", outputCol="features", binary=True, minDF=2.0).fit(
        rows.filter((F.col("family") != NONE) | F.exists("words", lambda w: w.isin("license", "public", "version", "permission", "rights"))))
    data = counter.transform(rows)
    lasso = LogisticRegression(family="multinomial", weightCol="weight", elasticNetParam=1.0, regParam=LASSO, maxIter=80, standardization=False)
    before = lasso.fit(data.filter("not held_out"))
    held = [(int(r["label"]), list(r["raw"])) for r in
            before.transform(data.filter("held_out")).select("label", vector_to_array("rawPrediction").alias("raw")).collect()]
    fitted = lasso.fit(data)
    matrix = fitted.coefficientMatrix.toArray().tolist()
    weights = {g: w for k, g in enumerate(counter.vocabulary) if any(w := tuple(row[k] for row in matrix))}
    return Model(families, tuple(fitted.interceptVector.toArray().tolist()), weights, temperature(held))


def temperature(held: Sequence[tuple[int, list[float]]]) -> float:
    """The divisor of the scores that makes the held-out labels likeliest."""

    def loss(t: float) -> float:
        return sum(math.log(sum(math.exp((x - max(raw)) / t) for x in raw)) - (raw[label] - max(raw)) / t for label, raw in held)

    return min((k / 8 for k in range(2, 33)), key=loss)


def anchors() -> list[str]:
    """Of each notice its longest words, so many that a paragraph with ``MIN_SHARED`` percent of its words has one of them; ``LICENCE_WORDS``."""
    out = set(LICENCE_WORDS)
    for found in NOTICES.values():
        for notice in found:
            words = sorted(set(_plain_words(notice)), key=lambda w: (-len(w), w))
            missing = len(words) * (100 - MIN_SHARED) // 100
            out.update(words[:missing + 1])
    return sorted(out)


def _plain_words(text: str) -> list[str]:
    return text.lower().translate(str.maketrans(_MARKS, " " * len(_MARKS))).split()


def _plain_pairs(text: str) -> list[str]:
    words = _plain_words(text)
    return [f"{a} {b}" for a, b in zip(words, words[1:])]


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, family (of the surest paragraph, or ``unknown``, or ``none``), probability, paragraph (its number from 0),
    families (all confirmed ones, sorted) of every document."""
    rare = F.array(*map(F.lit, anchors()))
    read = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    hit = read.select("doc_id", F.when(F.arrays_overlap(words_of(F.col("text")), rare), F.split("text", "\n")).alias("lines"))
    split = hit.select("doc_id", F.transform("lines", words_of).alias("lines")).select(
        "doc_id", "lines", F.transform("lines", lambda w: F.arrays_overlap(w, rare)).alias("marked")).select(
        "doc_id", paragraphs_of(F.col("lines"), starts_of(F.col("marked"))).alias("lines"))
    chosen = split.select("doc_id", F.filter("lines", lambda x: F.arrays_overlap(x["words"], rare)).alias("lines"))
    known = F.array(*map(F.lit, sorted(model.weights)))
    grams = chosen.select("doc_id", F.transform("lines", lambda x: F.struct(
        x["no"].alias("no"), x["words"].alias("words"), x["rest"].alias("rest"), F.array_intersect(grams_of(x["words"]), known).alias("grams"))).alias("lines"))
    table = F.create_map(*[x for g, w in sorted(model.weights.items()) for x in (F.lit(g), F.array(*map(F.lit, w)))])
    start = F.array(*map(F.lit, model.intercepts))
    raw = lambda found: F.aggregate(found, start, lambda total, g: F.zip_with(total, F.element_at(table, g), lambda a, b: a + b))
    scored = grams.select("doc_id", F.transform("lines", lambda x: F.struct(
        x["no"].alias("no"), x["words"].alias("words"), x["rest"].alias("rest"), raw(x["grams"]).alias("raw"))).alias("lines"))
    shares = scored.select("doc_id", F.transform("lines", lambda x: F.struct(
        x["no"].alias("no"), x["words"].alias("words"), x["rest"].alias("rest"), (F.array_position(x["raw"], F.array_max(x["raw"])).cast("int") - 1).alias("best"),
        F.aggregate(x["raw"], F.lit(0.0), lambda t, v: t + F.exp((v - F.array_max(x["raw"])) / model.temperature)).alias("total"))).alias("lines"))
    texts = lambda found: F.array(*map(F.lit, found)) if found else F.array().cast("array<string>")
    known_templates = templates()
    lists = F.array(*[F.array(*[
        F.struct(texts(t.words).alias("words"), texts(t.pairs).alias("pairs"), texts(t.own).alias("own"))
        for t in known_templates.get(f, [Template(("",), ("",), ("",))])]) for f in model.families])
    names = F.array(*map(F.lit, model.families))
    shared = lambda t, words: F.size(F.array_intersect(t, words))
    enough = lambda t, found, percent: 100 * shared(t, found) >= percent * F.size(t)
    template = lambda x: F.element_at(lists, x["best"] + 1)
    confirms = lambda t, x: (
        enough(t["words"], x["words"], MIN_SHARED) & enough(t["pairs"], x["pairs"], MIN_ORDERED)
        & enough(t["own"], F.concat(x["words"], x["pairs"]), MIN_ORDERED))
    confirmed = lambda x: F.exists(template(x), lambda t: confirms(t, x))
    # A first line that adds no word of a confirmed template is not where the notice begins; paragraphs that begin with it go first.
    begins = lambda x: F.exists(template(x), lambda t: confirms(t, x) & (shared(t["words"], x["words"]) > shared(t["words"], x["rest"])))
    denials = F.array(*[F.lit(f"{a} {b}") for a in DENIALS[0] for b in DENIALS[1]])
    licences = shares.select("doc_id", F.filter("lines", lambda x: x["best"] > 0).alias("lines")).select("doc_id", F.transform(
        "lines", lambda x: F.struct(*[x[c].alias(c) for c in ("no", "words", "rest", "best", "total")], pairs_of(x["words"]).alias("pairs"))).alias("lines"))
    granted = F.filter("lines", lambda x: ~F.arrays_overlap(x["pairs"], denials))
    judged = licences.select("doc_id", F.transform(granted, lambda x: F.struct(
        begins(x).alias("begins"), (1 / x["total"]).alias("probability"), (-x["no"]).alias("back"),
        F.when((1 / x["total"] >= MIN_PROBABILITY) & confirmed(x), F.element_at(names, x["best"] + 1)).alias("family"))).alias("lines"))
    found = F.filter("lines", lambda x: x["family"].isNotNull())
    best = judged.select("doc_id", found.alias("sure"), F.array_max(found).alias("top"), F.coalesce(F.size("lines") > 0, F.lit(False)).alias("some"))
    return best.select(
        "doc_id", F.coalesce("top.family", F.when(F.col("some"), UNKNOWN).otherwise(NONE)).alias("family"), F.col("top.probability").alias("probability"),
        (-F.col("top.back")).alias("paragraph"),
        F.coalesce(F.array_join(F.array_sort(F.array_distinct(F.transform("sure", lambda x: x["family"]))), ","), F.lit("")).alias("families"))
