"""Licence notices in documents: a trained paragraph classifier, confirmed by template comparison. SQL only.

A paragraph is a line of the text; a notice that is wrapped over lines counts as one paragraph, under the number of
one of its lines. For that, a line that is no notice alone is read on over the following lines, up to an empty line
(one without letters and digits) or a line that is a notice alone: its last and their first REACH words. Of
neighbouring lines that read the same notice, the one with the greatest share of the template is reported.

The features of a paragraph are the word 1- and 2-grams that occur in the licence templates
and hold at least one content word; a multinomial logistic regression over them gives each licence family and
the unknown class a probability. The training rows are the templates, parts of them, and as unknown class
ordinary sentences that use the same words, each also inside a paragraph of the documents at hand (at most
FILLERS of them, those with the smallest hashes). Every fourth row is held out to fit the temperature that
calibrates the probabilities. A paragraph is reported if a family is the most likely class with at least half
of the probability and at least 60 % of the 2-grams of one of the family's templates occur in it.

Texts are first tested for any content word of the templates; a text without one has no feature, so every
paragraph of it is unknown. Nothing is shuffled.

Defined results: a null or empty text has no licensed paragraph. Equally likely classes go to the first by
name. Repeated rows are each reported; a null doc_id is kept. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNKNOWN = "unknown"
LIKELY = 0.5
CONFIRMED = 0.6
FILLERS = 64
REACH = 48  # words that a wrapped notice is looked for in; the longest template has under half as many
TEMPERATURES = (0.35, 0.5, 0.7, 1.0, 1.4, 2.0)

# Notices of the families, as their publishers word them.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "Released under the Apache License 2.0",
        "Apache License Version 2.0, January 2004",
        "SPDX-License-Identifier: Apache-2.0",
        "you may not use this file except in compliance with the License",
    ),
    "mit": (
        "Released under the MIT License",
        "Licensed under the MIT License",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License",
        "Licensed under the BSD 2-Clause License",
        "Released under the BSD License",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3",
        "Released under the GNU General Public License, version 2",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Licensed under the GPL",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License, version 2.1",
        "Released under the GNU Lesser General Public License, version 3",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ),
    "agpl": (
        "Licensed under the GNU Affero General Public License, version 3",
        "Released under the GNU Affero General Public License",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "mpl": (
        "Licensed under the Mozilla Public License, Version 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "cc0": (
        "Released under CC0 1.0 Universal",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "isc": (
        "Licensed under the ISC License",
        "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain",
        "SPDX-License-Identifier: Unlicense",
    ),
}
ORDINARY = (
    "The new version of the software was released in January",
    "She works for a public foundation and publishes free books",
    "The general use of binary files is subject to conditions",
    "He got his driving license after the second attempt",
    "A license plate was found near the source of the river",
    "The committee granted permission to film in the town",
    "Creative people in common rooms work on international terms",
    "An Apache helicopter was seen over the city",
    "Researchers at MIT have published a related study",
    "The author has a copy of the law and the documentation",
    "The terms of the work are published by the city",
    "Any person may distribute the copy free of charge at the fair",
    "The public domain of the forest is open to any purpose",
    "A commercial licence costs a fee and the shop is licensed to sell wine",
    "The Mozilla browser is software with source code",
    "Gnu are antelopes of the open plains",
    "The identifier of the file is a number, not a name",
    "Use the following form to modify the date",
    "The version of the file may be used in any form",
    "The affected rights were waived by the neighboring state",
)
# Words that are no feature on their own (two of them are frequent words in other languages or settings).
FUNCTION_WORDS = (
    "a all an and any are as at be by except for has have in into is it may met not of on or provided that the this to "
    "under v was with without you 0 1 2 3 4 mit only").split()


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def bigrams(word: Column) -> Column:
    return F.when(F.size(word) > 1, F.transform(
        F.sequence(F.lit(1), F.size(word) - 1),
        lambda i: F.concat_ws(" ", F.element_at(word, i), F.element_at(word, i + 1)))).otherwise(F.array().cast("array<string>"))


def _strings(values: list[str]) -> Column:
    """A constant array that does not need one expression per value."""
    return F.split(F.lit("\n".join(values)), "\n")


def _numbers(values) -> Column:
    return F.split(F.lit(",".join(f"{x:.6g}" for x in values)), ",").cast("array<double>")


@dataclass
class Classifier:
    """A fitted classifier; everything in it is bounded by the templates."""

    families: list[str]
    vocabulary: list[str]
    weights: list[list[float]]
    intercepts: list[float]
    temperature: float

    def features(self, word: Column, pairs: Column) -> Column:
        """Places (from 1) of the vocabulary n-grams in a paragraph's words and 2-grams, each once."""
        vocabulary = _strings(self.vocabulary)
        return F.transform(F.array_intersect(F.concat(word, pairs), vocabulary), lambda x: F.array_position(vocabulary, x).cast("int"))

    def scores(self, places: Column) -> Column:
        """The linear score of each class, in the order of `families`."""
        return F.array(*[_score(places, w, b) for w, b in zip(self.weights, self.intercepts)])

    def probabilities(self, scores: Column, temperature: float | None = None) -> Column:
        """Probability of each class, in the order of `families`."""
        heat = temperature or self.temperature
        powers = let(scores, lambda s: let(F.array_max(s), lambda top: F.transform(s, lambda x: F.exp((x - top) / heat))))
        return let(powers, lambda p: let(F.aggregate(p, F.lit(0.0), lambda a, x: a + x), lambda total: F.transform(p, lambda x: x / total)))

    def classify(self, paragraph: Column) -> Column:
        """(family, probability, matched) of a paragraph; the family is `unknown` unless a template confirms it."""
        return let(words(paragraph), self.classify_words)

    def classify_words(self, word: Column) -> Column:
        """The same of the words of a paragraph."""
        return let(bigrams(word), lambda pairs: let(
            self.features(word, pairs), lambda places: let(self.probabilities(self.scores(places)), lambda chance: let(
                F.array_position(chance, F.array_max(chance)).cast("int"), lambda best: self._confirmed(pairs, chance, best)))))

    def _confirmed(self, pairs: Column, chance: Column, best: Column) -> Column:
        shares = F.lit(0.0)
        for i, family in enumerate(self.families):
            if family in TEMPLATES:
                own = F.array(*[_share(pairs, _strings(_template_pairs(t))) for t in TEMPLATES[family]])
                shares = F.when(best == i + 1, F.array_max(own)).otherwise(shares)
        return let(shares, lambda matched: let(F.element_at(chance, best), lambda probability: F.struct(
            F.when((probability >= LIKELY) & (matched >= CONFIRMED), F.element_at(_strings(self.families), best)).otherwise(
                UNKNOWN).alias("family"), probability.alias("probability"), matched.alias("matched"))))


def _score(places: Column, weights: list[float], intercept: float) -> Column:
    table = _numbers(weights)
    return F.aggregate(places, F.lit(float(intercept)), lambda a, i: a + F.element_at(table, i.cast("int")))


def _share(pairs: Column, template: Column) -> Column:
    return F.size(F.array_intersect(pairs, template)) / F.size(template)


def _plain_words(text: str) -> list[str]:
    return [x for x in "".join(c if c.isalnum() else " " for c in text.lower()).split() if x]


def _template_pairs(text: str) -> list[str]:
    word = _plain_words(text)
    return sorted({f"{a} {b}" for a, b in zip(word, word[1:])})


def _vocabulary() -> list[str]:
    plain, out = set(FUNCTION_WORDS), set()
    for templates in TEMPLATES.values():
        for text in templates:
            word = _plain_words(text)
            out |= {x for x in word if x not in plain}
            out |= {f"{a} {b}" for a, b in zip(word, word[1:]) if not {a, b} <= plain}
    return sorted(out)


def anchors() -> list[str]:
    """The content words: a text without any of them has no feature."""
    return [x for x in _vocabulary() if " " not in x]


def _rows(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    """(label, text) rows made by SQL alone."""
    pairs = F.array(*[F.struct(F.lit(a).alias("label"), F.lit(b).alias("text")) for a, b in rows])
    return spark.range(1).select(F.explode(pairs).alias("x")).select("x.label", "x.text")


def fit(docs: DataFrame) -> Classifier:
    """Train on the templates and the ordinary sentences, some of them inside lines of `docs` (text)."""
    spark = docs.sparkSession
    # Only the short lines are sorted and sent, not the texts.
    lines = docs.filter("text is not null").select(
        F.xxhash64("text").alias("order"), F.substring(F.element_at(F.split("text", "\n"), 1), 1, 400).alias("line"))
    lines = lines.orderBy("order", "line").limit(FILLERS)
    fillers = [x.line for x in lines.collect()] or [""]
    rows = [(UNKNOWN, x) for x in ORDINARY] + [(UNKNOWN, x) for x in fillers if not set(_plain_words(x)) & set(anchors())]
    for i, (family, text) in enumerate((f, t) for f, templates in TEMPLATES.items() for t in templates):
        word = text.split()
        rows += [(family, text), (family, f"{fillers[i % len(fillers)]} {text}. {fillers[(i + 1) % len(fillers)]}")]
        if len(word) > 9:
            rows += [(family, " ".join(word[: len(word) * 2 // 3])), (family, " ".join(word[len(word) // 3 :]))]
    for i, text in enumerate(ORDINARY):
        rows.append((UNKNOWN, f"{text}. {fillers[i % len(fillers)]}"))
    families = sorted([*TEMPLATES, UNKNOWN])
    empty = Classifier(families, _vocabulary(), [], [], 1.0)
    size = len(empty.vocabulary)
    table = _rows(spark, rows).select(
        F.array_position(_strings(families), F.col("label")).cast("int").alias("place"), let(words(F.col("text")), lambda w: let(bigrams(w), lambda p: empty.features(w, p))).alias("places"),
        (F.pmod(F.xxhash64("text"), F.lit(4)) == 0).alias("held"))
    dense = F.transform(F.sequence(F.lit(1), F.lit(size)), lambda i: F.array_contains("places", i).cast("double"))
    training = table.filter("not held or place = 0").select(
        (F.col("place") - 1).cast("double").alias("label"), array_to_vector(dense).alias("features")).coalesce(1)
    model = LogisticRegression(family="multinomial", regParam=1e-3, maxIter=30, standardization=False).fit(training)
    weights, intercepts = model.coefficientMatrix.toArray().tolist(), model.interceptVector.toArray().tolist()
    missing = len(families) - len(weights)
    weights, intercepts = weights + [[0.0] * size] * missing, intercepts + [-50.0] * missing
    fitted = Classifier(families, empty.vocabulary, weights, intercepts, 1.0)
    losses = [F.avg(-F.log(F.greatest(F.element_at(fitted.probabilities(F.col("scores"), t), F.col("place")), F.lit(1e-12)))).alias(str(i))
              for i, t in enumerate(TEMPERATURES)]
    held = table.filter("held").withColumn("scores", fitted.scores(F.col("places")))
    loss = list(held.agg(*losses).first())
    if loss[0] is not None:
        fitted.temperature = TEMPERATURES[loss.index(min(loss))]
    return fitted


def _wrapped(classifier: Classifier, word: Column, alone: Column) -> Column:
    """What each line is together with those it runs on in; null where there are none. From the words of the lines."""
    ends = F.transform(alone, lambda x, i: (x["family"] != UNKNOWN) | (F.size(F.element_at(word, i + 1)) == 0))

    def read_on(own: Column, i: Column, end: Column) -> Column:
        stop = F.array_position(F.slice(end, i + 1, REACH), True).cast("int")
        count = F.when(stop == 0, REACH).otherwise(stop - 1)
        tail = F.slice(own, F.greatest(F.size(own) - REACH + 1, F.lit(1)), REACH)
        rest = F.slice(F.flatten(F.transform(F.slice(word, i + 2, count - 1), lambda w: F.slice(w, 1, REACH))), 1, REACH)
        more = (count > 1) & (i + 1 < F.size(word))
        return F.when(more, let(F.concat(tail, rest), classifier.classify_words))

    return let(ends, lambda end: F.transform(word, lambda own, i: read_on(own, i, end)))


def _best_read(wrapped: Column, i: Column) -> Column:
    """The wrapped notice that is best read from line i, or null: no neighbour holds more of it, nor the next line as much."""
    def same(x: Column, y: Column) -> Column:
        return F.coalesce(x["family"] == y["family"], F.lit(False))

    def chosen(own: Column) -> Column:
        before, after = F.get(wrapped, i - 1), F.get(wrapped, i + 1)
        later = same(own, after) & (after["matched"] >= own["matched"])
        return F.when(~later & ~(same(own, before) & (before["matched"] > own["matched"])), own)

    return let(F.get(wrapped, i), chosen)


def paragraphs(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """`docs` with column `licensed`: (paragraph, family, probability, matched) of the paragraphs with a licence."""
    lines = F.split("text", "\n")
    possible = F.arrays_overlap(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), _strings(anchors()))
    flat = let(F.transform(lines, words), lambda word: let(F.transform(word, classifier.classify_words), lambda alone: let(
        _wrapped(classifier, word, alone), lambda wrapped: F.filter(F.transform(alone, lambda x, i: let(
            F.when(x["family"] != UNKNOWN, x).otherwise(_best_read(wrapped, i)), lambda y: F.struct(
                i.alias("paragraph"), y["family"].alias("family"), y["probability"].alias("probability"),
                y["matched"].alias("matched")))), lambda x: x["family"] != UNKNOWN))))
    none = F.array().cast("array<struct<paragraph:int,family:string,probability:double,matched:double>>")
    return docs.withColumn("licensed", F.when(possible, flat).otherwise(none))


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_paragraphs, n_licensed, families, probability) for every row of `docs` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = paragraphs(rows, fit(rows))
    return found.select(
        "doc_id", F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("n_paragraphs"),
        F.size("licensed").cast("long").alias("n_licensed"),
        F.array_join(F.array_sort(F.array_distinct(F.col("licensed.family"))), ",").alias("families"),
        F.array_max(F.col("licensed.probability")).alias("probability"))
