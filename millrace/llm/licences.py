"""Licence scan: a trained paragraph classifier over sparse word n-grams, confirmed against templates.

Main path: DataFrame and SQL functions only. The classifier is trained by Spark ML.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.text import stored

# How notices of licence families read.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "This project is released under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "This software is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "Licensed under the GNU GPL version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "BSD": (
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0": (
        "To the extent possible under law, the author has dedicated this work to the public domain.",
        "Licensed under CC0 1.0 Universal.",
    ),
    "Proprietary": ("All rights reserved.", "Copyright, all rights reserved. No part may be reproduced without written permission."),
}
# The parts by which a notice of any wording grants a licence by its name.
NAMES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": ("apache license", "apache 2.0"),
    "MIT": ("mit license",),
    "GPL": ("gnu general public license", "gnu gpl", "general public license", "gpl"),
    "LGPL": ("gnu lesser general public license", "gnu lgpl", "lesser general public license", "lgpl"),
    "AGPL": ("gnu affero general public license", "gnu agpl", "affero general public license", "agpl"),
    "BSD": ("bsd license", "bsd 2-clause", "bsd 3-clause", "2-clause bsd", "3-clause bsd", "bsd-style license"),
    "MPL-2.0": ("mozilla public license", "mpl 2.0"),
    "CC-BY": ("cc by", "creative commons attribution 4.0", "creative commons attribution license"),
    "CC-BY-SA": ("cc by-sa", "creative commons attribution-sharealike"),
    "CC-BY-NC": ("cc by-nc", "creative commons attribution-noncommercial"),
    "CC0": ("cc0",),
    "Proprietary": (),
}
GRANTS = ("licensed under", "released under", "distributed under", "available under", "governed by", "the terms of", "under the terms of")
UNKNOWN = "unknown"
# Ordinary English and other words that say nothing of a licence by themselves.
PLAIN = frozenset(
    "the of and to in a is that for it as was with be by on not he are this from at or an have under may you can "
    "use work part person file found copy made free terms following conditions without source form law made met any "
    "possible extent author provided published subject written except obtaining associated".split()
)
SEPARATORS = "[^\\p{L}\\p{N}.-]+"
NEGATIVES = 4000  # unlabelled paragraphs that stand for no licence
CONFIRM = 0.6  # share of a template's word pairs that a paragraph must have
FLOOR = 0.5
FOREIGN = 2  # grams of the templates that a paragraph without a licence may have by chance
AROUND = 40  # paragraphs that each template is put into
RIDGE = 1e-3
FACTORS = [2.0 ** (k / 4) for k in range(-8, 17)]


def paragraph_words(text: Column) -> Column:
    """Lower-case words of letters, digits, inner dots and hyphens."""
    parts = F.split(F.lower(text), SEPARATORS)
    return F.filter(F.transform(parts, lambda w: F.regexp_replace(w, "^[.-]+|[.-]+$", "")), lambda w: w != "")


def grams(words: Column) -> Column:
    """The distinct words that are not plain, and all distinct pairs of neighbours."""
    n = F.size(words)
    single = F.filter(words, lambda w: ~w.isin(*sorted(PLAIN)))
    pairs = F.transform(
        F.slice(words, 1, F.greatest(n - 1, F.lit(0))), lambda w, i: F.concat(w, F.lit(" "), F.get(words, i + 1))
    )
    return F.array_distinct(F.concat(single, pairs))


def once(value: Column, use) -> Column:
    """``use`` of a value that is computed one time, however often it is named."""
    return F.element_at(F.transform(F.array(value), use), 1)


def template_rows() -> Column:
    """Templates, and as examples only (``short``) the licences by their names."""
    every = [(f, t, False) for f, texts in TEMPLATES.items() for t in texts]
    every += [(f, f"{GRANTS[0]} the {name}", True) for f, names in NAMES.items() for name in names]
    return F.array(*[F.struct(F.lit(f).alias("family"), F.lit(t).alias("text"), F.lit(s).alias("short")) for f, t, s in every])


def templates(spark: SparkSession) -> DataFrame:
    rows = spark.range(1).select(F.explode(template_rows()).alias("row")).select("row.*")
    return rows.withColumn("grams", grams(paragraph_words(F.col("text"))))


@dataclass(frozen=True)
class Model:
    """``weights[gram][k]`` and ``bias[k]`` of ``families[k]``, the first of which is unknown."""

    families: list[str]
    weights: dict[str, list[float]]
    bias: list[float]
    pairs: dict[str, list[list[str]]]  # word pairs of each template
    span: int  # words of the longest template

    @property
    def singles(self) -> list[str]:
        return sorted(g for g in self.weights if " " not in g)

    def probabilities(self, found: Column) -> Column:
        """Class probabilities of a paragraph from its grams, as an array in the order of ``families``."""
        table = F.create_map(*[
            x for g, w in sorted(self.weights.items()) for x in (F.lit(g), F.array(*[F.lit(v) for v in w]))
        ])
        none = F.array(*[F.lit(0.0)] * len(self.bias))
        totals = F.aggregate(
            found, F.array(*[F.lit(b) for b in self.bias]),
            lambda total, g: F.zip_with(total, F.coalesce(F.try_element_at(table, g), none), lambda x, y: x + y),
        )
        return once(totals, lambda t: once(F.array_max(t), lambda top: once(
            F.transform(t, lambda x: F.exp(x - top)),
            lambda powers: once(F.aggregate(powers, F.lit(0.0), lambda a, b: a + b), lambda all_: F.transform(powers, lambda x: x / all_)),
        )))

    def likeness(self, found: Column, family: Column) -> Column:
        """The greatest share of a template's word pairs, over the templates of ``family``."""
        out = F.lit(0.0)
        for name, many in self.pairs.items():
            shares = [F.size(F.array_intersect(found, F.array(*[F.lit(p) for p in one]))) / F.lit(float(len(one))) for one in many]
            out = F.when(family == name, F.greatest(*shares, F.lit(0.0))).otherwise(out)
        return out

    def granted(self, words: Column, family: Column) -> Column:
        """Whether the words grant a licence of ``family`` by one of its ``NAMES``."""
        said, out = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" ")), F.lit(False)
        for name, many in NAMES.items():
            if many:
                either = "|".join(x.replace(".", "[.]") for x in many)
                out = F.when(family == name, said.rlike(f" ({'|'.join(GRANTS)}) ((the|a|an) )?({either}) ")).otherwise(out)
        return out


def windows(lines: Column, span: int) -> Column:
    """The words of each line, and of each run of lines that a notice of ``span`` words may be wrapped over.

    ``lines`` are arrays of words. A run ends before a line without words, and once the lines inside
    it have the words of a notice; of its first line the last ``span`` words count, of its last line
    the first ``span``.
    """

    def longer(so_far: Column, line: Column) -> Column:
        inner = so_far["inner"] + F.size(line)
        return F.when(
            so_far["open"] & (F.size(line) > 0),
            F.struct(
                F.concat(so_far["words"], F.slice(line, 1, span)).alias("words"), inner.alias("inner"), (inner < span - 1).alias("open"),
                F.concat(so_far["runs"], F.array(F.concat(so_far["words"], F.slice(line, 1, span)))).alias("runs"),
            ),
        ).otherwise(F.struct(so_far["words"].alias("words"), so_far["inner"].alias("inner"), F.lit(False).alias("open"), so_far["runs"].alias("runs")))

    def runs(line: Column, k: Column) -> Column:
        first = F.greatest(F.size(line) - span, F.lit(0)) + 1
        alone = F.struct(
            F.slice(line, first, F.lit(span)).alias("words"), F.lit(0).alias("inner"), (F.size(line) > 0).alias("open"), F.array(line).alias("runs")
        )
        return F.aggregate(F.slice(lines, k + 2, F.lit(span)), alone, longer, lambda found: found["runs"])

    return F.flatten(F.transform(lines, runs))


def _examples(docs: DataFrame, every: list[str]) -> DataFrame:
    """(family, grams, draw): templates alone and amid other words, and other paragraphs as unknown."""
    known = templates(docs.sparkSession)
    lines = docs.where("text IS NOT NULL").select(F.explode(F.split("text", "\n", -1)).alias("text")).where("text <> ''")
    lines = lines.withColumn("draw", F.xxhash64("text"))
    # one in so many different lines, so that the last task sorts a bounded number whatever the corpus
    different = lines.agg(F.approx_count_distinct("draw")).first()[0]
    share = max(1, int(different // (2 * NEGATIVES)))
    drawn = lines.where(F.pmod(F.xxhash64(F.lit(1), "draw"), F.lit(share)) == 0).dropDuplicates(["draw"])
    drawn = drawn.orderBy("draw").limit(NEGATIVES)
    others = drawn.select("draw", grams(paragraph_words(F.col("text"))).alias("grams"))
    # paragraphs that share much with a template are no examples of other text
    foreign = F.size(F.array_intersect("grams", F.array(*[F.lit(g) for g in every]))) <= FOREIGN
    negatives = stored(others.where(foreign), "negatives")
    around = negatives.orderBy("draw").limit(AROUND).withColumn("known", F.explode(template_rows()))
    amid = around.select(
        "known.family", F.array_distinct(F.concat(grams(paragraph_words(F.col("known.text"))), "grams")).alias("grams"), "draw"
    )
    alone = known.select("family", "grams", F.explode(F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))).alias("draw"))
    return stored(alone.union(amid).union(negatives.select(F.lit(UNKNOWN).alias("family"), "grams", "draw")), "examples")


def fit(docs: DataFrame) -> Model:
    """Multinomial logistic regression on the grams of the templates, trained by Spark ML.

    The vocabulary is that of the templates and the examples are bounded (``NEGATIVES`` paragraphs,
    different and drawn by hash, and each template ``AROUND`` times), so the model has a fixed size whatever the
    corpus. Half of the examples train; on the other half one factor on all scores is chosen by
    likelihood, which calibrates the chance of unknown.
    """
    known = templates(docs.sparkSession)
    every = [r["g"] for r in known.select(F.explode("grams").alias("g")).distinct().orderBy("g").collect()]
    families = [UNKNOWN, *sorted(TEMPLATES)]
    label = F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family")) - 1
    counted = CountVectorizerModel.from_vocabulary(every, "grams", "features")
    rows = counted.setBinary(True).transform(_examples(docs, every)).select(label.cast("double").alias("label"), "features", "draw")
    half = F.pmod("draw", F.lit(2)) == 0
    fitted = LogisticRegression(family="multinomial", regParam=RIDGE, maxIter=60).fit(rows.where(half).coalesce(2))
    matrix, bias = fitted.coefficientMatrix.toArray(), np.asarray(fitted.interceptVector.toArray())
    rest = rows.where(~half).collect()
    scores = np.array([matrix @ r["features"].toArray() + bias for r in rest]).reshape(-1, len(families))
    truth = np.array([int(r["label"]) for r in rest], int)

    def loss(factor: float) -> float:
        z = scores * factor
        z = z - z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), truth]).mean())

    factor = min(FACTORS, key=loss) if len(rest) else 1.0
    weights = {g: [float(v) for v in matrix[:, k] * factor] for k, g in enumerate(every)}
    pairs = {family: [] for family in families[1:]}
    for r in known.where("NOT short").collect():
        pairs[r["family"]].append([g for g in r["grams"] if " " in g])
    span = known.agg(F.max(F.size(paragraph_words(F.col("text"))))).first()[0]
    return Model(families, weights, [float(b) for b in bias * factor], pairs, span)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_paragraphs, licence, probability, families) of every row of ``docs``.

    Every line with a word (``n_paragraphs``) of the whole text is classified, and so is every run of
    neighbouring lines that a wrapped notice may stand on (``windows``). A run with no single word
    of the model has nothing that tells it from other text and is unknown. A family counts if its
    probability is ``FLOOR`` or more and a template of it has ``CONFIRM`` of its word pairs there or
    the words grant it by name (``granted``). ``families`` are all that count, ``licence`` the most
    probable, or unknown with probability null. Null and empty texts have no paragraphs; rows that
    repeat repeat here.
    """
    model = fit(docs)
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.transform(F.split("text", "\n", -1), paragraph_words).alias("lines"))
    marks = F.array(*[F.lit(w) for w in model.singles])
    rows = rows.select("doc_id", F.size(F.filter("lines", lambda w: F.size(w) > 0)).cast("long").alias("n_paragraphs"), F.when(
        F.exists("lines", lambda w: F.arrays_overlap(w, marks)), windows(F.col("lines"), model.span)
    ).otherwise(F.array().cast("array<array<string>>")).alias("runs"))
    rows = rows.select("doc_id", "n_paragraphs", F.filter("runs", lambda w: F.arrays_overlap(w, marks)).alias("marked"))
    names = F.array(*[F.lit(f) for f in model.families])

    def verdict(words: Column, found: Column, chances: Column) -> Column:
        best = F.array_max(chances)
        family = F.element_at(names, F.array_position(chances, best).cast("int"))
        told = once(family, lambda f: (model.likeness(found, f) >= CONFIRM) | model.granted(words, f))
        return F.struct(F.round(best, 6).alias("probability"), family.alias("family"), told.alias("told"))

    rows = rows.withColumn("verdicts", F.transform(
        "marked", lambda w: once(grams(w), lambda found: once(model.probabilities(found), lambda chances: verdict(w, found, chances)))
    ))
    rows = rows.withColumn("sure", F.filter(
        "verdicts", lambda v: (v["family"] != UNKNOWN) & (v["probability"] >= FLOOR) & v["told"]
    ))
    best = F.array_max("sure")
    return rows.select(
        "doc_id", "n_paragraphs", F.coalesce(best["family"], F.lit(UNKNOWN)).alias("licence"), best["probability"].alias("probability"),
        F.array_sort(F.array_distinct(F.transform("sure", lambda v: v["family"]))).alias("families"),
    )
