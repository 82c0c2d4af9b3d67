"""Licence scans: a trained paragraph classifier, in DataFrame expressions.

A paragraph is a line; a line that goes on in lower case on the next one is joined with it.
Its features are the word 1- and 2-grams of the template vocabulary that it holds, and the
share of its words outside that vocabulary.  A sparse (L1) multinomial logistic regression
gives families and an unknown class.  It is trained on the templates and on a bounded sample
of the corpus, whose weak labels come from exact template matches.  The probability below
which a paragraph is unknown is calibrated on the held-out half of the sample.  A predicted
family is confirmed if one of its templates is contained in the paragraph by its 2-grams.

Paragraphs that the weights prove unknown aren't evaluated: the sum of what their words can add to a
family's lead over unknown stays below the calibrated probability.  Where the weights prove that of a paragraph without
any content word of the vocabulary, only those with one are cut out of the texts; else every paragraph is.
Of families of equal probability the later one in ``FAMILIES`` is taken.
Null text counts as empty; an empty table gives an empty result.  Repeated rows give repeated findings,
rows without doc_id too.  Texts of any length are read whole; other columns are not read.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.llm.shared import materialise, text_or_empty

# Short notices of common licences.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache-2.0": ("Licensed under the Apache License, Version 2.0", "distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"),
    "mit": ("Released under the MIT License", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    "gpl": ("This work is licensed under the GNU General Public License", "under the terms of the GNU General Public License as published by the Free Software Foundation"),
    "lgpl": ("under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",),
    "bsd": ("Redistribution and use in source and binary forms, with or without modification, are permitted", "Released under the BSD License"),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License",),
    "cc-by": ("This work is licensed under a Creative Commons Attribution 4.0 International License", "Licensed under CC BY 4.0"),
    "cc-by-sa": ("This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License", "Licensed under CC BY SA 4.0"),
    "cc-by-nc": ("This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License", "Licensed under CC BY NC 4.0"),
    "cc0": ("dedicated to the public domain under the CC0 1.0 Universal Public Domain Dedication",),
    "proprietary": ("All rights reserved", "No part of this publication may be reproduced without the prior written permission of the publisher"),
}
STOP = frozenset("a an and any are as at by for from in is it no of on on or part the this to under use with without work".split())
UNKNOWN = "unknown"
#: Paragraphs of the corpus in the training sample, at most.
SAMPLE = 4000
CONTAINED = 0.6


def _words_of(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+(?:\.[0-9]+)?", text.lower())


def _grams_of(text: str) -> list[str]:
    w = _words_of(text)
    return sorted({g for g in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:], strict=False))] if not set(g.split()) <= STOP})


VOCABULARY = sorted({g for ts in TEMPLATES.values() for t in ts for g in _grams_of(t)})
FAMILIES = [UNKNOWN, *TEMPLATES]


@dataclass(frozen=True)
class Model:
    """Weights by family over the vocabulary and the foreign share, intercepts, and the least probability."""

    weights: list[list[float]]
    intercepts: list[float]
    least: float


#: Words whose presence a paragraph's n-grams of the vocabulary need; each n-gram has one or two.
CONTENT_WORDS = sorted({w for g in VOCABULARY for w in g.split()} - STOP)


def _held_words() -> str:
    """A pattern for lower-case text that finds each content word that ``_words`` finds (and a few more: 'x' in 'x.5').

    Alternatives are grouped by their first letter, so that most words of a text end at one comparison each.
    """
    by_first: dict[str, list[str]] = {}
    for w in CONTENT_WORDS:
        by_first.setdefault(w[0], []).append(re.escape(w[1:]) + ("(?![0-9])" if w[0].isdigit() else "(?![a-z0-9])"))
    return "(?<![a-z])(?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in by_first.items()) + ")"


HELD = _held_words()


def paragraphs(docs: DataFrame, every: bool = False) -> DataFrame:
    """doc_id, paragraph (from 0) and its text for the paragraphs with a content word of the vocabulary, or for all."""
    joined = F.regexp_replace(text_or_empty(), r"(?<![.!?:])\n(?=[a-z])", " ")
    rows = docs.select("doc_id", F.posexplode(F.split(joined, "\n")).alias("paragraph", "content"))
    return rows if every else rows.where(F.lower("content").rlike(HELD))


def _words(content: Column) -> Column:
    return F.regexp_extract_all(F.lower(content), F.lit(r"([a-z0-9]+(?:\.[0-9]+)?)"), F.lit(1))


def with_features(parts: DataFrame) -> DataFrame:
    """Adds words, grams and features (one for each n-gram of the vocabulary, and the share of foreign words)."""
    words = parts.withColumn("words", _words(F.col("content")))
    pairs = F.transform(F.sequence(F.lit(1), F.size("words") - 1), lambda i: F.concat_ws(" ", F.element_at("words", i), F.element_at("words", i + 1)))
    grams = words.withColumn("grams", F.array_distinct(F.concat("words", F.when(F.size("words") > 1, pairs).otherwise(F.array().cast("array<string>")))))
    known = F.array(*map(F.lit, VOCABULARY))
    single = F.array(*map(F.lit, sorted({w for g in VOCABULARY for w in g.split()} | STOP)))
    foreign = F.size(F.filter("words", lambda w: ~F.array_contains(single, w))) / F.greatest(F.size("words"), F.lit(1))
    hits = F.transform(known, lambda g: F.array_contains("grams", g).cast("double"))
    return grams.withColumn("features", F.concat(hits, F.array(foreign)))


def containment(grams: Column, family: Column) -> Column:
    """The largest share of a template of the family whose 2-grams the paragraph holds."""
    out = F.lit(0.0)
    for name, texts in TEMPLATES.items():
        shares = []
        for t in texts:
            w = _words_of(t)
            pairs = sorted({f"{a} {b}" for a, b in zip(w, w[1:], strict=False)})
            shares.append(F.size(F.array_intersect(grams, F.array(*map(F.lit, pairs)))) / F.lit(float(len(pairs))))
        out = F.when(family == name, F.greatest(*shares, F.lit(0.0)) if len(shares) > 1 else shares[0]).otherwise(out)
    return out


def train(candidates: DataFrame, thin: int = 1, sample: int = SAMPLE) -> Model:
    """Fits on the templates and at most ``sample`` different candidate paragraphs, the first ones by a hash of their text.

    A paragraph's weight grows with the logarithm of its copies, so that none fills the sample.
    """
    spark = candidates.sparkSession
    h = F.xxhash64("content")
    drawn = candidates.where(F.pmod(h, F.lit(thin)) == 0).groupBy(h.alias("h")).agg(F.first("content").alias("content"), F.count("*").alias("n"))
    parts = materialise(drawn.orderBy("h").limit(sample).select("content", F.log1p("n").alias("weight")), "licence-drawn")
    told = spark.createDataFrame([(t, i) for i, name in enumerate(FAMILIES) if name != UNKNOWN for t in TEMPLATES[name] for _ in range(20)], "content string, label int")
    best = F.greatest(*(F.struct(containment(F.col("grams"), F.lit(name)).alias("share"), F.lit(i).alias("label")) for i, name in enumerate(FAMILIES) if name != UNKNOWN))
    parts = materialise(with_features(parts), "licence-parts")
    weak = parts.withColumn("label", F.when(best["share"] >= 0.99, best["label"]).otherwise(0)).select("content", "features", "label", "weight")
    weak = materialise(weak, "licence-sample")
    held_out = F.pmod(F.xxhash64("content"), F.lit(2)) == 1
    data = with_features(told).select("features", "label", F.lit(1.0).alias("weight")).unionByName(weak.where(~held_out).select("features", "label", "weight"))
    data = data.unionByName(spark.range(50).select(F.array(*[F.lit(0.0)] * len(VOCABULARY), F.lit(1.0)).alias("features"), F.lit(0).alias("label"), F.lit(1.0).alias("weight")))
    fit = LogisticRegression(maxIter=60, regParam=0.002, elasticNetParam=1.0, family="multinomial", weightCol="weight").fit(data.select(array_to_vector("features").alias("features"), F.col("label").cast("double").alias("label"), "weight").coalesce(1))
    matrix = fit.coefficientMatrix.toArray().tolist()
    model = Model(matrix, fit.interceptVector.toArray().tolist(), 0.0)
    # Calibration: the least probability at which held-out predictions of a family are right in 99 of 100 cases.
    scored = materialise(predict(weak.where(held_out), model), "licence-held-out").where(F.col("best.family") > 0)
    cuts = [k / 20 for k in range(8, 20)]
    counts = scored.agg(*(F.sum(((F.col("best.p") >= c) & (F.col("best.family") == F.col("label"))).cast("long")).alias(f"r{k}") for k, c in enumerate(cuts)), *(F.sum((F.col("best.p") >= c).cast("long")).alias(f"n{k}") for k, c in enumerate(cuts))).first()
    least = next((c for k, c in enumerate(cuts) if (counts[f"r{k}"] or 0) >= 0.99 * (counts[f"n{k}"] or 0)), cuts[-1])
    return Model(model.weights, model.intercepts, least)


def predict(parts: DataFrame, model: Model) -> DataFrame:
    """Adds best (p, family number)."""

    sparse = [(i, [w[i] for w in model.weights]) for i in range(len(model.weights[0])) if any(w[i] for w in model.weights)]
    used = F.array(*(F.lit(i) for i, _ in sparse))
    by_family = F.array(*(F.array(*(F.lit(w[k]) for _, w in sparse)) for k in range(len(model.weights))))
    held = F.transform(used, lambda i: F.element_at("features", i + 1))
    intercepts = F.array(*map(F.lit, model.intercepts))

    def judged(x: Column) -> Column:
        """x: one-element array with the used features; each step is bound once as a lambda's variable."""
        logits = F.transform(x, lambda f: F.zip_with(by_family, intercepts, lambda w, b: F.aggregate(F.zip_with(f, w, lambda u, v: u * v), b, lambda s, y: s + y)))
        scaled = F.transform(logits, lambda l: F.transform(F.array(F.array_max(l)), lambda top: F.transform(l, lambda y: F.exp(y - top)))[0])
        return F.transform(scaled, lambda e: F.transform(F.array(F.aggregate(e, F.lit(0.0), lambda s, y: s + y)), lambda total: F.array_max(F.transform(e, lambda y, i: F.struct((y / total).alias("p"), i.alias("family")))))[0])[0]

    return parts.withColumn("best", judged(F.array(held)))


def leads(model: Model) -> tuple[dict[str, float], float]:
    """What each content word can add to the lead of a family's logit over unknown's, and what must be added.

    A family is found if it is the most probable and has p >= least.  As p(unknown) <= 1 - p, its
    lead is then log(least / (1 - least)) or more, and not negative.  The intercepts and the best
    foreign share give the lead to start from; a 2-gram counts with its first content word.
    """
    unknown = model.weights[0]
    start = max(b - model.intercepts[0] + max(0.0, w[-1] - unknown[-1]) for w, b in zip(model.weights[1:], model.intercepts[1:], strict=True))
    adds = dict.fromkeys(CONTENT_WORDS, 0.0)
    for i, g in enumerate(VOCABULARY):
        adds[next(w for w in g.split() if w not in STOP)] += max(0.0, *(w[i] - unknown[i] for w in model.weights[1:]))
    needed = max(0.0, math.log(model.least / (1 - model.least))) if model.least > 0 else 0.0
    return adds, needed - start - 1e-6


def possible(parts: DataFrame, model: Model) -> DataFrame:
    """The paragraphs that may hold a family, by the sum of their content words' leads; none that does is left out."""
    adds, needed = leads(model)
    if needed <= 0:
        return parts
    words = sorted(w for w in adds if adds[w] > 0)
    if not words:
        return parts.where(F.lit(False))
    lead_of = F.map_from_arrays(F.array(*map(F.lit, words)), F.array(*(F.lit(adds[w]) for w in words)))
    held = F.array_intersect(_words(F.col("content")), F.array(*map(F.lit, words)))
    return parts.where(F.aggregate(held, F.lit(0.0), lambda s, w: s + F.element_at(lead_of, w)) >= needed)


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, paragraph, family, probability, contained, confirmed for each paragraph that isn't unknown."""
    candidates = paragraphs(docs)  # cut anew from the texts each time, which is less than writing them
    model = model or train(candidates, max(1, docs.count() // (2 * SAMPLE)))
    if leads(model)[1] <= 0:  # then nothing proves a paragraph without a content word unknown
        candidates = paragraphs(docs, every=True)
    parts = materialise(with_features(possible(candidates, model)).select("doc_id", "paragraph", "grams", "features"), "licence-paragraphs")
    found = materialise(predict(parts, model), "licence-predictions").where((F.col("best.family") > 0) & (F.col("best.p") >= model.least))
    named = found.withColumn("family", F.element_at(F.array(*map(F.lit, FAMILIES)), F.col("best.family") + 1))
    contained = containment(F.col("grams"), F.col("family"))
    return named.select("doc_id", "paragraph", "family", F.round("best.p", 4).alias("probability"), F.round(contained, 4).alias("contained"), (contained >= CONTAINED).alias("confirmed"))
