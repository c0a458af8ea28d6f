"""Licence scan of paragraphs, with DataFrame functions only.

A sparse multinomial logistic regression (Spark ML, L1 penalty) over word
uni- and bigrams tells licence families apart from each other and from an
``unknown`` class. A prediction counts if its probability is above a threshold
calibrated on corpus paragraphs kept from training, and it is confirmed if the
paragraph also holds most word pairs of one of the family's templates.

Training texts: the templates below with their beginnings and ends, and as
unknown class a bounded sample of corpus lines that resemble no template, also
not together with the lines around them
(about SAMPLE_DOCS documents, chosen by a hash: documented bound), plus the
sentences of NOT_LICENCES. Scoring covers every line of every text, and every
window of neighbouring lines between blank lines that is no longer than a
notice can be (a line and what follows until the longest template's words are
reached), so wrapped notices are found too. Words are runs of letters and
digits, so comment marks neither join nor part lines, and a line of marks only
is blank. A window counts if it is predicted and confirmed, and of overlapping
windows of one family the most similar one counts, where its paragraph number
is that of its first line.

All n-grams of the templates are features. The probability threshold is
calibrated on all lines of the corpus outside the fitted half of the sample, in
one aggregated pass over fixed classes of probability.

The intercepts favour ``unknown`` (asserted at fitting), so n-grams whose
weights for a family add up to less than that lead cannot make a prediction
among themselves. The commonest ones are set aside that way (word counts of the
sample choose which, a matter of speed only); a predicted paragraph holds one
of the other n-grams, hence only texts with a word of those are taken apart
into paragraphs. This is exact, not a heuristic.

Defined results: null and empty texts have no paragraph with a licence; blank
paragraphs count as paragraphs only if they hold a word; repeated rows are
scanned alike; an empty table gives no rows; columns beyond doc_id and text
are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import staged

UNKNOWN = "unknown"
#: Notices of each family.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "This project is released under the Apache 2.0 license."],
    "mit": [
        "Released under the MIT License.",
        "This software is licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License.",
        "Licensed under the GNU GPL v3."],
    "lgpl": ["This library is licensed under the GNU Lesser General Public License.",
             "Distributed under the terms of the GNU LGPL."],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Licensed under the BSD 3-Clause License.", "Use of this source code is governed by a BSD-style license."],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "Licensed under the Mozilla Public License, version 2.0."],
    "cc-by": ["Licensed under CC BY 4.0.",
              "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "public-domain": ["Dedicated to the public domain under CC0 1.0.", "This work is in the public domain."],
    "proprietary": ["All rights reserved.",
                    "All rights reserved. No part of this publication may be reproduced without prior written permission."],
}
#: Sentences with a licence's words that are not licences.
NOT_LICENCES = [
    "The driver showed a license to the officer.", "All of the general public was free to enter the domain.",
    "He is an apache pilot and a student at the institute.", "Version 2 of the plan was released under pressure.",
    "The foundation published a free program for every person.", "The rights of all workers were reserved for later talks.",
    "A creative work of the commons attracts attention.", "The source of the river is subject to debate.",
]
SAMPLE_DOCS = 1500
#: At most this share of the corpus's other lines has a probability above the threshold.
FALSE_SHARE = 0.001
LEAST_PROBABILITY, LEAST_SIMILARITY = 0.5, 0.6
REG = 0.0005
NO_EVIDENCE = 100.0       # weight of the training row without any n-gram


def _words(p: Column) -> Column:
    return F.array_remove(F.split(F.lower(p), "[^a-z0-9]+"), "")


def _bigrams(w: Column) -> Column:
    n = F.greatest(F.size(w) - 1, F.lit(0))
    return F.zip_with(F.slice(w, F.lit(1), n), F.slice(w, F.lit(2), n), lambda a, b: F.concat_ws(" ", a, b))


def _local_grams(text: str) -> list[str]:
    import re
    w = [x for x in re.split("[^a-z0-9]+", text.lower()) if x]
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


_PAIRS = {x: [g for g in dict.fromkeys(_local_grams(x)) if " " in g] for xs in TEMPLATES.values() for x in xs}
#: All word pairs of the templates, the words of the longest one, and the fewest pairs that confirm.
ALL_PAIRS = sorted({g for b in _PAIRS.values() for g in b})
LONGEST = max(sum(" " not in g for g in _local_grams(x)) for x in _PAIRS)
FEWEST = min(-int(-LEAST_SIMILARITY * len(b) // 1) for b in _PAIRS.values())


@dataclass
class Model:
    families: list[str]                    # with UNKNOWN
    intercepts: list[float]
    weights: dict[str, list[float]]        # n-gram -> weight per family; at most the templates' n-grams
    counts: dict[str, int]                 # sampled lines with each of the templates' words; for speed only
    threshold: float


def _anchors(model: Model) -> list[str]:
    """Words of which every predicted paragraph holds one: the rarest word of
    each n-gram that speaks for a family, without n-grams that even together
    weigh less, for every family, than the unknown class's lead over it."""
    u = model.families.index(UNKNOWN)
    others = [i for i in range(len(model.families)) if i != u]
    lift = {g: [max(x[i] - x[u], 0.0) for i in others] for g, x in model.weights.items()}
    lift = {g: x for g, x in lift.items() if any(x)}
    lead = [0.999 * (model.intercepts[u] - model.intercepts[i]) for i in others]

    def rarest(g):
        return min(g.split(), key=lambda w: (model.counts.get(w, 0), w))
    for g in sorted(lift, key=lambda g: (-model.counts.get(rarest(g), 0), max(lift[g]), g)):
        if all(x < rest for x, rest in zip(lift[g], lead)):
            lead = [rest - x for x, rest in zip(lift.pop(g), lead)]
    return sorted(set(map(rarest, lift)))


def _speaks(text: Column, anchors: list[str]) -> Column:
    """Whether a text holds an anchor as a word; a search for the bare strings comes first."""
    low = F.lower(text)
    bare = F.lit(False)
    for w in anchors:
        bare = bare | low.contains(w)
    return bare & F.exists(_words(text), lambda g: g.isin(anchors))


def _pairs_held(w: str) -> Column:
    """The templates' word pairs in an array of words."""
    return F.filter(_bigrams(F.col(w)), lambda g: g.isin(ALL_PAIRS))


def _similarity(bigrams: str, family: Column | None = None) -> Column:
    """Largest share of a template's word pairs that the array column holds."""
    t = F.array(*[F.struct(F.lit(f).alias("f"), F.array(*map(F.lit, _PAIRS[x])).alias("b"))
                  for f, xs in TEMPLATES.items() for x in xs])
    if family is not None:
        t = F.filter(t, lambda x: x["f"] == family)
    return F.coalesce(F.array_max(F.transform(t, lambda x: F.size(F.array_intersect(x["b"], F.col(bigrams))) / F.size(x["b"]))), F.lit(0.0))


def _scores(model: Model, grams: Column) -> Column:
    """Probabilities per family of an array of n-grams."""
    table = F.create_map(*[x for g, w in model.weights.items() for x in (F.lit(g), F.array(*map(F.lit, w)))])
    known = F.array_distinct(F.filter(grams, lambda g: g.isin(list(model.weights))))
    total = F.aggregate(known, F.array(*map(F.lit, model.intercepts)),
                        lambda s, g: F.zip_with(s, F.element_at(table, g), lambda a, b: a + b))
    e = F.transform(total, lambda x: F.exp(x))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def _reach(following: Column) -> Column:
    """How many of the following lines (arrays of words) belong to a window: up
    to a blank line, while fewer than LONGEST words have followed."""
    def step(s, x):
        on = s["open"] & (F.size(x) > 0) & (s["words"] < LONGEST)
        return F.struct(on.alias("open"), (s["words"] + F.when(on, F.size(x)).otherwise(0)).alias("words"),
                        (s["n"] + F.when(on, 1).otherwise(0)).alias("n"))
    start = F.struct(F.lit(True).alias("open"), F.lit(0).alias("words"), F.lit(0).alias("n"))
    return F.aggregate(following, start, step, lambda s: s["n"])


def _near(lines: str) -> Column:
    """Array of (k, w, near): every line with its words, and with those of the
    lines around it, as far as a notice it belongs to can reach."""
    every = F.col(lines)

    def of(w, i):
        back = _reach(F.reverse(F.slice(every, F.greatest(i - LONGEST, F.lit(0)) + 1, F.least(i, F.lit(LONGEST)))))
        on = _reach(F.slice(every, i + 2, F.lit(LONGEST)))
        near = F.when(F.size(w) > 0, F.flatten(F.slice(every, i - back + 1, back + on + 1)))
        return F.struct(i.alias("k"), w.alias("w"), near.alias("near"))
    return F.transform(every, of)


def _windows(lines: str) -> Column:
    """Array of (paragraph, more, w): every line with its words (more = 0), and
    windows of it with ``more`` following lines. Windows start only at lines that
    bring a template's word pair; the others equal a shorter window's evidence."""
    every = F.col(lines)

    def of(w, i):
        following = F.slice(every, i + 2, F.lit(LONGEST))
        # the line's own pairs and the one across its end
        own = _bigrams(F.concat(w, F.slice(F.coalesce(F.get(following, F.lit(0)), F.array().cast("array<string>")), 1, 1)))
        more = F.when((F.size(w) > 0) & F.exists(own, lambda g: g.isin(ALL_PAIRS)), _reach(following)).otherwise(0)
        return F.transform(F.sequence(F.lit(0), more), lambda k: F.struct(
            i.alias("paragraph"), k.alias("more"), F.flatten(F.slice(every, i + 1, k + 1)).alias("w")))
    return F.flatten(F.transform(every, of))


def fit(docs: DataFrame) -> Model:
    """Model from the templates and a bounded sample of the corpus, its threshold from all lines."""
    return _fitted(docs)[0]


def _fitted(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The calibrated model and the corpus's lines, written once."""
    h, taken = _sampled(docs)
    model = _trained(docs, h, taken)
    lines = staged(_apart_lines(docs, model, h, taken))
    model.threshold = _calibrated(lines, model)
    return model, lines


def _trained(docs: DataFrame, h: Column, taken: Column) -> Model:
    """Model with a threshold yet to be calibrated."""
    spark = docs.sparkSession
    sample = (docs.where(taken)
              .select(h.alias("h"), F.transform(F.split("text", "\n"), _words).alias("lines"))
              .select("h", F.explode(_near("lines")).alias("x")).select("h", "x.*").where(F.size("w") > 0)
              # lines of a wrapped notice resemble a template only together
              .withColumn("b", _pairs_held("near")).withColumn("s", F.when(F.size("b") > 0, _similarity("b")).otherwise(0.0)).where("s < 0.5")
              .select(F.pmod(F.xxhash64("h", "k"), F.lit(2)).alias("part"), "w"))
    sample = staged(sample)
    pieces = []
    for family, texts in TEMPLATES.items():
        for text in texts:
            x = text.split()
            cuts = {text, " ".join(x[: max(3, len(x) * 2 // 3)]), " ".join(x[len(x) // 4:])}
            pieces += [(family, c) for c in sorted(cuts)]
    pieces += [(UNKNOWN, x) for x in NOT_LICENCES]
    families = [UNKNOWN, *TEMPLATES]
    every = sorted({g for xs in TEMPLATES.values() for x in xs for g in _local_grams(x)})
    words = [g for g in every if " " not in g]
    seen = (sample.select(F.explode(F.array_distinct(F.filter("w", lambda x: x.isin(words)))).alias("g"))
            .groupBy("g").agg(F.count(F.lit(1)).alias("n")))
    counts = {r["g"]: r["n"] for r in seen.collect()}        # at most the templates' words
    vocab = every
    taught = (spark.createDataFrame(pieces, "family string, p string").withColumn("w", _words(F.col("p")))
              .withColumn("weight", F.lit(1.0)).select("family", "w", "weight"))
    taught = taught.union(sample.where("part = 0").select(F.lit(UNKNOWN).alias("family"), "w", F.lit(0.1).alias("weight")))
    # a text without evidence is of the unknown class, whatever the sample holds
    taught = taught.union(spark.range(1).select(F.lit(UNKNOWN), F.array().cast("array<string>"), F.lit(NO_EVIDENCE)))
    grams = F.concat("w", _bigrams(F.col("w")))
    one_hot = F.transform(F.array(*map(F.lit, vocab)), lambda v: F.array_contains("g", v).cast("double"))
    label = F.array_position(F.array(*map(F.lit, families)), F.col("family")).cast("double") - 1
    # texts with the same features are one weighted row; most hold none
    held = F.array_sort(F.array_distinct(F.filter(grams, lambda x: x.isin(vocab))))
    rows = (taught.select("family", held.alias("g"), "weight").groupBy("family", "g").agg(F.sum("weight").alias("weight")))
    rows = staged(rows.select(label.alias("label"), one_hot.alias("x"), "weight").coalesce(4))
    lr = LogisticRegression(family="multinomial", elasticNetParam=1.0, regParam=REG, maxIter=200, standardization=False,
                            weightCol="weight")
    m = lr.fit(rows.select("label", "weight", array_to_vector("x").alias("features")))
    matrix = m.coefficientMatrix.toArray()
    weights = {g: [float(v) for v in matrix[:, i]] for i, g in enumerate(vocab) if matrix[:, i].any()}
    model = Model(families, [float(v) for v in m.interceptVector.toArray()], weights, counts, LEAST_PROBABILITY)
    u = families.index(UNKNOWN)
    if max(model.intercepts) > model.intercepts[u]:
        raise ValueError("the unknown class must be the likeliest one without evidence")
    return model


def _sampled(docs: DataFrame) -> tuple[Column, Column]:
    """A row's hash, and whether its document is in the fitted sample."""
    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    h = F.xxhash64(F.lit("licence"), F.col("doc_id").cast("string"), "text")
    return h, F.pmod(h, F.lit(1 << 20)) < int(share * (1 << 20))


def _other(k: Column) -> Column:
    """Whether line k did not fit the model."""
    return ~(F.col("taken") & (F.pmod(F.xxhash64("h", k), F.lit(2)) == 0))


def _apart_lines(docs: DataFrame, model: Model, h: Column | None = None, taken: Column | None = None) -> DataFrame:
    """The one pass over whole texts: uid, doc_id, paragraphs, lines outside the
    fit, and for texts with an anchor the words of all their lines."""
    d = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", (F.lit(0) if h is None else h).cast("long").alias("h"),
                    (F.lit(False) if taken is None else taken).alias("taken"), F.coalesce("text", F.lit("")).alias("t"))
    solid = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    n_other = F.filter(F.split("t", "\n"), lambda x, k: x.rlike("[A-Za-z0-9]") & _other(k))
    return d.select("uid", "doc_id", "h", "taken", F.size(solid).cast("long").alias("n_paragraphs"), F.size(n_other).cast("long").alias("n"),
                    F.when(_speaks(F.col("t"), _anchors(model)), F.transform(F.split("t", "\n"), _words)).alias("lines"))


def _calibrated(d: DataFrame, model: Model) -> float:
    """Least probability that at most FALSE_SHARE of all lines exceed which did
    not fit the model and do not belong to something like a template."""
    anchors = _anchors(model)
    spoken = F.filter(_near("lines"), lambda x: _other(x["k"]) & F.exists(x["w"], lambda g: g.isin(anchors)))
    total = d.agg(F.sum("n")).first()[0] or 0
    d = d.where("lines IS NOT NULL").select(F.explode(spoken).alias("x")).select("x.*")
    d = d.withColumn("s", _scores(model, F.concat("w", _bigrams(F.col("w")))))
    best = F.array_max(F.slice("s", 2, len(model.families) - 1))
    d = d.withColumn("p", F.when((best >= LEAST_PROBABILITY) & (best > F.get("s", F.lit(0))), best))
    d = d.withColumn("b", F.when(F.col("p").isNotNull(), _pairs_held("near")))
    d = d.withColumn("p", F.when(F.col("b").isNotNull() & (_similarity("b") < 0.5), F.col("p"))).where("p IS NOT NULL")
    # classes of a hundredth in log odds, a few thousand at most
    odds = F.ceil(100 * F.log(F.col("p") / F.greatest(1 - F.col("p"), F.lit(1e-16))))
    rows = d.groupBy(odds.alias("bin")).agg(F.count(F.lit(1)).alias("m")).collect()
    room = FALSE_SHARE * total
    for r in sorted(rows, key=lambda r: -r["bin"]):
        room -= r["m"]
        if room < 0:
            return max(LEAST_PROBABILITY, 1 / (1 + math.exp(-r["bin"] / 100)))
    return LEAST_PROBABILITY


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """One row per paragraph predicted as a licence: uid and doc_id of its text,
    paragraph number (of its first line), following lines, family, probability,
    similarity, confirmed."""
    return (_scan(_apart_lines(docs, model), model).select("uid", "doc_id", "n_paragraphs", F.explode("hits").alias("x"))
            .select("uid", "doc_id", "n_paragraphs", *[F.col(f"x.{c}").alias(c) for c in (
                "paragraph", "more", "family", "probability", "similarity", "confirmed")]))


def _scan(d: DataFrame, model: Model) -> DataFrame:
    """One row per text: uid, doc_id, n_paragraphs and its licence paragraphs ``hits``."""
    n, anchors = len(model.families), _anchors(model)
    d = d.select("uid", "doc_id", "n_paragraphs", "lines")
    d = d.withColumn("windows", F.when(F.col("lines").isNotNull(), _windows("lines"))).drop("lines")
    d = d.select("uid", "doc_id", "n_paragraphs", F.explode_outer("windows").alias("x")).select("uid", "doc_id", "n_paragraphs", "x.*")
    spoken = (F.size("w") > 0) & F.exists("w", lambda g: g.isin(anchors))
    d = d.withColumn("b", F.when(spoken, _pairs_held("w")))
    # a window of several lines counts only if it can be confirmed
    able = (F.col("more") == 0) | (F.size(F.array_distinct("b")) >= FEWEST)
    d = d.withColumn("s", F.when(spoken & able, _scores(model, F.concat("w", "b"))))       # features are words and pairs of templates
    best = F.array_max(F.slice("s", 2, n - 1))
    d = d.withColumn("probability", best)
    names = F.array(*map(F.lit, model.families))
    hit = (F.col("probability") >= model.threshold) & (F.col("probability") > F.get("s", F.lit(0)))
    d = d.withColumn("family", F.when(hit, F.element_at(names, F.array_position("s", F.col("probability")).cast("int"))))
    d = d.withColumn("similarity", F.when(F.col("family").isNotNull(), _similarity("b", F.col("family"))))
    d = d.withColumn("confirmed", F.col("similarity") >= LEAST_SIMILARITY)
    # ordered by first line, then the best window of that line
    one = F.struct("paragraph", (~F.col("confirmed")).alias("last"), (-F.col("similarity")).alias("far"), "more", "family", "probability",
                   "similarity", "confirmed")
    d = d.groupBy("uid").agg(F.first("doc_id").alias("doc_id"), F.first("n_paragraphs").alias("n_paragraphs"),
                             F.array_sort(F.collect_list(F.when(F.col("confirmed") | (F.col("family").isNotNull() & (F.col("more") == 0)),
                                                                one))).alias("hits"))
    d = d.withColumn("hits", F.filter("hits", lambda x, k: ~F.coalesce(F.get("hits", k - 1)["paragraph"] == x["paragraph"], F.lit(False))))
    return d.withColumn("hits", _needed("hits")).withColumn("hits", _apart("hits"))


def _end(x: Column) -> Column:
    return x["paragraph"] + x["more"]


def _needed(hits: str) -> Column:
    """Without windows whose first line adds nothing to the next line's window."""
    def spare(x, k):
        y = F.get(hits, k + 1)
        return F.coalesce((y["paragraph"] == x["paragraph"] + 1) & (x["more"] > 0) & y["confirmed"] & (y["family"] == x["family"])
                          & (_end(y) <= _end(x)) & (y["similarity"] >= x["similarity"]), F.lit(False))
    return F.filter(hits, lambda x, k: ~spare(x, k))


def _apart(hits: str) -> Column:
    """Without windows that a better one of their family overlaps, and without
    unconfirmed lines inside a confirmed window. A window has at most LONGEST
    further lines and every hit its own first line, so LONGEST neighbours on
    either side are all that can overlap."""
    def beaten(x, k):
        before = F.slice(hits, F.greatest(k - LONGEST, F.lit(0)) + 1, F.least(k, F.lit(LONGEST)))
        after = F.slice(hits, k + 2, F.lit(LONGEST))

        def over(y, better):
            return (y["confirmed"] & (y["paragraph"] <= _end(x)) & (_end(y) >= x["paragraph"])
                    & (~x["confirmed"] | ((y["family"] == x["family"]) & better)))
        return (F.exists(before, lambda y: over(y, y["similarity"] >= x["similarity"]))
                | F.exists(after, lambda y: over(y, y["similarity"] > x["similarity"])))
    return F.filter(hits, lambda x, k: ~beaten(x, k))


def scan_documents(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: its paragraphs, those predicted as licences, the
    confirmed families, and families of predictions without a matching template."""
    return _by_document(_scan(_apart_lines(docs, model), model))


def fit_and_scan(docs: DataFrame) -> DataFrame:
    """:func:`fit` and :func:`scan_documents` of one corpus, with a single pass
    over its texts for both the calibration and the scan."""
    model, lines = _fitted(docs)
    return _by_document(_scan(lines, model))


def _by_document(hits: DataFrame) -> DataFrame:
    def names(when) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(F.filter("hits", when), lambda x: x["family"]))), ",")
    return hits.select(
        "doc_id", "n_paragraphs", F.size("hits").cast("long").alias("n_licence_paragraphs"), names(lambda x: x["confirmed"]).alias("families"),
        names(lambda x: ~x["confirmed"]).alias("unconfirmed"), F.array_max(F.transform("hits", lambda x: x["probability"])).alias("probability"),
        F.array_max(F.transform("hits", lambda x: x["similarity"])).alias("similarity"))
