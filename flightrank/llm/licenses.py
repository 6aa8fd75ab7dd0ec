"""License scans with a trained paragraph classifier.

A paragraph is a line of a text, or a block of lines without a blank one among
them, joined, so that wrapped notices are judged as a whole; it has the number of
its first line. A block is reported for what none of its lines tells alone. Its features are the words and word pairs of
the templates that occur in it, any other word counts for nothing. A sparse
multinomial logistic regression tells licence families and ordinary text apart.
It is fitted on the templates, each also with one word left out, on sentences
that use the words of licences for other things (``OTHERWISE``), and on the
paragraphs of a bounded sample of documents (``SAMPLE_DOCS``, the first by a
hash of the id) that resemble no template. A fifth of the rows, whole templates
apart, is kept from the fit and calibrates the probability that a paragraph is a
licence at all.

A family is reported if the model predicts it, the calibrated probability of a
licence reaches ``THRESHOLD``, and the paragraph confirms it: it holds
``COVERAGE`` of the word pairs of one of the family's templates and the family's
``TERMS``, by which it differs from its neighbours. The model predicts the family
it finds likeliest and others to which it gives a share of ``GUESS``, for
paragraphs with several notices. A paragraph that is probably a licence, but
confirms a template only by ``UNKNOWN_COVERAGE``, is ``unknown``, and so is any
that is tagged as a licence (``EVIDENCE``) and confirms no family. An expression of
several identifiers behind a tag is judged identifier by identifier.

A paragraph has to hold one of the ``CUES``, words without which no notice of a
licence does; every wording among ``TERMS`` holds one. They are looked for in the
raw text first, so most texts are never cut into words. Scanning reads every
whole text; only paragraphs that may be reported are shuffled, by block; the
model has one weight per family and feature of the templates.

Defined results: null and empty texts have no paragraphs with a licence; a
paragraph of any length is judged as a whole; rows that repeat are each scanned;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SAMPLE_DOCS = 2000
THRESHOLD = 0.5
COVERAGE = 0.7
UNKNOWN_COVERAGE = 0.1
FIT_PARTITIONS = 4
GUESS = 0.15
ORDINARY = "none"
UNKNOWN = "unknown"

# Notices by which licences are named, by family.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
        "Distributed under the terms of the GNU GPL v3 or later.",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Licensed under the BSD 3-Clause License.",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "cc-by-nc-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc0": ["This work is dedicated to the public domain under CC0 1.0 Universal."],
    "epl-2.0": [
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License 2.0",
    ],
    "agpl-3.0": ["This program is licensed under the GNU Affero General Public License, version 3."],
    "isc": [
        "ISC License",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted",
    ],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
    "all-rights-reserved": ["All rights reserved.", "Copyright. All rights reserved."],
}


# SPDX identifiers, as tags and after "License:".
IDENTIFIERS = {
    "apache-2.0": ["Apache-2.0"],
    "mit": ["MIT"],
    "gpl-3.0": ["GPL-3.0-only", "GPL-3.0-or-later", "GPL-3.0"],
    "lgpl": ["LGPL-3.0-only", "LGPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-2.1"],
    "bsd": ["BSD-3-Clause", "BSD-2-Clause"],
    "mpl-2.0": ["MPL-2.0"],
    "cc-by-nc-4.0": ["CC-BY-NC-4.0"],
    "cc-by-4.0": ["CC-BY-4.0"],
    "cc0": ["CC0-1.0"],
    "epl-2.0": ["EPL-2.0"],
    "agpl-3.0": ["AGPL-3.0-only", "AGPL-3.0-or-later", "AGPL-3.0"],
    "isc": ["ISC"],
    "unlicense": ["Unlicense"],
}
# How an identifier is named in a line of its own.
WORDINGS = (
    "SPDX-License-Identifier: {}",
    "License: {}",
    "Licensed under {}.",
    "Code under {}",
    "This project is {} licensed.",
)
for _family, _ids in IDENTIFIERS.items():
    TEMPLATES[_family] += [w.format(i) for i in _ids for w in WORDINGS]

# Sentences with the words of licences that grant nothing; the model learns them as ordinary text.
OTHERWISE = [
    "He got his fishing license and told the general public about it.",
    "She lost her license to drive after the accident.",
    "The library is open to the general public free of charge.",
    "All of the rights of the people were reserved for the few.",
    "A copy of the software was found in the source of the problem.",
    "The terms of the agreement were made available to the public.",
    "This version of the work is distributed in the hope of peace.",
    "You may not use this file as a source for the library.",
    "The foundation published a free program for the public domain of art.",
    "The apache helicopter is a version of an older work.",
    "The eclipse was public and the mozilla crowd was free.",
    "Permission to enter the building is granted to any person with a copy of the form.",
    "The license plate is under the car.",
    "A driver needs a license and the general public needs roads.",
    "His license to sell fish was taken by the general.",
    "They asked the public for a license to build.",
    "The hunting license of the general is free.",
    "The work is dedicated to the public.",
    "The creative commons of the town are open to everyone.",
    "Redistribution of wealth is a matter of public use.",
]

# What every notice holds: one of these words, or "cc" with "by" after it.
CUES = (
    r"(?i)licen[sc]|spdx|rights|gplv|gpl-|apache-2|mpl-2|epl-2|bsd-|cc0|cc[^a-z]+by|attribution"
    r"|redistribution|obtaining|under mit|under isc|permission|unencumbered|\bgpl\b"
)

# Words, joined, that tell of a licence whatever its name: a tag, or a line "License: name".
EVIDENCE = r"(?:^| )spdx-license-identifier |^licen[sc]e \S+$"

# What a text must say, as its words joined by single spaces, to name a family: the terms
# by which the family differs from its neighbours.
_GPL = r"(?:(?<!lesser )(?<!library )(?<!affero )general public license(?: as published by the free software foundation)?"
TERMS = {
    "apache-2.0": r"apache(?: software)? license(?: version)? v?2(?:\.0)?|apache-2\.0",
    "mit": r"mit licensed?|to any person obtaining a copy of this software and associated documentation files"
    r"|(?:license|spdx-license-identifier|under) mit",
    "gpl-3.0": _GPL + r"(?: either)?(?: version)? (?:v ?)?3(?:\.0)?)|gpl-3\.0(?:-only|-or-later)?|gplv3|gpl v3",
    "lgpl": r"(?:lesser|library) general public license|lgpl-(?:2\.0|2\.1|3\.0)(?:-only|-or-later)?|lgplv?[23]?",
    "bsd": r"redistribution and use in source and binary forms with or without modification are permitted"
    r"|bsd(?: [234]-clause)? license|bsd-[234]-clause",
    "mpl-2.0": r"mozilla public license(?: version)?(?: v\.?)? ?v?2(?:\.0)?|mpl-2\.0",
    "cc-by-nc-4.0": r"cc by-nc 4\.0|cc-by-nc-4\.0|attribution-noncommercial 4\.0",
    "cc-by-4.0": r"cc by 4\.0|cc-by-4\.0|creative commons attribution 4\.0",
    "cc0": r"cc0(?: 1\.0)?|cc0-1\.0",
    "epl-2.0": r"eclipse public license(?: version)?(?: v\.?)? ?v?2(?:\.0)?|epl-2\.0",
    "agpl-3.0": r"affero general public license(?: as published by the free software foundation)?(?: either)?"
    r"(?: version)? (?:v ?)?3(?:\.0)?|agpl-3\.0(?:-only|-or-later)?",
    "isc": r"isc licensed?|(?:license|spdx-license-identifier|under) isc"
    r"|permission to use copy modify and or distribute this software for any purpose",
    "unlicense": r"unencumbered software released into the public domain|(?:license|spdx-license-identifier|under) unlicense"
    r"|unlicense licensed",
    "all-rights-reserved": r"all rights reserved",
}


def says(text: Column, family: str) -> Column:
    """Whether the joined words hold a family's terms, as whole words."""
    return F.concat(F.lit(" "), text, F.lit(" ")).rlike(f" (?:{TERMS[family]}) ")


def words(text: Column) -> Column:
    """Lower-case words; a hyphen or point inside a word is part of it."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*"), F.lit(0))


def pairs(tokens: Column) -> Column:
    """Neighbouring words, joined by a space."""
    rest = F.slice(tokens, 2, F.greatest(F.size(tokens) - 1, F.lit(0)))
    both = F.zip_with(tokens, rest, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.filter(both, lambda x: x.isNotNull())


def paragraphs(docs: DataFrame) -> DataFrame:
    """``doc_id, paragraph, text`` of every line that is not blank."""
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("paragraph", "text"))
    return lines.filter(F.length(F.trim("text")) > 0)


def blocks(docs: DataFrame) -> DataFrame:
    """``doc_id, lines`` of every block of lines with a cue: ``at``, the line's place in the text, and
    its ``tokens``. Lines without a letter or digit, such as empty ones of a comment, end a block.
    """
    lines = F.transform(
        F.split("text", "\n"),
        lambda x, i: F.when(x.rlike(r"[\p{L}\p{N}]"), F.concat(i.cast("string"), F.lit("\t"), x)).otherwise(F.lit("")),
    )
    cued = docs.filter(F.col("text").rlike(CUES))
    each = cued.select("doc_id", F.explode(F.split(F.array_join(lines, "\n"), "\n\n+")).alias("block"))
    numbered = F.filter(F.split("block", "\n"), lambda x: F.length(x) > 0)
    made = F.transform(
        numbered,
        lambda x: F.struct(
            F.substring_index(x, "\t", 1).cast("int").alias("at"),
            words(F.regexp_replace(x, r"^\d+\t(?:\W*(?i:dnl|rem)\s)?", "")).alias("tokens"),
        ),
    )
    # The one-element explode makes the words of a block once, not for each use.
    return each.filter(F.col("block").rlike(CUES)).select("doc_id", F.explode(F.array(made)).alias("lines"))


def templates(spark: SparkSession) -> DataFrame:
    rows = [(family, text) for family, texts in TEMPLATES.items() for text in texts]
    return spark.createDataFrame(rows, "family string, text string")


def _coverage(held: Column, wanted: Column) -> Column:
    """The share of a template's word pairs that a paragraph holds."""
    return F.size(F.array_intersect(held, wanted)) / F.size(wanted)


def _template_pairs() -> dict[str, list[Column]]:
    """The word pairs of each family's templates, as literal arrays."""
    made = {}
    for family, texts in TEMPLATES.items():
        made[family] = [F.array_distinct(pairs(words(F.lit(t)))) for t in texts]
    return made


def _resembles(held: Column, by_family: dict[str, list[Column]]) -> Column:
    """The best coverage over all templates."""
    every = [_coverage(held, w) for wanted in by_family.values() for w in wanted]
    return F.greatest(*every)


@dataclass
class Scanner:
    """A fitted model: words to counts, counts to families, and its calibration."""

    families: list[str]  # by class number; the first is ordinary text
    counts: CountVectorizerModel
    model: LogisticRegressionModel
    slope: float
    constant: float
    shares: dict[str, float]  # of each word pair, its largest share of a template


def _measured(texts: DataFrame, counts: CountVectorizerModel) -> DataFrame:
    tokens = texts.withColumn("_words", words(F.col("text")))
    both = tokens.withColumn("_pairs", F.array_distinct(pairs(F.col("_words"))))
    return counts.transform(both.withColumn("_terms", F.concat("_words", "_pairs"))).drop("_words", "_terms")


def _evidence(ordinary: Column) -> Column:
    """Log-odds that a paragraph is a licence."""
    p = F.greatest(F.least(ordinary, F.lit(1 - 1e-9)), F.lit(1e-9))
    return F.log((1 - p) / p)


def train(docs: DataFrame) -> Scanner:
    """Fit on the templates and on a bounded sample of ``docs``."""
    spark = docs.sparkSession
    known = templates(spark)
    own = known.select("family", words(F.col("text")).alias("w"))
    # Each template whole, and with each one of its words left out.
    variants = own.select(
        "family",
        "w",
        F.explode(F.sequence(F.lit(0), F.size("w"))).alias("left_out"),
    ).select(
        "family",
        F.array_join(F.filter("w", lambda x, i: i + 1 != F.col("left_out")), " ").alias("text"),
        (F.col("left_out") == 0).alias("whole"),
    )
    # The vocabulary is that of the templates, some hundred terms.
    terms = own.select(F.explode(F.concat("w", pairs(F.col("w")))).alias("term")).distinct()
    vocabulary = sorted(r[0] for r in terms.collect())
    counts = CountVectorizerModel.from_vocabulary(vocabulary, "_terms", "features")
    counts.setBinary(True)

    # A template's word pairs, some ten each.
    of_templates = own.select(F.array_distinct(pairs(F.col("w"))).alias("held")).collect()
    shares: dict[str, float] = {}
    for row in of_templates:
        for pair in row.held:
            shares[pair] = max(shares.get(pair, 0.0), 1 / len(row.held))

    ids = docs.select("doc_id").filter(F.col("doc_id").isNotNull()).distinct()
    chosen = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    # At most SAMPLE_DOCS ids.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left_semi")
    ordinary = paragraphs(sample).select(F.lit(ORDINARY).alias("family"), "text").distinct()
    # A line without a cue is no notice, however many pairs it holds; the model has to learn such lines.
    alike = _resembles(pairs(words(F.col("text"))), _template_pairs()) >= COVERAGE / 2
    ordinary = ordinary.filter(~F.col("text").rlike(CUES) | ~alike)

    otherwise = spark.createDataFrame([(ORDINARY, t) for t in OTHERWISE], "family string, text string")
    ordinary = ordinary.unionByName(otherwise).withColumn("whole", F.lit(False))

    families = [ORDINARY, *TEMPLATES]
    number = F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family")) - 1
    blank = spark.createDataFrame([(ORDINARY, "", False)], "family string, text string, whole boolean")
    rows = _measured(variants.unionByName(ordinary).unionByName(blank), counts)
    kept = F.when(F.col("whole"), F.lit(None)).otherwise(F.pmod(F.xxhash64("text"), F.lit(5)) == 0)
    rows = rows.select(number.cast("double").alias("label"), "features", F.coalesce(kept, F.lit(False)).alias("kept"))
    rows = rows.repartition(FIT_PARTITIONS).persist()  # a bounded number of short rows
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    weight = F.lit(1.0)
    for label, n in sizes.items():
        weight = F.when(F.col("label") == label, F.lit(1.0 / n)).otherwise(weight)
    weighted = rows.withColumn("weight", weight * sum(sizes.values()) / len(sizes))
    fitted = LogisticRegression(
        family="multinomial", regParam=0.002, elasticNetParam=0.5, maxIter=40, weightCol="weight"
    ).fit(weighted.filter("not kept"))

    judged = fitted.transform(weighted.filter("kept"))
    known_or_not = judged.select(
        (F.col("label") > 0).cast("double").alias("label"),
        array_to_vector(F.array(_evidence(vector_to_array("probability")[0]))).alias("features"),
        "weight",
    )
    # Both kinds are there: the blank paragraph and a template, wherever their hashes fall.
    ends = spark.createDataFrame([(0.0, -10.0, 1.0), (1.0, 10.0, 1.0)], "label double, x double, weight double")
    ends = ends.select("label", array_to_vector(F.array("x")).alias("features"), "weight")
    calibrated = LogisticRegression(regParam=0.001, maxIter=20, weightCol="weight").fit(known_or_not.unionByName(ends))
    rows.unpersist()
    return Scanner(families, counts, fitted, float(calibrated.coefficients[0]), float(calibrated.intercept), shares)


def _named_by(line: Column) -> Column:
    """The units of a line: itself, or the identifiers of its expression, each behind the tag."""
    tokens = line["tokens"]
    tag = "spdx-license-identifier"
    ids = F.filter(tokens, lambda t: ~t.isin("or", "and", "with", tag))
    tagged = (F.get(tokens, F.lit(0)) == tag) & (F.size(ids) > 1)

    def unit(own: Column) -> Column:
        return F.struct(line["at"].alias("at"), F.lit(True).alias("line"), own.alias("tokens"))

    return F.when(tagged, F.transform(ids, lambda i: unit(F.array(F.lit(tag), i)))).otherwise(F.array(unit(tokens)))


def scan(docs: DataFrame, scanner: Scanner) -> DataFrame:
    """A row per licence paragraph: ``doc_id paragraph family probability coverage``."""
    each = blocks(docs).withColumn("tokens", F.flatten("lines.tokens"))
    # The shares of a paragraph's pairs add up to no less than its coverage of any template.
    # Most paragraphs cannot reach the least coverage that is reported, so they are not judged.
    share = F.create_map(*[F.lit(x) for item in sorted(scanner.shares.items()) for x in item])
    known = F.array_intersect(pairs(F.col("tokens")), F.map_keys(share))
    at_most = F.aggregate(known, F.lit(0.0), lambda total, pair: total + F.element_at(share, pair))
    # A line holds no pair that its block does not hold.
    named = F.arrays_overlap("tokens", F.array(*[F.lit(w) for w in ("spdx-license-identifier", "license", "licence")]))
    possible = each.filter((at_most >= UNKNOWN_COVERAGE - 1e-9) | named).withColumn("_block", F.monotonically_increasing_id())
    own = F.flatten(F.transform("lines", _named_by))
    whole = F.array(F.struct(F.col("lines")[0]["at"].alias("at"), F.lit(False).alias("line"), "tokens"))
    units = F.when(F.size("lines") > 1, F.concat(own, whole)).otherwise(own)
    units = possible.select("doc_id", "_block", F.explode(units).alias("unit"))
    units = units.select("doc_id", "_block", F.col("unit.at").alias("paragraph"), "unit.line", F.col("unit.tokens").alias("tokens"))
    evident = F.col("text").rlike(EVIDENCE)
    units = units.withColumn("text", F.array_join("tokens", " ")).filter(F.col("text").rlike(CUES))
    units = units.filter((at_most >= UNKNOWN_COVERAGE - 1e-9) | evident)
    units = units.drop("tokens")
    judged = scanner.model.transform(_measured(units, scanner.counts)).withColumn("p", vector_to_array("probability"))
    licence = 1 / (1 + F.exp(-(F.lit(scanner.slope) * _evidence(F.col("p")[0]) + scanner.constant)))
    likely = judged.select("doc_id", "_block", "paragraph", "line", "text", "p", "_pairs", licence.alias("probability"))
    likely = likely.withColumn("evident", evident)
    likely = likely.select(F.inline(F.array(F.struct(*likely.columns)))).filter((F.col("probability") >= THRESHOLD) | F.col("evident"))
    of_families = F.slice("p", 2, len(scanner.families) - 1)
    best = F.array_position("p", F.array_max(of_families))
    names = F.array(*[F.lit(f) for f in scanner.families])
    guess = F.element_at(names, best.cast("int"))
    shares = F.arrays_zip(F.slice(names, 2, len(scanner.families) - 1).alias("family"), of_families.alias("p"))
    likely_ones = F.filter(shares, lambda x: x["p"] >= GUESS * (1 - F.get(F.col("p"), F.lit(0))))
    predicted = F.array_union(F.array(guess), F.transform(likely_ones, lambda x: x["family"]))
    each = [
        F.struct(F.lit(family).alias("family"), F.greatest(*own, F.lit(0.0)).alias("coverage"), says(F.col("text"), family).alias("says"))
        for family, own in (
            (f, [_coverage(F.col("_pairs"), w) for w in wanted]) for f, wanted in _template_pairs().items()
        )
    ]
    named = likely.select("*", guess.alias("guess"), predicted.alias("predicted"), F.array(*each).alias("each"))
    # The one-element inline computes these once, not for each use inside a lambda.
    kept = [c for c in named.columns if c not in ("p", "_pairs", "text")]
    named = named.select(F.inline(F.array(F.struct(*kept))))
    confirmed = F.filter(
        "each",
        lambda x: F.array_contains(F.col("predicted"), x["family"])
        & x["says"]
        & (x["coverage"] >= COVERAGE)
        & (F.col("probability") >= THRESHOLD),
    )
    sure = F.transform(confirmed, lambda x: F.struct(x["family"].alias("family"), x["coverage"].alias("coverage")))
    guessed = F.filter("each", lambda x: (x["family"] == F.col("guess")) & ((x["coverage"] >= UNKNOWN_COVERAGE) | F.col("evident")))
    vague = F.transform(guessed, lambda x: F.struct(F.lit(UNKNOWN).alias("family"), x["coverage"].alias("coverage")))
    found = named.withColumn("found", F.explode(F.when(F.size(sure) > 0, sure).otherwise(vague)))
    found = found.select("doc_id", "_block", "paragraph", "line", "found.*", "probability")
    # Only what is reported meets by block: a block tells what its lines alone do not.
    inside = Window.partitionBy("_block")
    by_lines = F.collect_set(F.when(F.col("line"), F.col("family"))).over(inside)
    by_block = F.max(~F.col("line") & (F.col("family") != UNKNOWN)).over(inside)
    lines_know = F.max(F.col("line") & (F.col("family") != UNKNOWN)).over(inside)
    told = found.select("*", by_lines.alias("_lines"), (by_block & ~lines_know).alias("_wrapped"), lines_know.alias("_known"))
    of_line = F.col("line") & ~((F.col("family") == UNKNOWN) & F.col("_wrapped"))
    new = ~F.array_contains("_lines", F.col("family")) & ~((F.col("family") == UNKNOWN) & F.col("_known"))
    told = told.filter(of_line | (~F.col("line") & new))
    return told.select("doc_id", "paragraph", "family", "probability", "coverage")
