"""Lines as people write them, expressions of several licences, and a model that guesses wrong."""

import dataclasses
import random

import pytest

from flightrank.llm import licenses

WRITTEN = {
    "ISC License": {"isc"},
    "Licensed under GPL-3.0.": {"gpl-3.0"},
    "This project is MIT licensed.": {"mit"},
    "Code under Apache-2.0": {"apache-2.0"},
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice appears.": {"isc"},
    "This is free and unencumbered software released into the public domain.": {"unlicense"},
    "SPDX-License-Identifier: MIT OR Apache-2.0": {"mit", "apache-2.0"},
    "SPDX-License-Identifier: (MIT AND BSD-3-Clause)": {"mit", "bsd"},
    "Distributed under the terms of the GNU GPL v2 or later.": {"unknown"},
    "He got his fishing license and came back to the general public.": set(),
    "She was granted permission to use the library of this work.": set(),
}


@pytest.fixture(scope="module")
def trained(spark):
    rng = random.Random(4)
    words = "the a of under work this general free all version and table tree house public source code".split()
    rows = [(i, " ".join(rng.choices(words + [f"w{k}" for k in range(60)], k=rng.randint(5, 40)))) for i in range(300)]
    rows += [(1000 + i, t) for i, t in enumerate(WRITTEN)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).cache()
    return table, licenses.train(table)


def by_document(rows):
    found = {}
    for r in rows:
        found.setdefault(r.doc_id, set()).add(r.family)
    return found


def test_lines_as_people_write_them(trained):
    table, scanner = trained
    found = by_document(licenses.scan(table, scanner).collect())
    assert found == {1000 + i: f for i, f in enumerate(WRITTEN.values()) if f}


def test_a_model_with_its_families_mixed_up_confirms_nothing(trained):
    """The templates confirm what the model predicts; they do not decide."""
    table, scanner = trained
    names = scanner.families
    mixed = dataclasses.replace(scanner, families=[names[0], *names[2:], names[1]])
    assert {r.family for r in licenses.scan(table, mixed).collect()} <= {licenses.UNKNOWN}


def test_every_wording_of_the_terms_holds_a_cue(spark):
    known = licenses.templates(spark)
    assert known.filter(~licenses.F.col("text").rlike(licenses.CUES)).collect() == []
