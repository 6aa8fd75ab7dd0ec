import random

import pytest

from flightrank.llm import licenses

FOUND = {
    "Licensed under the Apache License, Version 2.0.": "apache-2.0",
    "LICENSED UNDER THE APACHE LICENSE, VERSION 2.0": "apache-2.0",
    "Released under the MIT License.": "mit",
    "// This work is licensed under the GNU General Public License, version 3. //": "gpl-3.0",
    "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0",
    "  All rights reserved.  ": "all-rights-reserved",
}
CLEAN = [
    "The work under the general version is public and free for all.",
    "He took all of the right turns and reserved a table for three.",
    "in the and of this under version",
    "",
]


def prose(rng):
    words = "the a of under work this general free all version and table tree house public source code".split()
    words += [f"w{rng.randrange(300)}" for _ in range(40)]
    return " ".join(rng.choices(words, k=rng.randint(4, 40)))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    rows, planted = [], {}
    for i in range(400):
        lines = [prose(rng) for _ in range(rng.randint(1, 6))]
        if i % 20 == 0:
            text = list(FOUND)[(i // 20) % len(FOUND)]
            place = rng.randint(0, len(lines))
            lines.insert(place, text)
            planted[i, place] = FOUND[text]
        rows.append((i, "\n".join(lines)))
    return rows, planted


def test_planted_notices_are_found_and_clean_text_is_left_alone(docs, corpus):
    rows, planted = corpus
    odd = [(1000 + i, t) for i, t in enumerate(CLEAN)]
    odd += [(2000, None), (None, "All rights reserved."), (2001, "w " * 40_000 + "\nReleased under the MIT License.")]
    odd += [(2002, "All rights reserved.\n\nAll rights reserved."), (3, rows[3][1])]
    table = docs(*rows, *odd)
    found = licenses.scan(table, licenses.train(table)).collect()
    expected = {**planted, (None, 0): "all-rights-reserved", (2001, 1): "mit"}
    expected |= {(2002, 0): "all-rights-reserved", (2002, 2): "all-rights-reserved"}
    assert {(r.doc_id, r.paragraph): r.family for r in found} == expected
    assert all(r.probability >= 0.5 and r.coverage >= 0.7 for r in found)


def test_a_notice_of_no_known_licence_is_unknown(docs, corpus):
    rows, _ = corpus
    strange = "This program is licensed under the Example Public License, version 7."
    table = docs(*rows, (5000, strange))
    found = licenses.scan(table, licenses.train(table)).filter("doc_id = 5000").collect()
    assert [r.family for r in found] == ["unknown"]


def test_empty_table(docs):
    empty = docs((1, "x")).limit(0)
    assert licenses.scan(empty, licenses.train(empty)).collect() == []


def test_runs_without_python_on_the_executors(docs, corpus, capsys):
    table = docs(*corpus[0][:60])
    licenses.scan(table, licenses.train(table)).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan


def test_every_template_names_one_family():
    texts = [t for own in licenses.TEMPLATES.values() for t in own]
    assert len(texts) == len(set(texts))


GPL = """/*
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 *
 * It is distributed in the hope that it will be useful.
 */"""
MIT = """Some Title

# Permission is hereby granted, free of charge, to any person obtaining
# a copy of this software and associated documentation files (the
# "Software"), to deal in the Software without restriction."""


def test_wrapped_notices_are_found_as_blocks(docs, corpus):
    rows, _ = corpus
    table = docs(*rows, (6000, GPL), (6001, MIT))
    found = licenses.scan(table, licenses.train(table)).filter("doc_id >= 6000").collect()
    assert {(r.doc_id, r.paragraph, r.family) for r in found} == {(6000, 1, "gpl-3.0"), (6001, 2, "mit")}


NEIGHBOURS = [
    "This work is licensed under the GNU General Public License, version 2.",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "This work is licensed under a Creative Commons Attribution 3.0 International License.",
    "Licensed under the Apache License, Version 1.1.",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.",
]


def test_neighbouring_licences_are_unknown(docs, corpus):
    rows, _ = corpus
    table = docs(*rows, *((6000 + i, t) for i, t in enumerate(NEIGHBOURS)))
    found = licenses.scan(table, licenses.train(table)).filter("doc_id >= 6000").collect()
    assert {r.doc_id: r.family for r in found} == {6000 + i: "unknown" for i in range(len(NEIGHBOURS))}


def test_every_template_holds_its_own_terms_alone(spark):
    known = licenses.templates(spark)
    joined = known.select("family", licenses.F.array_join(licenses.words(licenses.F.col("text")), " ").alias("t"))
    each = [licenses.says(licenses.F.col("t"), f).alias(f) for f in licenses.TERMS]
    for row in joined.select("family", "t", *each).collect():
        assert [f for f in licenses.TERMS if row[f]] == [row.family], row.t


INDEPENDENT = {
    "// SPDX-License-Identifier: GPL-3.0-or-later": "gpl-3.0",
    "# SPDX-License-Identifier: BSD-2-Clause": "bsd",
    "SPDX-License-Identifier: EPL-2.0": "epl-2.0",
    "SPDX-License-Identifier: LGPL-2.1-or-later": "lgpl",
    "SPDX-License-Identifier: Zlib": "unknown",
    "SPDX-License-Identifier: GPL-2.0-only": "unknown",
    "License: MIT": "mit",
    "license: Apache-2.0": "apache-2.0",
    "License: Zlib": "unknown",
    "The MIT License (MIT)": "mit",
}


def test_tags_and_bare_names_written_apart_from_the_templates(docs, corpus):
    rows, _ = corpus
    table = docs(*rows, *((6000 + i, t) for i, t in enumerate(INDEPENDENT)), (7000, "He lost his license to drive."))
    found = licenses.scan(table, licenses.train(table)).filter("doc_id >= 6000").collect()
    assert {r.doc_id: r.family for r in found} == {6000 + i: f for i, f in enumerate(INDEPENDENT.values())}
