"""The licence scan: what notices look like, and the cosines against brute force."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
import pytest
from llm_helpers import prose
from pyspark.sql import functions as F

from chartlake.llm import notices
from chartlake.llm.licenses import anchor, scan
from chartlake.llm.notices import templates, words_of

MIT = f"MIT License\n\nCopyright (c) 2021 Jane Doe\n\n{notices.PERMIT_MIT}\n\n{notices.REST_MIT}\n"
GPL = """/*
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 */
int main() {}"""
LGPL = GPL.replace("GNU General", "GNU Lesser General")

FOUND = [
    ("Copyright (c) 2020 Jane Doe. Released under the MIT License.", "MIT"),
    ("// This file is released under the MIT License. See LICENSE in the project root for details.", "MIT"),
    ("SPDX-License-Identifier: MIT", "MIT"),
    ("# SPDX-License-Identifier: GPL-3.0-only\n" + prose(1, 50), "GPL-3.0"),
    (prose(2, 80) + " Licensed under CC BY-NC 4.0. " + prose(3, 80), "CC-BY-NC-4.0"),
    ("Licensed under CC BY-NC-SA 4.0", "CC-BY-NC-SA-4.0"), ("licensed under cc by 4.0", "CC-BY-4.0"),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
    ("GNU Lesser General Public License, version 3", "LGPL-3.0"), ("GNU Affero General Public License, version 3", "AGPL-3.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("Distributed under the GNU General Public License v2.0", "GPL-2.0"), (GPL, "GPL-3.0"), (LGPL, "LGPL-3.0"),
    (GPL.replace("General", "Affero General"), "AGPL-3.0"), (LGPL.replace("version 3", "version 2.1"), "LGPL-2.1"), (MIT, "MIT"),
    (MIT.replace("\n", "\n// ").replace("Software", "Programme", 3), "MIT"),
    ("Copyright X\n" + notices.REDISTRIBUTE, "BSD-2-Clause"),
    (f"{notices.REDISTRIBUTE}\n{notices.ENDORSE}\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS", "BSD-3-Clause"),
    (f"{notices.PERMIT_ISC}\n\n{notices.REST_ISC}", "ISC"), (notices.UNENCUMBERED, "Unlicense"),
    ("Licensed under the\n * Apache License,\n * Version 2.0", "Apache-2.0"), ("Released under the Eclipse Public License, Version 2.0", "EPL-2.0"),
    ("To the extent possible under law, Jane Doe has waived all copyright and related or neighboring rights to this work.", "CC0-1.0"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "MPL-2.0"),
]
NOT_FOUND = [
    "The MIT is in Cambridge; a driving licence was released.", "SPDX-License-Identifier: Foo-1.0", "Licensed under a private licence.",
    "gnu general public", "version 2.0 of the programme", prose(9, 3000), "", None,
]


def scanned(spark, texts):
    files = spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(texts)], "path string, text string")
    return {r["path"]: r for r in scan(files, "path", "text", F.lit(False)).collect()}


def test_notices_are_found_anywhere_and_told_apart(spark):
    rows = scanned(spark, [t for t, _ in FOUND])
    assert {t: rows[f"f{i}"]["licence"] for i, (t, _) in enumerate(FOUND)} == dict(FOUND)


def test_other_texts_have_no_licence(spark):
    rows = scanned(spark, NOT_FOUND)
    assert {r["licence"] for r in rows.values()} == {None}


def test_scores_against_brute_force(spark):
    draw = random.Random(4)
    pool = [t for t, _ in FOUND] + [prose(i, 30) for i in range(5)]
    texts = []
    for i in range(60):
        own = words_of(" ".join(draw.sample(pool, 2)))
        for _ in range(draw.randint(0, 4)):
            own[draw.randrange(len(own))] = draw.choice(["the", "license", "under", "x", "3"])
        texts.append(" ".join(own))
    known = templates()
    held = Counter(w for t in texts for w in set(words_of(t)))
    weight = lambda w: math.log((1 + len(texts)) / (1 + held[w])) + 1 if w in vocabulary else math.log(1 + len(texts)) + 1
    vocabulary = {w for t in known for w in t.words}
    frequency = {w: held[w] for w in vocabulary}
    norm = lambda c: math.sqrt(sum((n * weight(w)) ** 2 for w, n in c.items()))
    want = {}
    for i, text in enumerate(texts):
        own, best = words_of(text), []
        for template in known:
            word, places = anchor(template, frequency)
            b = Counter(template.words)
            for at in [k for k, w in enumerate(own) if w == word]:
                for place in places:
                    a = Counter(own[max(0, at - place) : at - place + len(template.words)])
                    if set(template.named) <= set(a):
                        dot = sum(n * b[w] * weight(w) ** 2 for w, n in a.items())
                        score = round(dot / norm(a) / norm(b), 6)
                        if score >= 0.7:
                            best.append((-round(score, 1), -len(template.words), -score, template.licence))
        want[f"f{i}"] = min(best, default=(None, None))[:1:-1] if best else (None, None)
    rows = scanned(spark, texts)
    for path, (licence, less) in want.items():
        assert rows[path]["licence"] == licence
        assert rows[path]["score"] == (None if less is None else pytest.approx(-less, abs=2e-6))


def test_templates_are_found_as_their_own_licence(spark):
    known = templates()
    rows = scanned(spark, [" ".join(t.words) for t in known])
    wrong = [(t.licence, " ".join(t.words), rows[f"f{i}"]["licence"]) for i, t in enumerate(known) if rows[f"f{i}"]["licence"] != t.licence]
    assert wrong == []
