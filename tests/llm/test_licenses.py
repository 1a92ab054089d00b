import math
import random
from collections import Counter

from pyspark.sql import functions as F

from moodtide.llm import licenses as L

SCHEMA = "doc_id long, text string, where string"


def cosine(text, template):
    held = Counter(t for _, x in L.TEMPLATES for t in set(L.tokens_of(x)))
    idf = lambda t: math.log((1 + len(L.TEMPLATES)) / (1 + held[t])) + 1
    a, b = (({t: n * idf(t) for t, n in Counter(L.tokens_of(x)).items()}) for x in (text, template))
    dot = sum(x * b.get(t, 0) for t, x in a.items())
    norm = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
    return round(dot / norm, 6) if norm else 0.0


def best(text):
    top = max((cosine(text, x), name) for name, x in L.TEMPLATES)
    return top if top[0] >= L.COSINE else None


def brute(rows):
    files, out = {}, []
    folder = lambda p: ("/" + p).rsplit("/", 1)[0] + "/"
    judged = []
    for i, text, path in rows:
        whole = best(text) if text else None
        lines = [b for b in map(best, (text or "").split("\n")) if b]
        judged.append((i, path, whole, max(lines, default=None)))
        if whole and path is not None:
            files[folder(path)] = max(whole, files.get(folder(path), (0, "")))
    for i, path, whole, header in judged:
        found, top, up = ("file", whole, None) if whole else ("header", header, None) if header else (None, None, None)
        if not found and path is not None:
            at, steps = folder(path), 0
            while True:
                if at in files:
                    found, top, up = "inherited", files[at], steps
                    break
                if at == "/":
                    break
                at, steps = at.rstrip("/").rsplit("/", 1)[0] + "/", steps + 1
        out.append((i, path, top and top[1], top and top[0], found, up))
    return sorted(out, key=str)


def case():
    rng = random.Random(8)
    word = lambda: rng.choice("the of License under version 2 work BY is é 4 public MIT".split())
    rows = []
    for i in range(250):
        path = "/".join([rng.choice("abc") for _ in range(rng.randrange(0, 4))] + [f"f{i}"])
        prose = " ".join(word() for _ in range(rng.randrange(30)))
        licence = rng.choice(L.TEMPLATES)[1].split()
        if rng.random() < 0.4:
            licence[rng.randrange(len(licence))] = word()
        kind = rng.random()
        text = prose if kind < 0.6 else " ".join(licence).upper() if kind < 0.65 else f"{prose}\n {' '.join(licence)}\n{prose}"
        rows.append((i, text, path))
    text = L.TEMPLATES[5][1]
    return [*rows, (900, None, "a/x"), (901, "", "z/z/x"), (902, text, None), (903, text, "q/r/LICENSE"), (904, "no", "q/r/s/t/u"), (904, "no", "q/r/s/t/u"),
            (905, "no", "q/x"), (907, "no", None), (None, "no", "q/r/y"), (906, "the " * 50_000 + "\n" + text, "w")]


def test_equals_brute_force(spark):
    rows = case()
    out = L.scan_licenses(spark.createDataFrame(rows, SCHEMA).repartition(3), F.col("where"))
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == brute(rows)
    assert {r[4] for r in got} == {"file", "header", "inherited", None}


def test_native_and_empty(spark, plan_of):
    df = spark.createDataFrame([(1, "Released under the MIT License.", "a/b", "x", 1.0)], SCHEMA + ", token string, cosine double")
    out = L.scan_licenses(df, F.col("where"))
    assert "Python" not in plan_of(out) and "Arrow" not in plan_of(out)
    assert tuple(out.first()) == (1, "a/b", "MIT", 1.0, "file", None)
    assert L.scan_licenses(df.limit(0), F.col("where")).count() == 0


APACHE = """# Copyright 2020 The Authors
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
import os
"""
MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */
int main() { return 0; }
"""
GPL = """// This program is free software: you can redistribute it and/or modify
// it under the terms of the GNU General Public License as published by
// the Free Software Foundation, either version 3 of the License, or
// (at your option) any later version.
int x;
"""
GPL_FILE = """                    GNU GENERAL PUBLIC LICENSE
                       Version 3, 29 June 2007

 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>
 Everyone is permitted to copy and distribute verbatim copies
 of this license document, but changing it is not allowed.

                            Preamble
""" + "  The licenses for most software are designed to take away your freedom to share.\n" * 50


def test_licence_files_and_wrapped_headers(spark):
    mit = "MIT License\n\nCopyright (c) 2020 Jane Doe\n\n" + L.FILES[0][1].split("\n", 1)[1].replace(". ", ".\n\n")
    rows = [
        (1, mit, "m/LICENSE"), (2, "print(1)", "m/src/a"), (3, APACHE, "m/src/b"), (4, MPL, "c"), (5, GPL, "d"), (6, GPL_FILE, "g/COPYING"), (7, "x", "g/y"),
        (8, "# SPDX-License-Identifier: GPL-2.0-only OR MIT\ncode", "e"), (9, "Copyright 2001 X\nAll rights reserved.\n", "f"),
        (10, APACHE + "All rights reserved.\n", "h"), (11, "plain text of no licence", "i"),
    ]
    got = {r.doc_id: (r.license, r.found) for r in L.scan_licenses(spark.createDataFrame(rows, SCHEMA), F.col("where")).collect()}
    assert got == {
        1: ("MIT", "file"), 2: ("MIT", "inherited"), 3: ("Apache-2.0", "header"), 4: ("MPL-2.0", "header"), 5: ("GPL-3.0", "header"),
        6: ("GPL-3.0", "file"), 7: ("GPL-3.0", "inherited"), 8: ("GPL-2.0-only OR MIT", "header"), 9: (L.RESERVED, "header"),
        10: ("Apache-2.0", "header"), 11: (None, None),
    }
