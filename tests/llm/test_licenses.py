import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from barlake.llm import licenses
from tests.llm.conftest import awkward_rows

MIT = "Released under the MIT License."
GPL = "This work is licensed under the GNU General Public License, version 3."


def brute(sentence):
    """Best template and cosine by plain vectors."""
    split = lambda s: [t for t in re.split("[^a-z0-9]+", s.lower()) if t]
    total = len(licenses.TEMPLATES)
    df = Counter(t for _, s in licenses.TEMPLATES for t in set(split(s)))
    vector = lambda s: {t: n * (math.log((1 + total) / (1 + df[t])) + 1) for t, n in Counter(split(s)).items()}
    v = vector(sentence)
    best = []
    for name, s in licenses.TEMPLATES:
        w = vector(s)
        dot = sum(x * w.get(t, 0) for t, x in v.items())
        norm = math.sqrt(sum(x * x for x in v.values()) * sum(x * x for x in w.values()))
        best.append((-round(dot / norm, 6) if norm else 0.0, name))
    away, key = min(best)
    return away, key.split("#")[0]


def test_cosines_equal_brute_force(spark):
    sentences = [s for _, s in licenses.TEMPLATES] + [MIT.upper() + "!!", "licensed under", "license", "the license of x", GPL + " Or later."]
    df = spark.createDataFrame(list(enumerate(sentences)), "unit long, words string")
    got = {r["unit"]: (r["license"], r["cosine"]) for r in licenses.classify(df, 0.1).collect()}
    for i, s in enumerate(sentences):
        away, name = brute(s)
        if -away >= 0.1:
            assert got[i][0] == name and got[i][1] == pytest.approx(-away, abs=2e-6)
        else:
            assert i not in got


def commented(text, mark, width=70):
    import textwrap

    return "\n".join(f"{mark} {line}".rstrip() for line in textwrap.wrap(text, width))


def text_of(name):
    return dict(licenses.TEXTS)[name]


WORDINGS = {
    "gpl_title/COPYING": ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007\n Everyone is permitted to copy", "GPL-3.0"),
    "gpl2/COPYING": ("\t\t    GNU GENERAL PUBLIC LICENSE\n\t\t       Version 2, June 1991\n\n Preamble", "GPL-2.0"),
    "mpl/LICENSE": ("Mozilla Public License Version 2.0\n==================================\n\n1. Definitions", "MPL-2.0"),
    "bsd/a.c": ("/* BSD 3-Clause License */\n\nint x;", "BSD-3-Clause"),
    "spdx/a.rs": ("// SPDX-License-Identifier: MIT\n\nfn main() {}", "MIT"),
    "spdx/b.rs": ("# SPDX-License-Identifier: GPL-2.0-or-later\nimport os", "GPL-2.0"),
    "apache/a.go": (commented("Copyright 2020 The Authors. " + text_of("Apache-2.0"), "//") + "\n\npackage main", "Apache-2.0"),
    "gpl/a.py": ("#!/usr/bin/python\n" + commented(text_of("GPL-3.0"), "#") + "\n\nimport os", "GPL-3.0"),
    "lgpl/a.h": (commented(text_of("LGPL-2.1"), " *") + "\n\n#include", "LGPL-2.1"),
    "mpl/b.js": ("/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n * file, You can obtain one at http://mozilla.org/MPL/2.0/. */\n\nvar x;", "MPL-2.0"),
    # A licence file is compared as a whole; no word of it need be a cue.
    "mit/LICENSE": ("Copyright (c) 2021 Somebody Else\n\n" + text_of("MIT").replace(". ", ".\n\n"), "MIT"),
    "isc/LICENSE.md": ("Copyright 2021 Somebody\n\n" + text_of("ISC"), "ISC"),
    "bsd2/License.txt": ("Copyright 2021 Somebody. All rights reserved.\n\n" + text_of("BSD-2-Clause"), "BSD-2-Clause"),
    "bsd3/license": ("Copyright 2021 Somebody. All rights reserved.\n\n" + text_of("BSD-3-Clause"), "BSD-3-Clause"),
    "none/LICENSE": ("All rights are kept by the owner of this thing.", None),
    "none/a.py": ("# A licence to print money, they said, is what it was.\n\nx = 1", None),
}


def test_real_headers_titles_and_licence_files(spark):
    rows = [(i, path, text) for i, (path, (text, _)) in enumerate(WORDINGS.items())]
    files = spark.createDataFrame(rows + [(100, "mit/src/deep/x.py", "x = 1"), (101, "gpl_title/y.py", None)], "file_key long, path string, text string")
    found = {r["file_key"]: (r["license"], r["origin"]) for r in licenses.scan_licenses(files).collect()}
    assert {p: found[i][0] for i, p, _ in rows} == {p: name for p, (_, name) in WORDINGS.items()}
    assert found[100] == ("MIT", "inherited") and found[101] == ("GPL-3.0", "inherited")


def test_no_python_in_the_plan(spark):
    files = spark.createDataFrame(FILES, "file_key long, path string, text string")
    plan = licenses.scan_licenses(files)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


FILES = [
    (1, "repo/LICENSE", MIT),
    (2, "repo/src/a.py", "x = 1"),
    (3, "repo/src/deep/b.py", f"# {GPL}\ncode here"),
    (4, "/repo//vendor/COPYING.txt", f"Terms: {GPL} More words of the file."),
    (5, "repo/vendor/c/d.py", "no words"),
    (6, "other/e.py", "nothing"),
    (7, "other/notes", MIT + "\n" + GPL),
    (8, None, MIT),
    (9, None, None),
    (10, "repo/src/f.py", None),
    (11, "top", ""),
    (12, "other/g.py", None),
]


def test_inheritance_from_the_nearest_directory(spark):
    df = spark.createDataFrame(FILES, "file_key long, path string, text string")
    got = {r["file_key"]: (r["license"], r["origin"]) for r in licenses.scan_licenses(df).collect()}
    assert got == {
        1: ("MIT", "own"), 2: ("MIT", "inherited"), 3: ("GPL-3.0", "own"), 4: ("GPL-3.0", "own"),
        5: ("GPL-3.0", "inherited"), 6: ("GPL-3.0", "inherited"), 7: ("GPL-3.0", "own"), 8: ("MIT", "own"),
        9: (None, None), 10: ("MIT", "inherited"), 11: (None, None), 12: ("GPL-3.0", "inherited"),
    }


def test_odd_tables(clashing, empty):
    def as_files(d):
        return d.select(F.col("doc_id").alias("file_key"), F.lit("a/b").alias("path"), "*")

    rows = licenses.scan_licenses(as_files(clashing)).collect()
    assert len(rows) == len(awkward_rows()) and {r["license"] for r in rows} == {None}
    assert licenses.scan_licenses(as_files(empty)).count() == 0


def test_templates_without_a_licence_word_take_all_units(spark):
    """Headers and lines like a template that holds no cue word need none either."""
    own = {
        "bsd/a.c": (commented(text_of("BSD-2-Clause"), " *") + "\n\nint x;", "BSD-2-Clause"),
        "bsd/b.c": (commented(text_of("BSD-3-Clause"), "#") + "\n\nint y;", "BSD-3-Clause"),
        "isc/a.c": (commented(text_of("ISC"), "//") + "\n\nint z;", "ISC"),
        "cc/a.txt": ("Some words.\nCreative Commons Legal Code CC0 1.0 Universal\nMore words.", "CC0-1.0"),
        "some/a.c": ("Redistribution and use in source and binary forms are permitted by some.", None),
        "de/a.txt": ("Er kam mit.\nMit\n\nmit", None),
    }
    assert not any(re.search(licenses.CUES, text.lower()) for text, _ in own.values())
    rows = [(i, path, text) for i, (path, (text, _)) in enumerate(own.items())]
    files = spark.createDataFrame(rows, "file_key long, path string, text string")
    found = {r["path"]: r["license"] for r in licenses.scan_licenses(files).collect()}
    assert found == {path: name for path, (_, name) in own.items()}


@pytest.mark.parametrize("like", [0.0, 0.3, 0.75])
def test_early_filter_loses_no_unit(spark, like):
    """Parts of templates with other words between: what plain vectors find passes."""
    import random

    rng = random.Random(5)
    units = []
    for key in licenses.WORDLESS:
        split = dict(licenses.TEMPLATES)[key].split()
        for keep in (0.1, 0.3, 0.5, 0.6, 0.8, 0.95):
            units.append(" ".join(w for w in split if rng.random() < keep) + " others" * rng.randrange(3))
    df = spark.createDataFrame(list(enumerate(units)), "unit long, words string")
    passed = {r["unit"] for r in df.where(licenses._may_reach(F.col("words"), like)).collect()}
    found = {r["unit"] for r in licenses.classify(df, like, licenses.WORDLESS).collect()}
    assert found <= passed and len(found) > 5 and (len(passed) < len(units) or like < 0.75)
