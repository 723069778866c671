"""Licences of files: sparse TF-IDF cosine to templates, inheritance along directories.

Built from DataFrame operations alone. Three kinds of units are compared with the
templates (statements, titles, identifier lines, headers, texts of short licences) as
sparse TF-IDF vectors: sentences and lines; the header block of a file, its lines down to
the first blank one as one vector; and the whole text of a file with a licence's file
name. A template that names licensing (``CUES``) takes only sentences and headers that do
so too: the German "mit" alone has a cosine of 0.95 to "The MIT License (MIT)". The
templates that do not (``WORDLESS``) take all units. A
unit is one row a token, joined with the weighted tokens of the templates. Equal units
are compared once, however often they occur. A file without a statement of
its own takes that of the nearest directory above it that holds a licence file;
directories are resolved once each, by joins of paths, not file by file.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.scratch import written

# Usual statements of public licences.
STATEMENTS: tuple[tuple[str, str], ...] = (
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause Simplified License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause New or Revised License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
# Titles, as licence files begin.
TITLES: tuple[tuple[str, str], ...] = (
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("ISC", "ISC License"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
)
# Headers of source files and texts of short licences.
_GNU = (
    "This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {name}"
    "General Public License as published by the Free Software Foundation, either version {version} of the License,"
    " or (at your option) any later version. This {thing} is distributed in the hope that it will be useful, but"
    " WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    " See the GNU {name}General Public License for more details. You should have received a copy of the GNU {name}"
    "General Public License along with this {thing}."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
    " following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list"
    " of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright"
    " notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided"
    " with the distribution. {third}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY"
    " EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS"
    " FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY"
    " DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,"
    " PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED"
    " AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)"
    " ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
    " products derived from this software without specific prior written permission. "
)
TEXTS: tuple[tuple[str, str], ...] = (
    ("AGPL-3.0", _GNU.format(thing="program", name="Affero ", version="3")),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless"
        " required by applicable law or agreed to in writing, software distributed under the License is distributed on an"
        " \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the"
        " specific language governing permissions and limitations under the License.",
    ),
    ("BSD-2-Clause", _BSD.format(third="")),
    ("BSD-3-Clause", _BSD.format(third=_THIRD)),
    ("GPL-2.0", _GNU.format(thing="program", name="", version="2")),
    ("GPL-3.0", _GNU.format(thing="program", name="", version="3")),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE"
        " IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED"
        " WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,"
        " INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER"
        " IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR"
        " PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("LGPL-2.1", _GNU.format(thing="library", name="Lesser ", version="2.1")),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and"
        " to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above"
        " copyright notice and this permission notice shall be included in all copies or substantial portions of the"
        " Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT"
        " LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT"
        " SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION"
        " OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER"
        " DEALINGS IN THE SOFTWARE.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,"
        " use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any"
        " purpose, commercial or non-commercial, and by any means.",
    ),
)
#: Identifiers besides the names above; every name and identifier gives a line of its own.
IDENTIFIERS: tuple[tuple[str, str], ...] = tuple(
    (name, f"{name}-{end}") for name in ("AGPL-3.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0") for end in ("only", "or-later")
)


def _templates() -> tuple[tuple[str, str], ...]:
    """(key, words); the key is the name of the licence, # and a number."""
    known = [*STATEMENTS, *TITLES, *TEXTS]
    names = sorted({name for name, _ in known})
    lines = [(n, n) for n in names] + list(IDENTIFIERS)
    known += [(name, f"SPDX-License-Identifier: {identifier}") for name, identifier in lines]
    return tuple((f"{name}#{i:02d}", words) for i, (name, words) in enumerate(known))


TEMPLATES = _templates()
#: Words that name licensing (in lower case).
CUES = "licen[sc]e|public domain|mozilla public|spdx"
#: Keys of the templates without such a word: texts of BSD and ISC licences, the title of CC0.
WORDLESS = tuple(key for key, words in TEMPLATES if not re.search(CUES, words.lower()))
#: Least cosine of a statement.
LIKE = 0.75
#: Base names of licence files (in lower case).
FILE_NAMES = r"^(un)?licen[sc]e([.-].*)?$|^copying([.-].*)?$|^notice([.-].*)?$"
#: Copies of the directory table over which a directory with very many files is spread.
SALTS = 32


def _tokens(text: str | Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda t: t != "")


def _word_squares() -> dict[str, dict[str, float]]:
    """The squared weights of the words in the unit vector of every template."""
    counts = {key: Counter(t for t in re.split("[^a-z0-9]+", words.lower()) if t) for key, words in TEMPLATES}
    held = Counter(t for c in counts.values() for t in c)
    idf = {t: math.log((1.0 + len(TEMPLATES)) / (1 + n)) + 1 for t, n in held.items()}
    totals = {key: sum((n * idf[t]) ** 2 for t, n in c.items()) for key, c in counts.items()}
    return {key: {t: (n * idf[t]) ** 2 / totals[key] for t, n in c.items()} for key, c in counts.items()}


def _may_reach(words: Column, like: float, keys: Sequence[str] = WORDLESS) -> Column:
    """False only for words whose cosine to every template in ``keys`` is below ``like``.

    By the Cauchy-Schwarz inequality the squared cosine to a template is at most the sum
    of its squared weights over the distinct words in common. The weights are rounded up.
    """
    squares = _word_squares()
    # Cosines are rounded to six digits before they are judged.
    least = 1000 * max(like - 1e-6, 0.0) ** 2

    def reaches(known: Column, key: str) -> Column:
        same: dict[int, list[str]] = {}
        for word, square in squares[key].items():
            same.setdefault(math.ceil(1000 * square), []).append(word)

        def worth(word: Column) -> Column:
            cases = F.lit(0)
            for value in sorted(same):
                cases = F.when(word.isin(same[value]), value).otherwise(cases)
            return cases

        return F.aggregate(known, F.lit(0), lambda total, t: total + worth(t)) >= least

    vocabulary = sorted({t for key in keys for t in squares[key]})
    known = F.array(F.filter(F.array_distinct(_tokens(words)), lambda t: t.isin(vocabulary)))
    return F.exists(known, lambda k: reduce(Column.__or__, [reaches(k, key) for key in keys]))


def template_weights(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """(token, template, weight) of unit vectors, and (token, idf): sizes are those of ``TEMPLATES``."""
    templates = spark.createDataFrame(list(TEMPLATES), "template string, statement string")
    counts = (
        templates.select("template", F.explode(_tokens("statement")).alias("token"))
        .groupBy("template", "token")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    idf = counts.groupBy("token").agg(
        (F.log(F.lit(1.0 + len(TEMPLATES)) / (1 + F.count(F.lit(1)))) + 1).alias("idf")
    )
    raw = counts.join(idf, "token").select("template", "token", (F.col("n") * F.col("idf")).alias("w"))
    norms = raw.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    weights = raw.join(norms, "template").select("token", "template", (F.col("w") / F.col("norm")).alias("weight"))
    return weights, idf


def classify(units: DataFrame, like: float = LIKE, keys: Sequence[str] | None = None) -> DataFrame:
    """unit, license, cosine of every distinct ``unit`` (with its ``words``) that is like a template.

    ``keys`` restricts the templates that are compared, not the counts behind the weights. Tokens in no template weigh as if one more template held them none. The best
    template wins, ties go to the first key.
    """
    weights, idf = template_weights(units.sparkSession)
    if keys is not None:
        weights = weights.where(F.col("template").isin(list(keys)))
    unseen = F.log(F.lit(1.0 + len(TEMPLATES))) + 1
    counts = (
        units.select("unit", "words")
        .dropDuplicates(["unit"])
        .select("unit", F.explode(_tokens("words")).alias("token"))
        .groupBy("unit", "token")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # The template tables have as many rows as the templates have words.
    vectors = counts.join(F.broadcast(idf), "token", "left").select(
        "unit", "token", (F.col("n") * F.coalesce("idf", unseen)).alias("w")
    )
    norms = vectors.groupBy("unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = (
        vectors.join(F.broadcast(weights), "token")
        .groupBy("unit", "template")
        .agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    )
    cosine = F.round(F.col("dot") / F.col("norm"), 6)
    return (
        dots.join(norms, "unit")
        .groupBy("unit")
        .agg(F.min(F.struct((-cosine).alias("away"), "template")).alias("best"))
        .select("unit", F.substring_index("best.template", "#", 1).alias("license"), (-F.col("best.away")).alias("cosine"))
        .where(F.col("cosine") >= like)
    )


def inherited(files: DataFrame, holders: DataFrame) -> DataFrame:
    """``files`` (dir and others) with the license of the nearest directory in ``holders``.

    ``holders`` has directory, license: one row a directory. Distinct directories
    climb to their ancestors once each; a directory with very many files is spread
    over ``SALTS`` copies of its row.
    """
    climbs = (
        files.select("dir").where("dir is not null").distinct()
        .select("dir", F.posexplode(_directories_of("dir")).alias("depth", "directory"))
    )
    nearest = (
        climbs.join(holders, "directory")
        .groupBy("dir")
        .agg(F.max(F.struct("depth", F.col("license"))).alias("__near"))
        .select("dir", F.col("__near.license").alias("from_directory"))
    )
    copies = nearest.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = files.withColumn("__salt", F.pmod(F.xxhash64("file_key"), F.lit(SALTS)).cast("int"))
    return salted.join(copies, ["dir", "__salt"], "left").drop("__salt")


def _directories_of(directory: str) -> Column:
    """A directory and all above it, the root (empty) first."""
    parts = F.filter(F.split(F.col(directory), "/"), lambda p: p != "")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/")
    )


def scan_licenses(files: DataFrame, like: float = LIKE) -> DataFrame:
    """file_key, path, license, cosine, origin for every row of ``files`` (file_key, path, text).

    ``origin`` is ``own`` (a statement, header or licence in the text) or ``inherited`` (from the
    nearest directory above, its own included, with a licence file: one with a
    licence's file name, or whose sentences are all statements; of several, the
    first name of those with the closest statement). Of several statements in a
    text the closest counts, ties go to the first name. Missing and empty texts
    have no statement; missing paths inherit nothing. file_key must tell different
    rows apart; rows that repeat it share what is found for it. An empty table
    gives no rows.
    """
    # Leading and doubled slashes do not matter.
    parts = F.filter(F.split("path", "/"), lambda p: p != "")
    slim = files.select(
        "file_key",
        "path",
        "text",
        F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), "/").alias("dir"),
        F.lower(F.element_at(F.split("path", "/"), -1)).alias("base"),
    )
    cut = F.split(F.regexp_replace("text", r"([.!?])[ \t]+", "$1\n"), "\n")
    sentences = F.filter(F.transform(cut, lambda s: F.lower(F.trim(s))), lambda s: s != "")
    header = F.lower(F.element_at(F.split("text", r"\n[ \t\r]*\n", 2), 1))

    def unit(words: Column, kind: str) -> Column:
        return F.struct(words.alias("words"), F.lit(kind).alias("kind"))

    units = F.concat(
        F.transform("all", lambda s: unit(s, "sentence")),
        F.array(unit(header, "header")),
        F.when(F.col("named"), F.array(unit(F.lower("text"), "file"))).otherwise(F.array().cast("array<struct<words:string,kind:string>>")),
    )
    rows = (
        slim.withColumn("named", F.coalesce(F.col("base").rlike(FILE_NAMES), F.lit(False)))
        .where(F.lower("text").rlike(CUES) | (F.col("named") & F.col("text").isNotNull()) | _may_reach(F.col("text"), like))
        .withColumn("all", sentences)
        .select("file_key", "dir", "named", F.size("all").alias("sentences"), F.inline(units))
        .withColumn("silent", (F.col("kind") != "file") & ~F.col("words").rlike(CUES))
        .where(~F.col("silent") | _may_reach(F.col("words"), like))
        .withColumn("unit", F.xxhash64("words", "silent"))
    )
    # The texts are read once; what follows reads the few units.
    rows = written(rows, "licence-units")
    found = classify(rows.where("not silent"), like).unionByName(classify(rows.where("silent"), like, WORDLESS))
    own = (
        rows.drop("words")
        .join(found, "unit")
        .groupBy("file_key", "dir", "named", "sentences")
        .agg(
            F.min(F.struct((-F.col("cosine")).alias("away"), "license")).alias("best"),
            F.count_if(F.col("kind") == "sentence").alias("statements"),
        )
        .withColumn("whole", (F.col("statements") >= F.col("sentences")) | F.col("named"))
    )
    holders = (
        own.where(F.col("whole") & F.col("dir").isNotNull())
        .groupBy(F.col("dir").alias("directory"))
        .agg(F.min("best").alias("best"))
        .select("directory", F.col("best.license").alias("license"))
    )
    stated = own.groupBy("file_key").agg(F.min("best").alias("best"))
    keyed = slim.select("file_key", "path", "dir")
    found = inherited(keyed, holders).join(stated, "file_key", "left")
    return found.select(
        "file_key",
        "path",
        F.coalesce("best.license", "from_directory").alias("license"),
        (-F.col("best.away")).alias("cosine"),
        F.when(F.col("best").isNotNull(), "own").when(F.col("from_directory").isNotNull(), "inherited").alias("origin"),
    )
