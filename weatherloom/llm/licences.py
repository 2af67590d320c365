"""Licences of files: statements compared with templates, then inheritance down the directories.

Statements are lines or sentences with a word that licences use, sentences wrapped over consecutive
lines (comment marks aside), and licence files as a whole. Distinct statements and the templates are sparse TF-IDF vectors, with document frequencies of the template
terms over all texts; the best cosine above a threshold names the licence, and the version, variant
or clauses that the words themselves name decide between its kin. A SPDX tag is taken by its word. A file without one
inherits that of the licence file in the nearest directory above it, by a join of directories with
all their ancestors.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherloom.llm.decontaminate import terms
from weatherloom.llm.scratch import written

_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
_BSD_TWO = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
_BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_BSD_END = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
_MIT = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'


def _gnu(what: str, licence: str, version: str, mark: str) -> str:
    return (
        f"This {what} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {licence} "
        f"as published by the Free Software Foundation{';' if mark == ';' else ','} either version {version} of the License, or (at your option) any later version."
    )


# Customary notices, as their licences recommend or as they open.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work (CC0 1.0)."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("GPL-2.0", _gnu("program", "General Public License", "2", ";")),
    ("LGPL-2.1", _gnu("library", "Lesser General Public License", "2.1", ";")),
    ("LGPL-3.0", _gnu("program", "Lesser General Public License", "3", ":")),
    ("AGPL-3.0", _gnu("program", "Affero General Public License", "3", ":")),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("CC-BY-3.0", "Licensed under CC BY 3.0."),
    ("CC-BY-3.0", "This work is licensed under a Creative Commons Attribution 3.0 Unported License."),
    ("CC-BY-SA-3.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", _MIT),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TWO + _BSD_END),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_TWO + _BSD_THIRD + _BSD_END),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
#: A statement has one of these.
ANCHOR = r"(?i)licen[cs]|copyright|permission is hereby|redistribut|public domain|cc[\x20-](?:by|0)|spdx"
#: Names of the files that speak for their directory.
LICENCE_FILE = r"(?i)^(?:licen[cs]e|copying|unlicense|notice)(?:[.-][^/]*)?$"
MIN_COSINE = 0.6
_ENDS = r"\n+|(?<=[.!?])[\x20\t]+"


# What may stand between two words of a wrapped statement; a text with no such anchor has none.
_GAP = r"[\s*#/;%-]+"
_MAY = rf"(?i)licen[cs]|copyright|permission{_GAP}is{_GAP}hereby|redistribut|public{_GAP}domain|cc{_GAP}(?:by|0)|spdx"
_MARKS = r"(?m)^[\x20\t\r]*(?:<!--|/\*+|\*+/?|//+|#+|--+|;+|%+|dnl\b|REM\b)?[\x20\t\r]*|[\x20\t\r]*(?:\*+/|-->)?[\x20\t\r]*$"
_SPDX = r"(?i)SPDX-License-Identifier:[\x20\t]*([(]*[a-z0-9.+-]+[)]*(?:[\x20\t]+(?:AND|OR|WITH)[\x20\t]+[(]*[a-z0-9.+-]+[)]*)*)"


def statements(text: Column) -> Column:
    """The lines and sentences of a text that may state a licence."""
    none = F.array().cast("array<string>")
    return F.when(F.regexp(text, F.lit(ANCHOR)), F.filter(F.split(text, _ENDS), lambda x: x.rlike(ANCHOR))).otherwise(none)


def wrapped(text: Column) -> Column:
    """Sentences that go over consecutive lines, without the comment marks, that may state a licence."""
    none = F.array().cast("array<string>")
    blocks = F.filter(F.split(F.regexp_replace(text, _MARKS, ""), r"\n{2,}"), lambda x: x.rlike(r"\n") & x.rlike(_MAY))
    sentences = F.flatten(F.transform(blocks, lambda x: F.split(F.translate(x, "\n", " "), _ENDS)))
    return F.when(F.regexp(text, F.lit(_MAY)), F.filter(sentences, lambda x: x.rlike(ANCHOR))).otherwise(none)


def spdx(text: Column) -> Column:
    """The expression of the first SPDX tag, in the names of the templates; null without one."""
    said = F.regexp_extract(text, _SPDX, 1)
    plain = F.regexp_replace(F.regexp_replace(said, r"(?i)-(?:only|or-later)\b", ""), r"(?<=[0-9])\+", "")
    return F.when(plain != "", plain)


def two_clauses(text: Column) -> Column:
    """Whether a text has the two conditions of BSD-2-Clause and not the third; both licences open alike."""
    return F.coalesce(
        F.when(text.rlike("(?i)redistributions"), text.rlike(rf"(?i)redistributions{_GAP}in{_GAP}binary{_GAP}form")
               & ~text.rlike(rf"(?i)endorse{_GAP}or{_GAP}promote")), F.lit(False)
    )


def named(licence: Column, statement: Column) -> Column:
    """``licence`` of the best template, in the variant and version that the statement itself names;
    a statement that names none keeps the template's. Whole files name many."""
    def has(pattern):
        return statement.rlike(pattern)

    number = r"(?:version|v\.?)\s*([0-9]+(?:\.[0-9]+)?)"
    before = F.regexp_extract(statement, rf"(?i)\b{number}\s+of\s+the\s+(?:gnu|apache|mozilla)", 1)
    behind = F.regexp_extract(statement, rf"(?i)(?:(?:general|mozilla)\s+public|apache)\s+licen[cs]e\b.{{0,120}}?\b{number}", 1)
    version = F.when(before != "", before).when(behind != "", behind)
    version = F.when(version.contains("."), version).otherwise(F.concat(version, F.lit(".0")))
    family = F.regexp_extract(licence, r"^(Apache|MPL|GPL|LGPL|AGPL)-([0-9.]+)$", 1)
    gnu = family.endswith("GPL")
    of_words = F.when(gnu & has(r"(?i)\baffero\b"), "AGPL").when(gnu & has(r"(?i)\b(?:lesser|library)\s+general\b"), "LGPL").when(gnu, "GPL")
    of_words = of_words.otherwise(family)
    cc = F.regexp_extract(statement, r"(?i)(?:\bcc[\x20-]by|\battribution)[a-z\x20-]*?[\x20-]v?([0-9]\.[0-9])\b", 1)
    parts = [("-NC", r"(?i)non-?commercial|by[a-z-]*-nc\b"), ("-ND", r"(?i)no-?deriv|by[a-z-]*-nd\b"), ("-SA", r"(?i)share-?alike|by[a-z-]*-sa\b")]
    cc_name = F.concat(F.lit("CC-BY"), *[F.when(has(p), n).otherwise("") for n, p in parts], F.lit("-"), cc)
    old = F.regexp_extract(licence, r"-([0-9.]+)$", 1)
    return (
        F.when(F.length(statement) > 1000, licence)
        .when(family != "", F.concat(of_words, F.lit("-"), F.coalesce(version, old)))
        .when(licence.startswith("CC-BY") & (cc != ""), cc_name)
        .otherwise(licence)
    )


def _vocabulary() -> list[str]:
    return sorted({t for _, text in TEMPLATES for t in _template_terms(text)})


def _template_terms(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def term_weights(docs: DataFrame) -> DataFrame:
    """(term, idf) of the template terms, ln((1 + N) / (1 + df)) + 1 over all ``docs``, and of a
    term that no text has under a null term."""
    vocabulary = _vocabulary()
    n = docs.count()
    df = (
        docs.select(F.explode(F.array_intersect(terms(F.col("text")), F.array(*map(F.lit, vocabulary)))).alias("term"))
        .groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    )
    every = docs.sparkSession.createDataFrame([(t,) for t in [*vocabulary, None]], "term string")
    return every.join(df, "term", "left").select(
        "term", (F.log((1.0 + n) / (1 + F.coalesce("df", F.lit(0)))) + 1).alias("idf")
    )


def _vectors(spark: SparkSession, idf: DataFrame) -> DataFrame:
    """(licence, template, term, weight / norm) of the templates."""
    rows = [
        (licence, i, term, float(tf))
        for i, (licence, text) in enumerate(TEMPLATES) for term, tf in Counter(_template_terms(text)).items()
    ]
    weighted = spark.createDataFrame(rows, "licence string, template int, term string, tf double").join(idf, "term").select(
        "licence", "template", "term", (F.col("tf") * F.col("idf")).alias("w")
    )
    norms = weighted.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return weighted.join(norms, "template").select("licence", "template", "term", (F.col("w") / F.col("norm")).alias("tw"))


def best_templates(found: DataFrame, idf: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """Distinct statements (statement) -> (statement, licence, cosine) of those near a template;
    ties go to the first licence by name, and :func:`named` sets version and variant."""
    new = idf.where("term is null").first()["idf"]
    # a digest stands for the statement, which may be a whole file, beside its terms
    found = found.withColumn("key", F.sha2("statement", 256))
    counted = (
        found.select("key", F.explode(terms(F.col("statement"))).alias("term"))
        .groupBy("key", "term").agg(F.count(F.lit(1)).alias("tf"))
        .join(idf.where("term is not null"), "term", "left")
        .select("key", "term", (F.col("tf") * F.coalesce("idf", F.lit(new))).alias("w"))
    )
    counted = written(counted, "statement-vectors")
    norms = counted.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = (
        counted.join(_vectors(found.sparkSession, idf), "term")
        .groupBy("key", "licence", "template").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    )
    cosine = F.round(F.col("dot") / F.col("norm"), 6)
    best = F.min(F.struct((-cosine).alias("c"), F.col("licence"))).alias("best")
    return (
        dots.join(norms, "key").groupBy("key").agg(best).where(-F.col("best.c") >= min_cosine).join(found, "key")
        .select("statement", named(F.col("best.licence"), F.col("statement")).alias("licence"), (-F.col("best.c")).alias("cosine"))
    )


def _parent(path: Column) -> Column:
    """The directory of a path, empty for the top; null for null."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def scan(files: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """One row per row of ``files`` (doc_id, path, text, ...): doc_id, path, own_licence, cosine,
    licence (own or inherited), inherited_from (a directory, null if own or none).

    A text's licence is that of its SPDX tag (cosine 1), else that of its statement of the highest
    cosine, ties by name; BSD conditions without the third are BSD-2-Clause. If several
    licence files share a directory, the first licence by name speaks for it. Null and empty texts
    state nothing and inherit; rows with a null path do not inherit. Rows that come twice get equal
    results. Extra columns are ignored; no rows give no rows.
    """
    idf = written(term_weights(files), "term-weights")
    text, name = F.coalesce("text", F.lit("")), F.regexp_extract("path", r"([^/]*)$", 1)
    whole = F.when(name.rlike(LICENCE_FILE) & text.rlike(_MAY), F.array(text)).otherwise(F.array().cast("array<string>"))
    rows = files.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id"), "path",
        F.array_distinct(F.concat(statements(text), wrapped(text), whole)).alias("said"),
        spdx(text).alias("tag"), two_clauses(text).alias("two"),
    )
    rows = written(rows, "statements")  # written once, so row numbers are fixed from here on
    said = rows.select("row", F.explode("said").alias("statement"))
    best = written(best_templates(said.select("statement").distinct(), idf, min_cosine), "best-templates")
    own = said.join(best, "statement").groupBy("row").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "licence")).alias("best"))
    licence = F.when(F.col("two") & (F.col("best.licence") == "BSD-3-Clause"), "BSD-2-Clause").otherwise(F.col("best.licence"))
    stated = rows.select("row", "doc_id", "path", _parent(F.col("path")).alias("dir"), "tag", "two").join(own, "row", "left").select(
        "row", "doc_id", "path", "dir", F.coalesce("tag", licence).alias("own_licence"),
        F.when(F.col("tag").isNotNull(), 1.0).otherwise(-F.col("best.c")).alias("cosine"),
    )
    stated = written(stated, "stated")

    speaking = stated.where(F.col("own_licence").isNotNull() & name.rlike(LICENCE_FILE)).groupBy("dir").agg(
        F.min("own_licence").alias("dir_licence")
    ).select(F.col("dir").alias("above"), "dir_licence")
    # every directory with all its ancestors and itself; the deepest that speaks is the nearest
    parts = F.split("dir", "/")
    ancestors = stated.where("dir is not null").select("dir").distinct().select(
        "dir", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth")
    ).select("dir", "depth", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/").alias("above"))
    met = ancestors.join(speaking, "above")
    deepest = met.groupBy("dir").agg(F.max("depth").alias("depth"))
    nearest = met.join(deepest, ["dir", "depth"]).select("dir", F.col("above").alias("inherited_from"), "dir_licence").distinct()
    inherits = F.col("own_licence").isNull()
    return stated.join(nearest, "dir", "left").select(
        "doc_id", "path", "own_licence", "cosine", F.coalesce("own_licence", "dir_licence").alias("licence"),
        F.when(inherits, F.col("inherited_from")).alias("inherited_from"),
    )
