from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow.parquet as pq

from weatherloom.llm import licences
from weatherloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return "".join(c if ord(c) > 127 or c.isalnum() else " " for c in low).split(" ")


def plain(files):
    """[(doc_id, path, text)] -> sorted result rows."""
    bags = [{w for w in words(t or "") if w} for *_, t in files]
    idf = lambda term: math.log((1 + len(files)) / (1 + sum(term in b for b in bags))) + 1
    known = {w for _, t in licences.TEMPLATES for w in words(t) if w}

    def vector(text):
        v = {w: n * (idf(w) if w in known else math.log(1 + len(files)) + 1) for w, n in Counter(words(text)).items() if w}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}

    models = [(name, vector(t)) for name, t in licences.TEMPLATES]
    own = []
    for _, _, text in files:
        best = None
        for s in re.split(licences._ENDS, text or ""):
            if re.search(licences.ANCHOR, s):
                v = vector(s)
                for name, m in models:
                    c = round(sum(x * m.get(w, 0) for w, x in v.items()), 6)
                    if c >= 0.6 and (best is None or (-c, name) < best):
                        best = (-c, name)
        own.append(best)
    dirs = {}
    for (_, path, _), best in zip(files, own, strict=True):
        name = (path or "").rpartition("/")
        if path is not None and best and re.match(licences.LICENCE_FILE, name[2]):
            dirs[name[0]] = min(best[1], dirs.get(name[0], best[1]))
    out = []
    for (doc, path, _), best in zip(files, own, strict=True):
        source = None
        if path is not None:
            at = path.rpartition("/")[0]
            while at not in dirs and at:
                at = at.rpartition("/")[0]
            source = at if at in dirs else None
        licence = best[1] if best else dirs.get(source) if source is not None else None
        row = (doc, path, best and best[1], best and f"{-best[0]:.4f}", licence, None if best else source)
        out.append(repr(row))
    return sorted(out)


def got(df):
    return sorted(
        repr((r.doc_id, r.path, r.own_licence, None if r.cosine is None else f"{r.cosine:.4f}", r.licence, r.inherited_from))
        for r in df.collect()
    )


FILES = [
    (1, "a/LICENSE", "Released under the MIT License."), (2, "a/x.py", "print(1)"), (3, "a/b/c/y.py", ""), (4, "a/b/c/z.py", None),
    (5, "a/b/COPYING.txt", "x\nThis work is licensed under the GNU General Public License, version 3.\ny"), (6, "a/b/q.py", "Licensed under CC BY-NC 4.0. More."),
    (7, "LICENSE", "Licensed under the Apache License, Version 2.0."), (8, "top.py", "nothing"), (9, None, "nothing"), (None, None, "Released under the MIT License!"),
    (10, "d/e/f", "the license of a driver is no licence at all"), (10, "d/e/f", "the license of a driver is no licence at all"),
    (11, "ab/x", "x" * 200_000 + "\n" + "word " * 30_000 + "\nReleased under the MIT Licence."), (12, "a/license-notes", "Licensed under CC BY 4.0.\nReleased under the MIT License."),
    (13, "d/LICENSE", "no statement here, only a license word"), (14, "a/b/c/d/e/f/g", "copyright"), (15, "/abs/p", "é"), (16, "a//b", "x"),
]


def test_against_plain_scan(spark):
    frame = spark.createDataFrame(FILES, "doc_id long, path string, text string").selectExpr("*", "1 as row", "2 as dir", "'t' as term")
    assert got(licences.scan(frame)) == plain(FILES)


def test_empty(spark):
    assert licences.scan(spark.createDataFrame([], "doc_id long, path string, text string")).collect() == []


def test_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]

    def path(d):
        sub = f"{d // 10_000}/{d // 100}"
        return f"{d // 10_000}/LICENSE" if d % 10_000 == 0 else f"{sub}/LICENSE" if d % 100 == 0 else f"{sub}/{d}.txt"

    found = got(QUERIES["op9_licence_scan"](spark, SF))
    assert found == plain([(d, path(d), t) for d, t in docs]) and any("MIT" in r or "CC-BY-NC" in r for r in found)


def gnu(what, licence, version, mark=";"):
    return (
        f"This {what} is free software{mark} you can redistribute it and/or modify\nit under the terms of the GNU {licence} as published by\n"
        f"the Free Software Foundation{mark if mark == ';' else ','} either version {version} of the License, or\n(at your option) any later version."
    )


HEADERS = [
    ("GPL-2.0", gnu("program", "General Public License", "2")),
    ("GPL-3.0", gnu("program", "General Public License", "3", ":")),
    ("LGPL-2.1", gnu("library", "Lesser General Public License", "2.1")),
    ("AGPL-3.0", gnu("program", "Affero General Public License", "3", ":")),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance\nwith the License.'),
    ("GPL-2.0", "This file is distributed under the terms of version 2 of the\nGNU General Public License."),
    ("CC-BY-3.0", "Licensed under CC BY 3.0."), ("CC-BY-NC-SA-3.0", "Licensed under CC BY-NC-SA 3.0."), ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("MIT", "SPDX-License-Identifier: MIT"), ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"), ("Zlib", "SPDX-License-Identifier: Zlib"),
    ("MIT OR Apache-2.0", "SPDX-License-Identifier: MIT OR Apache-2.0"),
]
BSD = """Copyright (c) 2020, A. Holder
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
THIRD = """3. Neither the name of the copyright holder nor the names of its contributors
   may be used to endorse or
   promote products derived from this software without specific prior written permission.
"""
WHOLE = [
    ("GPL-2.0", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright (C) 1989, 1991 Free Software Foundation, Inc.,\n Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed.\n"),
    ("Apache-2.0", "                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n\n   1. Definitions.\n"),
    ("BSD-2-Clause", BSD), ("BSD-3-Clause", BSD + THIRD),
    ("MIT", "MIT License\n\nCopyright (c) 2020 A. Holder\n\n" + licences._MIT.replace(", ", ",\n")),
]


def test_wrapped_headers_tags_and_whole_files(spark):
    rows, want = [], {}
    for licence, text in HEADERS:
        for mark in ("", "# ", " * ", "// "):
            body = "\n".join(mark + x for x in f"Copyright (C) 2020 A. Holder\n\n{text}\n\ncode".split("\n"))
            rows.append((len(rows), f"src/{len(rows)}.c", body))
            want[len(want)] = licence
    for licence, text in WHOLE:
        rows.append((len(rows), f"{len(rows)}/LICENSE", text))
        want[len(want)] = licence
    rows += [(1000 + i, f"x/{i}", f"plain words {i} the of and to in a file that are not a notice") for i in range(400)]
    out = licences.scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()
    got = {r.doc_id: r.own_licence for r in out if r.doc_id < 1000}
    texts = {r[0]: r[2] for r in rows}
    assert {k: (v, texts[k]) for k, v in got.items() if v != want[k]} == {}
    assert all(r.own_licence is None for r in out if r.doc_id >= 1000)
