from __future__ import annotations

import itertools
import math
import re
from collections import Counter

from common import documents, prose
from pyspark.sql import functions as F

from wardmill.llm import licence_texts as texts
from wardmill.llm import licenses


def plain_scores(files):
    """(kind, file, place): (score, licence) of the best template of every part of the files."""
    number = len(files)
    held = Counter(t for text in files for t in set(licenses.terms_of(text)))
    known = {t for _, text in licenses.TEMPLATES for t in licenses.terms_of(text)}

    def vector(text):
        return {t: n * (math.log((1 + number) / (1 + held[t] * (t in known))) + 1) for t, n in licenses.terms_of(text).items()}

    def cosine(a, b):
        return sum(v * b.get(t, 0) for t, v in a.items()) / math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))

    marks = [(name, vector(text)) for name, text in licenses.TEMPLATES]
    out = {}
    for file, text in enumerate(files):
        lines, parts = text.lower().split("\n"), [("file", 0, text.lower())]
        parts += [("line", i, line) for i, line in enumerate(lines)]
        for kind, pattern in (("block", "[a-z0-9]"), ("comment", licenses.COMMENT)):
            for flag, run in itertools.groupby(enumerate(lines), key=lambda x: bool(re.search(pattern, x[1]))):
                run = list(run)
                if flag:
                    parts.append((kind, run[0][0], "\n".join(line for _, line in run)))
        parts += [("sentence", place, s) for kind, place, p in parts if kind == "block" for s in re.split(licenses.SENTENCE_END, p)]
        for kind, place, part in parts:
            own = vector(part)
            best = max(((round(cosine(own, m), 6), name) for name, m in marks), default=None) if own else (0, "")
            out[kind, file, place] = max(out.get((kind, file, place), (0, "")), best)
    return out


LINES = [
    "Licensed under the Apache License, Version 2.0.", "// licensed under the apache license, v 2.0 (the License)", "MIT License",
    "released released released under the MIT License", "All rights reserved", "the of and a", "Copyright 2020. All rights reserved.", "",
    "Licensed under CC BY-SA 4.0", "licensed under CC BY 4.0 or CC BY-NC 4.0", "GNU General Public License version 3", "mit dem", "public domain cc0 1.0",
    "Copyright 2020 Foo Inc. Licensed under the Apache License,\n  Version 2.0; and more\n\n-- released under\n--\n-- the mit license\nx = 1",
]


def test_parts_equal_plain_python(spark):
    some = ["intro\n" + t for t in LINES] + ["", "only prose"]
    files = spark.createDataFrame(list(enumerate(some)), "k long, text string")
    plain = plain_scores(some)
    for threshold in (0.3, 0.6, 0.9):
        got = {}
        for r in licenses.statements(files, licenses.TEMPLATES, threshold).collect():
            got[r.kind, r.k, r.place] = max(got.get((r.kind, r.k, r.place), (0, "")), (r.score, r.template))
        assert got == {part: best for part, best in plain.items() if best[0] >= threshold}


def commented(text, mark="# "):
    return "\n".join((mark + line).rstrip() for line in text.strip().split("\n"))


MIT = f"MIT License\n\nCopyright (c) 2021 Some Person\n{texts.GRANT_MIT}\n{texts.NOTICE_MIT}\n{texts.WARRANTY_MIT}\n"
BSD = "Copyright (c) 2019, Some Person\nAll rights reserved.\n" + "\n".join(
    [texts.BSD_OPENING, texts.BSD_FIRST_TWO, texts.BSD_THIRD, texts.BSD_WARRANTY]
)
CODE = "\nimport os\n\ndef main(path):\n    return os.listdir(path)  # every name in there\n" * 5
GPL = """This file is part of Frobnicator.

Frobnicator is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

Frobnicator is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""
MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at http://mozilla.org/MPL/2.0/. */"""
KNOWN = [
    ("MIT", MIT), ("MIT", commented(MIT) + CODE), ("BSD-3-Clause", BSD), ("BSD-3-Clause", commented(BSD, " * ") + CODE),
    ("BSD-2-Clause", BSD.replace(texts.BSD_THIRD, "")), ("ISC", "Copyright 2020 A. Person" + texts.ISC_TEXT),
    ("Apache-2.0", commented(f"Copyright 2020 Foo\n{texts.APACHE_NOTICE}\n\n  http://www.apache.org/licenses/LICENSE-2.0\n{texts.APACHE_WARRANTY}") + CODE),
    ("Apache-2.0", "Copyright 2020 Foo Inc. Licensed under the Apache License, Version 2.0" + CODE),
    ("Apache-2.0", "// SPDX-License-Identifier: Apache-2.0" + CODE), ("GPL-2.0", "/* SPDX-License-Identifier: GPL-2.0-only */" + CODE),
    ("Apache-2.0", "                                 Apache License\n                           Version 2.0, January 2004\n\n1. Definitions." + CODE),
    ("GPL-3.0", commented(GPL, "// ") + CODE), ("GPL-2.0", commented(GPL.replace("version 3", "version 2")) + CODE),
    ("LGPL-3.0", commented(GPL.replace("General", "Lesser General")) + CODE), ("AGPL-3.0", commented(GPL.replace("General", "Affero General")) + CODE),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n\n" + prose(5, 80)), ("MPL-2.0", MPL + CODE),
    ("BSD-3-Clause", "BSD 3-Clause License"), ("Proprietary", "(c) Foo. All rights reserved." + CODE),
    (None, "SPDX-License-Identifier: Foo-1.0" + CODE), (None, CODE), (None, prose(3, 300)), (None, "see the license of the software for the terms of use"),
]


def test_headers_and_files(spark):
    docs = spark.createDataFrame([(i, f"d{i}/x.py", t) for i, (_, t) in enumerate(KNOWN)], "doc_id long, path string, text string")
    got = {r.id: r.license for r in licenses.scan_licenses(docs, F.col("path")).collect()}
    assert got == {i: name for i, (name, _) in enumerate(KNOWN)}


def test_nearest_folder_gives_the_licence(spark):
    files = [
        (1, "a/b/c.py", "x"), (2, "a/LICENSE", "Released under the MIT License."), (3, "a/b/d/e.py", "Licensed under CC BY-NC 4.0.\ncode"),
        (4, "z.py", None), (5, None, ""), (6, "q/COPYING.txt", "This work is licensed under the GNU General Public License, version 3.\n\nmore"),
        (7, "q/r/s/t", "no"), (8, "a/b/only", "All rights reserved.\n"), (9, "a/b/z", ""), (10, "/root", "x"), (10, "/root", "x"), (None, "a/x", "y"),
    ]
    df = spark.createDataFrame([(*f, "p", "t") for f in files], "doc_id long, path string, text string, k string, folder string")
    got = Counter((r.id, r.license, r.place, r.folder) for r in licenses.scan_licenses(df, F.col("path")).collect())
    assert got == Counter({
        (1, "Proprietary", None, "a/b"): 1, (2, "MIT", 0, None): 1, (3, "CC-BY-NC-4.0", 0, None): 1, (4, None, None, None): 1,
        (5, None, None, None): 1, (6, "GPL-3.0", 0, None): 1, (7, "GPL-3.0", None, "q"): 1, (8, "Proprietary", 0, None): 1,
        (9, "Proprietary", None, "a/b"): 1, (10, None, None, None): 2, (None, "MIT", None, "a"): 1,
    })


def test_odd_rows(spark):
    found = licenses.scan_licenses(documents(spark), F.lit("a/b"))
    assert found.count() == documents(spark).count() and found.filter("license is not null").count() == 0
    assert licenses.scan_licenses(documents(spark, []), F.lit("a")).collect() == []


def test_lines_of_very_many_terms(spark):
    """A line of 20,000 joined words ends no task, and the licence beside it is found."""
    long = "a." * 20_000 + "b-" * 20_000
    texts = [f"Released under the MIT License\n{long}", f"{long} license", f"license {'x ' * 20_000}"]
    docs = spark.createDataFrame([(i, t, f"f/{i}") for i, t in enumerate(texts)], "doc_id long, text string, path string")
    found = {r.id: r.license for r in licenses.scan_licenses(docs, F.col("path")).collect()}
    assert found[0] == "MIT" and len(found) == 3
