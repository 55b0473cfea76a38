import math
import re
from collections import Counter

import duckdb
import pytest
from conftest_llm import ODD
from pyspark.sql import functions as F

from tablegauge.llm import catalog, licenses as L


def cosine(text, known):
    words = lambda t: Counter(re.findall("[a-z0-9]+", t.lower()))
    df = Counter(w for _, t in known for w in words(t))
    idf = lambda w: math.log((1 + len(known)) / (1 + df[w])) + 1
    vec = lambda t: {w: c * idf(w) for w, c in words(t).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    a, out = vec(text), []
    for name, t in known:
        b = vec(t)
        if a and b:
            out.append((-round(sum(x * b.get(w, 0) for w, x in a.items()) / norm(a) / norm(b), 9), name))
    return min(out, default=(0, None))


def brute(rows, known):
    own, held = {}, {}
    for k, (i, repo, path, text) in enumerate(rows):
        path = (path or "").lstrip("/")
        name, folder = path.rsplit("/", 1)[-1], path.rsplit("/", 1)[0] if "/" in path else ""
        units = [x for x in (text or "").split("\n") if re.search(L.TRIGGER, x)] + ([text or ""] if re.search(L.LICENSE_FILE, name) else [])
        best = min((cosine(u, known) for u in units), default=(0, None))
        if best[0] <= -L.THRESHOLD:
            own[k] = best
            if re.search(L.LICENSE_FILE, name):
                key = repo or "", folder
                held[key] = min(held.get(key, (0, "~")), best)
    out = []
    for k, (i, repo, path, text) in enumerate(rows):
        path = (path or "").lstrip("/")
        folder = path.rsplit("/", 1)[0] if "/" in path else ""
        up = folder.split("/") if folder else []
        at = next(("/".join(up[:n]) for n in range(len(up), -1, -1) if (repo or "", "/".join(up[:n])) in held), None)
        if k in own:
            out.append((i, own[k][1], "own", -own[k][0], None))
        elif at is not None:
            out.append((i, held[repo or "", at][1], "inherited", None, at))
        else:
            out.append((i, None, "none", None, None))
    return out


@pytest.mark.parametrize("limit", [500_000, 0])
def test_against_brute_force(spark, limit):
    mit, gpl = L.TEMPLATES[10][1], L.TEMPLATES[8][1]
    rows = [(1, "r", "LICENSE", mit), (2, "r", "a/b/c.txt", "code"), (3, "r", "a/LICENSE.md", gpl), (4, "r", "a/b/x.py", "# Released under MIT license\ncode"),
            (5, "r", "a/b/COPYING", "nothing here"), (6, "s", "a/b/c.txt", None), (7, None, "x/y", "z"), (8, None, "LICENCE", mit + "\n" + mit),
            (9, "r", "ab/c", "q"), (None, "r", "/a/b/n.txt", ""), (2, "r", "a/b/c.txt", "code"), (10, "t", "LICENSE", mit), (11, "t", "LICENSE.old", gpl),
            (12, "t", "deep/er/f", "text about copyright in general, that is long enough"), (13, "t", None, "no path")]
    rows += [(100 + i, "odd", f"p/{i}", t) for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "file_id long, repo string, path string, text string").withColumn("license", F.lit("clash")).withColumn("dir", F.lit(1))
    out = L.scan(df, L.templates(spark), broadcast_rows=limit)
    got = Counter((r.file_id, r.license, r.origin, r.cosine and round(r.cosine, 6), r.from_dir) for r in out.collect())
    assert got == Counter((i, x, o, c and round(c, 6), d) for i, x, o, c, d in brute(rows, L.TEMPLATES))


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = con.execute(catalog.ORACLE["op3_license_scan"]).fetchall()
    got = [tuple(r) for r in catalog.op3_license_scan(spark, sf).collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(want, key=key)
    assert {r[3] for r in got} == {"own", "inherited", "none"}


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "r", "LICENSE", "MIT License")], "file_id long, repo string, path string, text string")
    none = spark.createDataFrame([], "license string, text string")
    assert [r.origin for r in L.scan(df, none).collect()] == ["none"]
    assert L.scan(df.limit(0), L.templates(spark)).collect() == []


def test_titles_headers_and_full_texts(spark):
    texts = {n: t for n, k, t in L.license_forms.forms() if k == "text"}
    filled = lambda n: texts[n].replace("<year> <owner>", "2021 Some Body and others")
    wrapped = "// This program is free software: you can\n// redistribute it and/or modify it under the terms of\n// the GNU {} as\n" \
        "// published by the Free Software Foundation, either\n// version {} of the License, or (at your option) any later\n// version.\n//\n// more words\ncode();"
    apache = '#!/bin/sh\n#\n# Licensed under the Apache License, Version 2.0\n# (the "License"); you may not use this file except in\n# compliance with the License. ' \
        "You may obtain\n# a copy of the License at\n#\n#     http://www.apache.org/licenses/LICENSE-2.0\n\nrun"
    mozilla = "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n" \
        " * file, You can obtain one at https://mozilla.org/MPL/2.0/. */\nint x;"
    comment = lambda t: "".join(f" * {x}\n" for x in t.splitlines()) + "\ncode();"
    files = [("a.py", x, y) for x, y in (("MIT License", "MIT"), ("# SPDX-License-Identifier: MIT", "MIT"), ("SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
             ("SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"), ("SPDX-License-Identifier: Zlib", None), ("BSD 3-Clause License", "BSD-3-Clause"),
             ("GNU GENERAL PUBLIC LICENSE", "GPL"), ("Mozilla Public License Version 2.0", "MPL-2.0"), (apache, "Apache-2.0"), (mozilla, "MPL-2.0"),
             (wrapped.format("General Public License", 2), "GPL-2.0"), (wrapped.format("Lesser General Public License", 3), "LGPL-3.0"),
             (wrapped.format("Affero General Public License", 3), "AGPL-3.0"), (comment(filled("MIT")), "MIT"), (comment(filled("BSD-2-Clause")), "BSD-2-Clause"),
             ("a book on copyright and the public domain", None), ("see the license file for more on this", None))]
    files += [("LICENSE", filled(n), n) for n in texts] + [("COPYING", "the words of and to the in a license " * 300, None)]
    real = {"pluggy": "MIT", "idna": "BSD-3-Clause", "pygments": "BSD-2-Clause", "requests": "Apache-2.0"}
    for p in L.license_forms.Path(duckdb.__file__).parents[1].glob("*.dist-info/licenses/LICENSE*"):
        name = p.parents[1].name.split("-")[0]
        if name in real:
            files.append(("LICENSE", p.read_text(), real[name]))
    rows = [(i, f"r{i}", name, t) for i, (name, t, _) in enumerate(files)]
    df = spark.createDataFrame(rows, "file_id long, repo string, path string, text string")
    got = {r.file_id: r.license for r in L.scan(df, L.templates(spark), forms=L.form_templates(spark)).collect()}
    assert [(files[i][1][:60], got[i], x[2]) for i, x in enumerate(files) if got[i] != x[2]] == []
