import math
import textwrap
from collections import Counter
from pathlib import Path

import numpy as np

from terrafold.llm import licenses as L
from tests.llm.odd import ODD, documents


def test_cosines_against_plain_counting():
    t = L.Templates()
    found = np.arange(len(t.keys)) % 7
    t.weigh(50, found)
    lines = [b"Released under the MIT License.", b"this work is licensed under nothing much", b"no match", b"the the the License zebra zebra"]
    parts = L.Segments(lines)
    got, which = t.cosines(parts.text, parts.words.hash)
    idf = {int(k): math.log(51 / (1 + f)) + 1 for k, f in zip(t.keys, found, strict=True)}
    for i, line in enumerate(lines):
        counts = Counter(int(h) for h in L.Segments([line]).words.hash)
        vec = {k: n * idf.get(k, t.other) for k, n in counts.items()}
        best = 0.0
        for row in t.counts:
            tv = {int(k): c * idf[int(k)] for k, c in zip(t.keys, row, strict=True) if c}
            dot = sum(v * tv.get(k, 0) for k, v in vec.items())
            best = max(best, dot / math.sqrt(sum(v * v for v in vec.values())) / math.sqrt(sum(v * v for v in tv.values())))
        assert abs(got[i] - best) < 1e-9
    assert t.names[which[0]] == "MIT"


def test_inheritance_by_nearest_ancestor(spark):
    mit, gpl, apache = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3.", "Licensed under the Apache License, Version 2.0."
    rows = [
        ("r/LICENSE", mit),
        ("r/a/LICENSE", gpl),
        ("r/a/b/c/x.txt", "plain words"),
        ("r/a/y.txt", "words\n\n" + apache + "\nmore"),
        ("r/z.txt", None),
        ("q/z.txt", "words"),
        ("r/d/COPYING", "nothing of the kind"),
        ("r/d/e.txt", ""),
        ("top.txt", "words"),
        (None, "words"),
        (None, mit),
        ("r/z.txt", None),
    ]
    df = spark.createDataFrame([(p, t, "x") for p, t in rows], "path string, text string, license string")
    got = sorted(((r.path or "", r.license or "", r.origin, r.origin_dir or "") for r in L.inherit(L.own_license(df)).collect()))
    assert got == sorted(
        [
            ("r/LICENSE", "MIT", "own", ""),
            ("r/a/LICENSE", "GPL-3.0", "own", ""),
            ("r/a/b/c/x.txt", "GPL-3.0", "directory", "r/a"),
            ("r/a/y.txt", "Apache-2.0", "own", ""),
            ("r/z.txt", "MIT", "directory", "r"),
            ("r/z.txt", "MIT", "directory", "r"),
            ("q/z.txt", "", "none", ""),
            ("r/d/COPYING", "MIT", "directory", "r"),
            ("r/d/e.txt", "MIT", "directory", "r"),
            ("top.txt", "", "none", ""),
            ("", "", "none", ""),
            ("", "MIT", "own", ""),
        ]
    )


def test_the_root_gives_its_licence_and_odd_paths_work(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [("LICENSE", mit), ("src/x.c", "x"), ("y.c", "y"), ("a/b/c/d.c", ""), ("/LICENSE", gpl), ("/z.c", "z"), ("/src/w.c", "w"), ("/a//b.c", "b"), ("", "nothing"), ("a/", None)]
    df = spark.createDataFrame(rows, "path string, text string")
    got = {r.path: (r.license, r.origin, r.origin_dir) for r in L.inherit(L.own_license(df)).collect()}
    rel, top = ("MIT", "directory", ""), ("GPL-3.0", "directory", "/")
    assert got == {"LICENSE": ("MIT", "own", None), "/LICENSE": ("GPL-3.0", "own", None), "src/x.c": rel, "y.c": rel, "a/b/c/d.c": rel, "/z.c": top, "/src/w.c": top, "/a//b.c": top, "": rel, "a/": rel}


def test_names_that_clash_in_any_case(spark):
    names = ["_n", "_dir", "dir", "n", "up", "License", "ORIGIN", "given", "Own_Score", "_aside"]
    df = spark.createDataFrame([("a/x", "words", *names), ("LICENSE", "Released under the MIT License.", *names)], ["path", "text", *names])
    got = L.inherit(L.own_license(df))
    assert got.columns == ["path", "text", *[n for n in names if n not in ("License", "ORIGIN", "Own_Score")], "own_license", "own_score", "license", "origin", "origin_dir"]
    assert all(r[n] == n for r in got.collect() for n in ("_n", "_dir", "dir", "n", "up", "given", "_aside")) and {r.license for r in got.collect()} == {"MIT"}


def test_gnu_headers_and_licence_files_get_their_own_names(spark):
    """Headers broken over comment lines, with the warranty paragraph; and whole licence files where the system has them."""
    warranty = "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; see the GNU General Public License for more details."
    rows = []
    for what, name, sep, version, want in [
        ("program", "", ";", "1", "GPL-1.0"),
        ("program", "", ";", "2 of the License", "GPL-2.0"),
        ("program", "", ":", "3 of the License", "GPL-3.0"),
        ("library", "Library ", ";", "2 of the License", "LGPL-2.0"),
        ("library", "Lesser ", ";", "2.1 of the License", "LGPL-2.1"),
        ("library", "Lesser ", ":", "3 of the License", "LGPL-3.0"),
        ("program", "Lesser ", ":", "3 of the License", "LGPL-3.0"),
        ("program", "Affero ", ":", "3 of the License", "AGPL-3.0"),
    ]:
        text = f"This {what} is free software{sep} you can redistribute it and/or modify it under the terms of the GNU {name}General Public License as published by the Free Software Foundation, either version {version}, or (at your option) any later version."
        rows.append((want, "\n".join(f"# {x}" for x in [*textwrap.wrap(text, 70), "", *textwrap.wrap(warranty, 70)])))
    for file, want in {"GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "Apache-2.0": "Apache-2.0", "MPL-2.0": "MPL-2.0"}.items():
        path = Path("/usr/share/common-licenses", file)
        if path.exists():
            rows.append((want, path.read_text()))
    got = L.own_license(spark.createDataFrame(rows, "want string, text string")).collect()
    assert [r.own_license for r in got] == [r.want for r in got]


def test_odd_and_empty(spark):
    got = L.own_license(documents(spark, ODD)).collect()
    assert len(got) == len(ODD) and {r.own_license for r in got} == {None}
    assert L.own_license(documents(spark, [])).count() == 0


def test_file_columns_of_any_name_stay(spark):
    files = spark.createDataFrame([("a/b.txt", "words", 1, 2, 3, 4)], "path string, text string, `a.b` int, `q``w` int, `two words` int, Up int")
    out = L.inherit(L.own_license(files))
    assert out.columns == ["path", "text", "a.b", "q`w", "two words", "Up", "own_license", "own_score", "license", "origin", "origin_dir"]
    assert tuple(out.first())[:6] == ("a/b.txt", "words", 1, 2, 3, 4)
