import pytest

from loamfold.llm import queries
from loamfold.llm.licenses import TEMPLATES, file_licenses, rare_terms

from .sql import same_rows

APACHE, MIT, GPL = "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."


def test_query_against_sql(spark):
    name, folder = "op4_license_inheritance", "/root/testdata/sf0.01"
    frame = queries.RUNNERS[name](spark, folder)
    assert same_rows(frame, queries.ORACLES[name], folder) == 1000
    rows = frame.collect()
    assert sum(r.own_license is not None for r in rows) == sum("icen" in r.text for r in queries.table(spark, folder, "documents").collect())
    assert any(r.inherited_from for r in rows)


def test_inheritance_and_odd_rows(spark):
    rows = [
        ("LICENSE", MIT), ("a/LICENSE.txt", "x\n" + APACHE), ("a/b/c/f.py", "code here"), ("a/b/COPYING", GPL), ("a/x.py", "nothing"), ("d/f.py", "# " + GPL + "\ncode"), ("d/g.py", None),
        ("ab/f.py", ""), (None, "no path"), (None, MIT), ("a/x.py", "nothing"), ("e/LICENSE", "no licence text at all"), ("e/f", "word " * 20000), ("license/f.py", "z"),
    ]
    frame = spark.createDataFrame([(*r, "s", 1) for r in rows], "path string, text string, folder string, term int")
    got = file_licenses(frame, keep=("path", "folder"))
    assert got.columns == ["path", "folder", "own_license", "score", "license", "inherited_from"]
    want = [
        ("LICENSE", "MIT", None), ("a/LICENSE.txt", "Apache-2.0", None), ("a/b/c/f.py", "GPL-3.0", "a/b"), ("a/b/COPYING", "GPL-3.0", None), ("a/x.py", "Apache-2.0", "a"), ("d/f.py", "GPL-3.0", None), ("d/g.py", "MIT", ""),
        ("ab/f.py", "MIT", ""), (None, None, None), (None, "MIT", None), ("a/x.py", "Apache-2.0", "a"), ("e/LICENSE", "MIT", ""), ("e/f", "MIT", ""), ("license/f.py", "MIT", ""),
    ]
    assert sorted(map(repr, ((r.path, r.license, r.inherited_from) for r in got.collect()))) == sorted(map(repr, want))
    assert file_licenses(frame.limit(0)).count() == 0
    with pytest.raises(ValueError, match="score"):
        file_licenses(frame.withColumnRenamed("term", "score"), keep=("score",))


def test_near_licences_are_told_apart(spark):
    notices = [(i, n) for i, n in TEMPLATES if "BSD" not in i]
    varied = [
        ("LGPL-3.0", "# This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
        ("GPL-2.0", "* Licensed under the GNU General Public License, version 2 *"),
        ("CC-BY-SA-4.0", "The text is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
        ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0"),
        ("MIT", "// Use of this source code is governed by an MIT-style license that can be found in the LICENSE file"),
    ]
    rows = [(f"d/{k}.txt", f"first line\n{text}\nlast") for k, (_, text) in enumerate(notices + varied)] + [(f"e/{k}.txt", "plain words of a file") for k in range(200)]
    got = {r.path: r.own_license for r in file_licenses(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert [got[f"d/{k}.txt"] for k in range(len(notices + varied))] == [i for i, _ in notices + varied]
    assert not any(v for k, v in got.items() if k.startswith("e/"))


def test_rare_terms_are_needed():
    assert rare_terms({"a": 1.0, "b": 1.0, "c": 3.0}, 0.7) == {"c"}
    assert rare_terms({"a": 1.0, "b": 1.0}, 0.7) == {"a", "b"} - {"a"} or rare_terms({"a": 1.0, "b": 1.0}, 0.7) == {"a", "b"}
