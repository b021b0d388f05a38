"""Headers and licence texts: sentences across lines, version and variant words."""

from triage.llm import licenses

GPL3 = """ * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
"""
CASES = [
    (GPL3, "GPL-3.0"),
    (GPL3.replace("version 3", "version 2").replace("License, or", "License; or"), "GPL-2.0"),
    ("GNU Lesser General Public License, version 3.", "LGPL-3.0"),
    ("Creative Commons Attribution-NonCommercial 4.0 International", "CC-BY-NC-4.0"),
    ("// Copyright 2020 Foo Corp. Licensed under the MIT License.", "MIT"),
    ("Licensed under the MIT license.", "MIT"),
    ("// SPDX-License-Identifier: MIT", "MIT"),
    ("This page describes our tool and its parts. Released under the MIT License. See below for more.", "MIT"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY-4.0"),
    ("nothing of that kind, version 3", None),
    (None, None),
]


def test_headers_get_their_family_version_and_variant(spark):
    filler = [(f"z{i}/a.txt", f"words about nothing in particular number {i}") for i in range(60)]
    rows = [(f"d{i}/x.c", t) for i, (t, _) in enumerate(CASES)] + filler
    got = {r.path: r.license for r in licenses.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert [(t, got[f"d{i}/x.c"]) for i, (t, _) in enumerate(CASES)] == CASES
    assert all(got[p] is None for p, _ in filler)


def test_repeated_rows_and_long_lines(spark):
    long = "word " * 50_000 + ". Licensed under the MIT License. " + "word " * 50_000
    got = licenses.scan(spark.createDataFrame([("a/x", long), ("a/x", long), ("b/y", "x")], "path string, text string")).collect()
    assert sorted((r.path, r.license) for r in got) == sorted([("a/x", "MIT"), ("a/x", "MIT"), ("b/y", None)], key=str)
