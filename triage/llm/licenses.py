"""Operator 2 [native]: licence scan by sparse TF-IDF cosine and directory inheritance.

``scan(files(path, text))``: every line and every sentence (across line breaks) of every file, header
or licence text, is compared with the licence templates by the
cosine of their TF-IDF vectors. Document frequencies of the templates' terms are counted over all
files; a term outside the templates weighs as one that no file has. A unit of cosine ``least`` or
more must have one of a template's heaviest terms (those left out can't reach ``least`` by
themselves: the prefix rule), so only units with such a term become vectors, inside their own rows.
Licences of one family differ by a version or a variant word only; a unit counts for such a
template if its words of ``VARIANTS`` are the template's.

A file's own licence is its best unit's. A licence file (by its name, or marked so in a column)
speaks for its directory; a file without an own licence inherits that of the nearest ancestor
directory with one, by equi-joins on directory paths. Where a directory has licence files of
several licences the most frequent one counts (ties: the smaller name).

Result per file: its columns but the text, ``license`` (null: none), ``origin`` (own, inherited, none), ``score``
of the own unit (rounded to 6 digits) and ``from_dir`` of an inherited one. Edge cases: null and
empty texts have no own licence; a null path has no directory and inherits the root's; ties between
templates go to the smaller name; repeated rows each get a row; other columns pass through (those
named like a result column are replaced); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triage.llm.common import cut

# fixed values: licence templates, header sentences and licence-file titles as published
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", "The MIT License (MIT)"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("all-rights-reserved", "All rights reserved."),
)
# fixed values: families by their names' pattern, and the words that tell their licences apart
VARIANTS = (("gnu", "GPL", ("2", "3", "affero", "lesser", "library")),
            ("cc", "^CC-", ("nc", "nd", "noncommercial", "noderivatives", "sa", "sharealike")))
LEAST = 0.7
SENTENCE = "[.;!?][ \\t\\r\\n]+|\\n[ \\t\\r]*\\n"
LICENSE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicense|notice)[^/]*$"
RESULT = ("license", "origin", "score", "from_dir")


def terms(text) -> Column:
    """Lower-cased runs of letters and digits, in order."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def marks(words, variants) -> Column:
    """The words among ``variants``, sorted and joined."""
    return F.array_join(F.array_sort(F.array_intersect(F.array_distinct(words), F.array(*[F.lit(v) for v in variants]))), " ")


def directory(path: Column) -> Column:
    """What stands before the last slash; the root is empty."""
    return F.regexp_extract(F.coalesce(path, F.lit("")), r"^(.*)/[^/]*$", 1)


def weights(files: DataFrame, templates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(term, idf) of the templates' terms over all files, and one row (idf of any other term).

    One pass over the texts: each file's distinct template terms, counted by partial sums.
    """
    vocabulary = templates.select(F.explode_outer("terms").alias("term")).distinct()
    listed = sorted(r.term for r in vocabulary.collect() if r.term)  # the template table is small and fixed
    wanted = F.array(*[F.lit(t) for t in listed])
    got = files.select(F.array_intersect(F.array_distinct(terms(F.coalesce("text", F.lit("")))), wanted).alias("has"))
    counts = cut(got.select(F.explode_outer(F.concat("has", F.array(F.lit("")))).alias("term")).groupBy("term").agg(F.count("*").alias("df")))
    n = F.coalesce(F.max(F.when(F.col("term") == "", F.col("df"))), F.lit(0))  # "" stands in every file once
    total = counts.agg(n.alias("n"))
    idf = vocabulary.filter("term is not null").join(counts, "term", "left").join(F.broadcast(total)).select(
        "term", (F.log((F.col("n") + 1) / (F.coalesce("df", F.lit(0)) + 1)) + 1).alias("idf"))
    return cut(idf), cut(total.select((F.log(F.col("n") + 1.0) + 1).alias("other")))


def vectors(lines: DataFrame, key: list[str], idf: DataFrame, other: DataFrame) -> DataFrame:
    """(key, term, weight of unit length) rows of ``lines(key, terms)``; the vocabulary's terms only."""
    tf = lines.select(*key, F.explode_outer("terms").alias("term")).filter("term <> ''").groupBy(*key, "term").agg(F.count("*").alias("tf"))
    w = tf.join(F.broadcast(idf), "term", "left").join(F.broadcast(other)).select(
        *key, "term", F.col("idf").isNotNull().alias("known"), (F.col("tf") * F.coalesce("idf", "other")).alias("w"))
    norm = w.groupBy(*key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return w.filter("known").join(norm, key).select(*key, "term", (F.col("w") / F.col("norm")).alias("w"))


def own_lines(files: DataFrame, key: str, least: float = LEAST) -> DataFrame:
    """(key, line_no, license, score) of each template that explains a line or a sentence; a sentence's
    number is its place among the sentences."""
    spark = files.sparkSession
    listed = F.array(*[F.struct(F.lit(i).alias("t"), F.lit(name).alias("license"), F.lit(text).alias("text"))
                       for i, (name, text) in enumerate(TEMPLATES)])
    templates = cut(spark.range(1).select(F.inline(listed)).select("t", "license", terms(F.col("text")).alias("terms")))
    for family, names, words in VARIANTS:
        templates = templates.withColumn(f"{family}_t", F.when(F.col("license").rlike(names), marks(F.col("terms"), words)).otherwise("any"))
    of_template = [x for x in templates.columns if x != "terms"]
    idf, other = weights(files, templates)
    of = cut(vectors(templates, of_template, idf, other))
    # heaviest terms of each template; the rest of its vector is shorter than ``least``
    rows, by = of.collect(), {}
    for r in rows:
        by.setdefault(r.t, []).append(r)
    heavy = set()
    for ws in by.values():
        rest = sum(r.w * r.w for r in ws)
        for r in sorted(ws, key=lambda x: (-x.w, x.term)):
            if rest < (least - 1e-9) ** 2:
                break
            heavy.add(r.term)
            rest -= r.w * r.w
    # whole texts first: few have a heavy term at all
    near = files.filter(F.arrays_overlap(terms(F.coalesce("text", F.lit(""))), F.array(*[F.lit(t) for t in sorted(heavy)]).cast("array<string>")))
    unit = lambda by: F.transform(F.split(F.coalesce("text", F.lit("")), by), lambda x, i: F.struct(i.alias("line_no"), x.alias("line")))
    lines = near.select(key, F.explode_outer(F.concat(unit("\n"), unit(SENTENCE))).alias("u")).select(key, "u.*")
    if heavy:
        lines = lines.filter(F.col("line").rlike(r"(?i)(?<![\p{L}\p{N}])(?:" + "|".join(sorted(heavy)) + r")(?![\p{L}\p{N}])"))
        # the cosine is at most the length of the template's vector over the words that the unit has
        listed = sorted({r.term for r in rows})
        own = F.array(*[F.array(*[F.struct(F.lit(r.term).alias("term"), F.lit(r.w * r.w).alias("sq")) for r in ws]) for ws in by.values()])
        has = F.array_intersect(F.array_distinct(terms(F.col("line"))), F.array(*[F.lit(t) for t in listed]))
        enough = lambda h, x: F.aggregate(x, F.lit(0.0), lambda acc, e: acc + F.when(F.array_contains(h, e["term"]), e["sq"]).otherwise(0.0)) >= (least - 1e-6) ** 2
        lines = lines.filter(F.exists(F.array(has), lambda h: F.exists(own, lambda x: enough(h, x))))
    else:
        lines = lines.limit(0)
    words = {r.term: r.idf for r in idf.collect()}  # the templates' terms
    unknown = other.first().other
    return explained(lines.withColumn("terms", terms(F.col("line"))).drop("line"), key, by, words, unknown, least)


def explained(lines: DataFrame, key: str, by: dict, idf: dict[str, float], unknown: float, least: float) -> DataFrame:
    """(key, line_no, license, score) of the units ``lines(key, line_no, terms)`` and the templates of cosine ``least`` or more.

    The sparse vectors of a unit and of the templates ``by`` (rows of (marks, term, weight) each) meet
    inside the unit's row, so neither terms nor texts are shuffled. The terms are sorted once; a run of
    k equal ones adds k squares to the norm, as 1 + 3 + ... + (2k - 1).
    """
    weight = F.create_map(*[F.lit(x) for t, w in sorted(idf.items()) for x in (t, w)])
    sq = lambda x: F.pow(F.coalesce(F.element_at(weight, x), F.lit(unknown)), 2.0)
    start = F.struct(F.lit("").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum"))

    def add(acc: Column, x: Column) -> Column:
        run = F.when(acc["last"] == x, acc["run"] + 2.0).otherwise(1.0)
        return F.struct(x.alias("last"), run.alias("run"), (acc["sum"] + run * sq(x)).alias("sum"))

    known = F.array(*[F.lit(t) for t in sorted(idf)])
    units = lines.withColumns({family: marks(F.col("terms"), words) for family, _, words in VARIANTS}) \
        .withColumn("norm", F.aggregate(F.sort_array("terms"), start, add, lambda acc: F.sqrt(acc["sum"]))) \
        .withColumn("known", F.filter("terms", lambda x: F.array_contains(known, x))).drop("terms") \
        .withColumn("own", F.map_from_entries(F.transform(F.array_distinct("known"), lambda t: F.struct(
            t, F.size(F.filter("known", lambda x: x == t)) * F.element_at(weight, t))))).drop("known")
    vectors_ = F.array(*[F.struct(
        F.lit(ws[0].license).alias("license"), *[F.lit(ws[0][f"{family}_t"]).alias(family) for family, *_ in VARIANTS],
        F.array(*[F.struct(F.lit(r.term).alias("term"), F.lit(r.w).alias("w")) for r in ws]).alias("terms")) for ws in by.values()])

    def score(t: Column) -> Column:
        agree = F.lit(True)
        for family, *_ in VARIANTS:
            agree = agree & ((t[family] == "any") | (t[family] == F.col(family)))
        dot = F.aggregate(t["terms"], F.lit(0.0), lambda acc, e: acc + e["w"] * F.coalesce(F.element_at("own", e["term"]), F.lit(0.0)))
        return F.struct((-F.round(F.when(agree, dot / F.col("norm")).otherwise(0.0), 6)).alias("s"), t["license"].alias("license"))

    # a filter on a column would be pushed below the projections and compute them again; one on a generated row stays
    found = F.filter(F.transform(vectors_, score), lambda x: x["s"] <= -least)
    return units.select(key, "line_no", F.inline_outer(found)).filter("s is not null") \
        .select(key, "line_no", "license", (-F.col("s")).alias("score"))


def scan(files: DataFrame, speaks: Column | None = None, least: float = LEAST) -> DataFrame:
    """Licence of each row of ``files(path, text)``; ``speaks``: which rows with an own licence on
    their first line are licence files beside those named so (default: none)."""
    files = files.drop(*RESULT).withColumn("_dir", directory(F.col("path")))
    # a file's key is its content's and path's: repeated rows share one result
    files = files.withColumn("_key", F.sha2(F.concat_ws("\0", F.coalesce("path", F.lit("")), F.coalesce("text", F.lit(""))), 256))
    found = own_lines(files.select("_key", "text"), "_key", least)
    own = found.groupBy("_key").agg(F.min(F.struct((-F.col("score")).alias("s"), "line_no", "license")).alias("b"),
                                    F.min("line_no").alias("_first")) \
        .select("_key", F.col("b.license").alias("_own"), (-F.col("b.s")).alias("score"), "_first")
    named = F.coalesce(F.col("path"), F.lit("")).rlike(LICENSE_FILE)
    rest = cut(files.drop("text").join(own, "_key", "left").drop("_key"))
    voice = rest.filter(F.col("_own").isNotNull() & (named if speaks is None else named | speaks))
    votes = voice.groupBy("_dir", "_own").agg(F.count("*").alias("n"))
    heads = votes.groupBy("_dir").agg(F.min(F.struct((-F.col("n")).alias("n"), "_own")).alias("b")) \
        .select(F.col("_dir").alias("from_dir"), F.col("b._own").alias("_theirs"))
    # ancestors of each directory once, not of each file
    dirs = rest.select("_dir").distinct()
    up = dirs.select("_dir", F.posexplode_outer(F.expr(
        "transform(sequence(size(split(_dir, '/')), 0), i -> array_join(slice(split(_dir, '/'), 1, i), '/'))")).alias("_far", "from_dir"))
    near = up.join(heads, "from_dir").groupBy("_dir").agg(F.min(F.struct("_far", "from_dir", "_theirs")).alias("b")) \
        .select("_dir", "b.from_dir", "b._theirs")
    out = rest.join(near, "_dir", "left")
    mine = F.col("_own").isNotNull()
    return out.withColumn("license", F.coalesce("_own", "_theirs")) \
        .withColumn("origin", F.when(mine, "own").when(F.col("_theirs").isNotNull(), "inherited").otherwise("none")) \
        .withColumn("from_dir", F.when(~mine, F.col("from_dir"))).drop("_dir", "_own", "_theirs", "_first")
