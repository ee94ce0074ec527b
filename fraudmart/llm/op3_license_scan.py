"""Licence scans: sparse TF-IDF cosine to templates, and directory inheritance.

Every text is read whole. Its blocks are a licence file as a whole; the comment,
or else the paragraphs, around each line with a licence cue; and the runs of cue
lines themselves. Blocks and templates (short notices and full texts) become
sparse TF-IDF vectors with document frequencies counted over all blocks of the
corpus and the templates; the cosine is an equality join on terms, and a block's
best template wins above ``least``. The widest kind of block with a licence names
the file's own one (a sentence is shared by several licences, the whole text is
not), the best block of that kind first.

A file without one inherits from the nearest ancestor directory that has a
licence file with a licence: each distinct directory is expanded into its
ancestors (bounded by its depth), joined to the directories' licences, and the
deepest match is kept.

Cases: a null text has no block; a null path is a file of the root directory;
ties go to the alphabetically first licence; several licence files in one
directory: the highest score, then the name; repeated rows are answered one by
one; an empty table gives no rows; other columns are dropped unless named in
``keep``.
"""

from __future__ import annotations

import re
from functools import cache
from importlib import resources

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudmart.llm.common import prepare, stored

CUE = re.compile(r"licen[cs]|copyright|spdx|permission is hereby|redistribut|warrant|public domain|creative commons|all rights reserved", re.I)
TERM = re.compile(r"[a-z0-9]+(?:[.-][0-9a-z]+)*")
COMMENT = re.compile(r"\s*(?:#|//|/\*|\*|--|;|%|<!--|rem\b|dnl\b)", re.I)
OPENING, CLOSING = ("/*", "<!--"), ("*/", "-->")
WHOLE, REGION, RUN = range(3)  # kinds of blocks, widest first
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)(\.[a-z]+)?$"
# short notices in common use, by SPDX name (fixed texts); the full texts are in licences/
TEMPLATES: list[tuple[str, str]] = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This program is free software; licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    *[(f"{kind}GPL-{no}", f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} Public License as published by the Free Software Foundation, either version {no[0]} of the License, or (at your option) any later version.")
      for kind, name, no in (("", "General", "2.0"), ("", "General", "3.0"), ("L", "Lesser General", "3.0"), ("A", "Affero General", "3.0"))],
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v. 2.0."),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0."),
    ("ISC", "Released under the ISC License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, dedicated to the public domain under CC0 1.0."),
]


def terms(text: str) -> list[str]:
    return TERM.findall(text.lower())


@cache
def templates_in_use() -> list[tuple[str, str]]:
    """The short notices and the full texts of licences/; AGPL-3.0 is the text of GPL-3.0 under its name."""
    held = sorted(resources.files(__package__).joinpath("licences").iterdir(), key=lambda f: f.name)
    full = [(f.name.removesuffix(".txt"), f.read_text("utf-8")) for f in held if f.name.endswith(".txt")]
    affero = re.sub("(?i)(?<=GNU )(?=General Public)", "Affero ", dict(full)["GPL-3.0"])
    return [*TEMPLATES, *full, ("AGPL-3.0", affero)]


def _runs(marked: list[bool]) -> list[tuple[int, int]]:
    """(first, end) of each run of marked lines."""
    edges = [i for i, (x, y) in enumerate(zip([False, *marked], [*marked, False])) if x != y]
    return list(zip(edges[::2], edges[1::2]))


def _in_comments(lines: list[str]) -> list[bool]:
    out, closing = [], None
    for line in lines:
        inside = closing is not None or bool(COMMENT.match(line))
        if closing is None:
            closing = next((c for o, c in zip(OPENING, CLOSING) if line.lstrip().startswith(o)), None)
        if closing and closing in line:
            closing = None
        out.append(inside)
    return out


def blocks(text: str | None, whole: bool = False) -> list[tuple[int, list[str]]]:
    """(kind, terms) of the blocks of a whole text; ``whole``: it is a licence file."""
    out = [(WHOLE, terms(text))] if text and whole else []
    if text and CUE.search(text):
        lines = text.split("\n")
        cue = [bool(CUE.search(x)) for x in lines]
        runs = _runs(cue)
        comment = _in_comments(lines)
        regions = [r for r in _runs(comment) if any(cue[r[0]:r[1]])]
        held: list[tuple[int, int]] = []
        for a, b in _runs([bool(x.strip()) and not c for x, c in zip(lines, comment)]):
            if any(cue[a:b]):  # paragraphs with cues that only blank lines part are one notice
                if held and not any(x.strip() for x in lines[held[-1][1]:a]):
                    held[-1] = (held[-1][0], b)
                else:
                    held.append((a, b))
        out += [(REGION, terms("\n".join(lines[a:b]))) for a, b in regions + held if (a, b) not in runs]
        out += [(RUN, terms("\n".join(lines[a:b]))) for a, b in runs]
    return [x for x in out if x[1]]


def blocks_of(text: Column, whole: Column) -> Column:
    @F.arrow_udf("array<struct<kind:int,terms:array<string>>>")
    def run(texts: pa.Array, whole: pa.Array) -> pa.Array:
        return pa.array([[{"kind": k, "terms": x} for k, x in blocks(t, w)] for t, w in zip(texts.to_pylist(), whole.to_pylist())],
                        pa.list_(pa.struct([("kind", pa.int32()), ("terms", pa.list_(pa.string()))])))

    return run.asNondeterministic()(text, whole)


def _weighted(rows: DataFrame, key: list[str], df: DataFrame, total: int) -> DataFrame:
    """(key, term, w, norm): TF-IDF weights."""
    tf = rows.groupBy(*key, "term").agg(F.count("*").alias("tf"))
    w = tf.join(df, "term").withColumn("w", F.col("tf") * (F.log(F.lit(total + 1.0) / (F.col("df") + 1)) + 1))
    return w.withColumn("norm", F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(*key))))


def similarities(block_terms: DataFrame, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """(row, block, license, score): each block's best template, from rows (row, block, term)."""
    spark = block_terms.sparkSession
    templates = templates or templates_in_use()
    known = [(f"{i:03d}", name, t) for i, (name, text) in enumerate(templates) for t in terms(text)]
    template = spark.createDataFrame(known, "template string, license string, term string")
    n = block_terms.select("row", "block").distinct().count() + len(templates)
    df = (block_terms.select(F.concat_ws("/", "row", "block").alias("unit"), "term")
          .union(template.select("template", "term")).distinct()
          .groupBy("term").agg(F.count("*").alias("df")))
    df = stored(df, "licence-frequencies")
    a = _weighted(block_terms, ["row", "block"], df, n)
    b = _weighted(template, ["template", "license"], df, n).select(
        "template", "license", "term", F.col("w").alias("tw"), F.col("norm").alias("tnorm"))
    cosine = (a.join(F.broadcast(b), "term").groupBy("row", "block", "template", "license")
              .agg((F.sum(F.col("w") * F.col("tw")) / F.first(F.col("norm") * F.col("tnorm"))).alias("score")))
    best = F.min_by(F.struct("license", "score"), F.struct(-F.round("score", 9), "license"))
    return cosine.groupBy("row", "block").agg(best.alias("m")).select("row", "block", "m.license", "m.score")


def parent(path: Column) -> Column:
    """Directory of a path; the root is the empty string."""
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).otherwise("")


def ancestors(directory: Column) -> Column:
    """A directory and all above it, as (dir, depth); the root has depth 0."""
    parts = F.filter(F.split(directory, "/"), lambda p: p != "")
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda d: F.struct(
        F.array_join(F.slice(parts, 1, d), "/").alias("dir"), d.alias("depth")))


def inherit(files: DataFrame) -> DataFrame:
    """(dir, license, from_dir) for the directories of ``files`` (dir, path, license, score)
    that have a licensed licence file in them or above them."""
    held = (files.filter(F.col("license").isNotNull() & F.col("path").rlike(LICENCE_FILE))
            .groupBy("dir").agg(F.min_by("license", F.struct(-F.round("score", 9), "license", "path")).alias("license")))
    up = files.select("dir").distinct().select(F.col("dir").alias("below"), F.explode(ancestors(F.col("dir"))).alias("a"))
    found = up.select("below", "a.dir", "a.depth").join(held, "dir")
    return (found.groupBy(F.col("below").alias("dir"))
            .agg(F.max_by(F.struct("license", "dir"), "depth").alias("m"))
            .select("dir", F.col("m.license").alias("license"), F.col("m.dir").alias("from_dir")))


def scan(files: DataFrame, path: str = "path", text: str = "text", keep: list[str] | None = None,
         least: float = 0.6) -> DataFrame:
    """(keep, path, own_license, score, license, license_source, from_dir) per row."""
    spark = files.sparkSession
    prepare(spark)
    keep = keep or []
    clean = F.regexp_replace(F.regexp_replace(F.coalesce(F.col(f"`{path}`"), F.lit("")), "/+", "/"), "^/", "")
    rows = stored(files.select(
        F.monotonically_increasing_id().alias("row"), F.struct(*[F.col(f"`{c}`") for c in keep], F.lit(1).alias("__row")).alias("kept"),
        clean.alias("path"), blocks_of(F.col(f"`{text}`"), clean.rlike(LICENCE_FILE)).alias("blocks")), "licence-rows")
    units = rows.select("row", F.posexplode("blocks").alias("block", "b")).select(
        "row", "block", F.explode("b.terms").alias("term"))
    kinds = rows.select("row", F.posexplode("blocks").alias("block", "b")).select("row", "block", "b.kind")
    scored = similarities(units).filter(F.col("score") >= least).join(kinds, ["row", "block"])
    own = scored.groupBy("row").agg(F.min_by(
        F.struct("license", "score"), F.struct("kind", -F.round("score", 9), "license")).alias("m"))
    named = stored(rows.join(own, "row", "left").select(
        "kept", "path", parent(F.col("path")).alias("dir"), F.col("m.license").alias("license"), F.col("m.score").alias("score")),
        "licence-own")
    above = stored(inherit(named).withColumnRenamed("license", "above"), "licence-dirs")
    out = named.join(above, "dir", "left")
    return out.select(
        *[F.col(f"kept.`{c}`").alias(c) for c in keep], "path", F.col("license").alias("own_license"), F.round("score", 6).alias("score"),
        F.coalesce("license", "above").alias("license"),
        F.when(F.col("license").isNotNull(), "own").when(F.col("above").isNotNull(), "inherited").alias("license_source"),
        F.when(F.col("license").isNull(), F.col("from_dir")).alias("from_dir"))
