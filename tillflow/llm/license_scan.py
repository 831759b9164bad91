"""License scan: TF-IDF cosine to templates, and inheritance along directories
(DataFrame functions only).

Every line of every text is a possible header.  Lines and templates are sparse vectors
of words, weighted by term frequency and by inverse document frequency over all texts;
a line names a license if its cosine to one of the license's templates is at least
``COSINE``.  The best line of a text decides (ties: the first license by name).  A file
that is called like a licence file, or holds nothing but license lines, speaks for its
directory: texts without a header inherit the license of the nearest directory above
them that has such a file.

How it runs: document frequencies are counted over all texts, combined in the tasks
before the shuffle.  Of a template, the heaviest words are its signature, so many that
the rest alone can't reach the cosine: only lines that hold a signature word can match,
and only these, each once, are weighted.  Inheritance is resolved for each directory,
by joining its ancestors to the directories with a licence file, then joined to texts.

Defined cases: null and empty texts have no header; a null path is in no directory;
equal rows are answered alike; several licence files of a directory: the best score,
then the first by name; extra columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import col, written

COSINE = 0.6
#: Short notices and header lines of public licenses.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0 Universal public domain dedication."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
LICENSE_FILE = r"(?i)^(?:un)?(?:licen[cs]e|copying|copyright|notice)(?:[.-][^/]*)?$"
#: A word: letters, digits and non-ASCII characters, lower-cased for A-Z.
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_list(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, _UPPER, _LOWER), _NOT_WORD), lambda w: w != "")


def _weights(pairs: DataFrame, frequency: DataFrame, n_docs: int, key: str) -> DataFrame:
    """(key, word, n) -> ``weight``: n times the idf, and ``norm`` of the key's vector."""
    idf = F.log(F.lit(float(n_docs + 1)) / (F.coalesce("df", F.lit(0)) + 1)) + 1
    got = (pairs.join(frequency, F.col("word") == F.col("w"), "left")
           .select(key, "word", (F.col("n") * idf).alias("weight")))
    norms = got.groupBy(F.col(key).alias("k")).agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"))
    return got.join(norms, F.col(key) == F.col("k")).drop("k")


def header_licenses(lines: DataFrame, frequency: DataFrame, n_docs: int, cosine: float = COSINE,
                    templates=TEMPLATES) -> DataFrame:
    """(line, words) -> (line, license, score) of the lines that name a license."""
    spark = lines.sparkSession
    given = spark.createDataFrame([(k, name, text) for k, (name, text) in enumerate(templates)],
                                  "template int, license string, text string")
    pairs = (given.select("template", "license", F.explode(word_list(F.col("text"))).alias("word"))
             .groupBy("template", "license", "word").agg(F.count("*").alias("n")))
    ours = _weights(pairs.drop("license"), frequency, n_docs, "template").withColumn(
        "unit", F.col("weight") / F.col("norm"))
    vectors: dict[int, list[tuple[float, str]]] = {}
    for r in ours.select("template", "word", "unit").collect():  # the templates' words
        vectors.setdefault(r["template"], []).append((r["unit"], r["word"]))
    signature = set()
    for vector in vectors.values():
        rest = 1.0
        for unit, word in sorted(vector, key=lambda x: (-x[0], x[1])):
            if math.sqrt(max(rest, 0.0)) < cosine - 1e-9:
                break
            signature.add(word)
            rest -= unit * unit
    weights = spark.createDataFrame(
        [(t, templates[t][0], w, u) for t, v in vectors.items() for u, w in v],
        "template int, license string, tw string, unit double")
    holds = F.arrays_overlap("words", F.array(*[F.lit(w) for w in sorted(signature)]))
    likely = lines.where(holds).dropDuplicates(["line"])
    own = (likely.select("line", F.explode("words").alias("word"))
           .groupBy("line", "word").agg(F.count("*").alias("n")))
    weighted = _weights(own, frequency, n_docs, "line")
    score = F.sum(F.col("weight") * F.col("unit")) / F.first("norm")
    scored = (weighted.join(F.broadcast(weights), F.col("word") == F.col("tw"))  # a few hundred rows
              .groupBy("line", "template", "license").agg(score.alias("score")).where(F.col("score") >= cosine))
    best = scored.groupBy("line", "license").agg(F.max("score").alias("score"))
    return best.groupBy("line").agg(F.min(F.struct((-F.round("score", 9)).alias("s"), "license")).alias("b")).select(
        "line", F.col("b.license").alias("license"), (-F.col("b.s")).alias("score"))


def scan_licenses(docs: DataFrame, *, path: Column, doc_id: str = "doc_id", text: str = "text",
                  cosine: float = COSINE) -> DataFrame:
    """doc_id, path, license, score, via (header or directory; null: none) and n_lines (lines that
    name a license) for every text."""
    d = docs.select(col(doc_id).alias("doc_id"), path.cast("string").alias("path"),
                    col(text).cast("string").alias("text"))
    n_docs = d.count()
    frequency = written(
        d.select(F.explode(F.array_distinct(word_list(F.col("text")))).alias("w"))
        .groupBy("w").agg(F.count("*").alias("df")))
    # A text is known by its digests; lines by theirs.
    digest = [F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2")]
    lines = (d.select(*digest, F.explode(F.split("text", "\n")).alias("x"))
             .select("t1", "t2", word_list(F.col("x")).alias("words")).where(F.size("words") > 0)
             .withColumn("line", F.md5(F.concat_ws(" ", "words"))))
    named = written(header_licenses(lines.select("line", "words"), frequency, n_docs, cosine))
    # Copies of a text bring their lines along: a text's number is that of one copy.
    found = (lines.select("t1", "t2", F.col("line").alias("l")).join(named, F.col("l") == F.col("line"))
             .groupBy("t1", "t2").agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("b"),
                                      F.count("*").alias("n"))
             .select(F.col("t1").alias("f1"), F.col("t2").alias("f2"), F.col("b.license").alias("own"),
                     (-F.col("b.s")).alias("own_score"), "n"))
    size = F.size(F.filter(F.split("text", "\n"), lambda x: F.size(word_list(x)) > 0))
    sized = d.select("doc_id", "path", *digest, F.coalesce(size, F.lit(0)).alias("all_lines"))
    copies = sized.groupBy(F.col("t1").alias("c1"), F.col("t2").alias("c2")).agg(F.count("*").alias("copies"))
    found = (found.join(copies, (F.col("f1") == F.col("c1")) & (F.col("f2") == F.col("c2")))
             .select("f1", "f2", "own", "own_score", (F.col("n") / F.col("copies")).cast("bigint").alias("n_lines")))
    texts = sized.join(found, (F.col("t1") == F.col("f1")) & (F.col("t2") == F.col("f2")), "left")
    texts = texts.withColumn("dir", F.regexp_extract("path", r"^(.*)/[^/]*$", 1)).withColumn(
        "name", F.regexp_extract("path", r"([^/]*)$", 1))
    return _inherited(texts)


def _inherited(texts: DataFrame) -> DataFrame:
    speaks = F.col("own").isNotNull() & (F.col("name").rlike(LICENSE_FILE) | (F.col("n_lines") >= F.col("all_lines")))
    licensed = (texts.where(speaks & F.col("path").isNotNull()).groupBy(F.col("dir").alias("above"))
                .agg(F.min(F.struct((-F.col("own_score")).alias("s"), F.col("own").alias("l"))).alias("b"))
                .select("above", F.col("b.l").alias("dir_license"), (-F.col("b.s")).alias("dir_score")))
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.struct(
        F.array_join(F.slice(parts, F.lit(1), n), "/").alias("above"), n.alias("depth")))
    nearest = (texts.where("path IS NOT NULL").select("dir").distinct()
               .select("dir", F.explode(above).alias("a")).select("dir", "a.*")
               .join(licensed, "above").groupBy("dir")
               .agg(F.max(F.struct("depth", "dir_license", "dir_score")).alias("b"))
               .select(F.col("dir").alias("d"), "b.dir_license", "b.dir_score"))
    return (texts.join(nearest, (F.col("dir") == F.col("d")) & F.col("path").isNotNull(), "left")
            .select("doc_id", "path", F.coalesce("own", "dir_license").alias("license"),
                    F.round(F.coalesce("own_score", "dir_score"), 4).alias("score"),
                    F.when(F.col("own").isNotNull(), "header").when(F.col("dir_license").isNotNull(), "directory").alias("via"),
                    F.coalesce("n_lines", F.lit(0)).cast("bigint").alias("n_lines")))
