"""Operator 10: licences of files, by TF-IDF cosine of headers to templates and by directory. DataFrame functions only.

A text is cut into pieces at line ends and ends of sentences. Around every piece that speaks of a licence the runs of
up to `WRAP` pieces between blank lines are headers, so wrapped ones and those within long lines are seen whole; the
run with the largest score speaks for the piece. Headers and templates become sparse vectors over the words of the
templates, weighted by how rare a word is among the single pieces of all files; a header has the licence of the
template with the largest cosine, if that reaches `LEAST`.

A file that speaks of a licence is also compared as a whole, all its words, with the full texts of licences; with a
cosine of `FILE_LEAST` it is a licence file of its directory, as is one that hardly holds anything but headers. A file
without a licence of its own inherits the one of the nearest directory above it that has a licence file, found by
joining its ancestors with the licensed directories.

Defined results: NULL and empty texts have no header; of several licences in a file `license` is the one with the
largest cosine, then the first by name, and `licenses` lists all (of a full text only that one); a directory with several licence files has the first
licence by name; NULL paths inherit nothing; equal rows get equal results.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from math import log, sqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspan.llm.common import Scratch

LEAST = 0.6
# Share of a licence file's characters that headers make up.
FILE_SHARE = 0.5
# Pieces a header may be wrapped over.
WRAP = 4
# Cosine at which a whole file is the text of a licence.
FILE_LEAST = 0.75
HINT = (
    r"(?i)licen[cs]e|licensed|copyright|spdx|public domain|creative commons|permission is hereby|hereby granted"
    r"|redistribution and use|neither the name|permission to use"
)
# What ends a piece: a line end, and the blanks between two sentences.
PIECE_END = r"\r?\n|(?<=[.!?])[ \t]+(?=[A-Z\"(])"
# What comment signs and blanks a piece may begin with.
LEADER = r"^[\s*#/;%!<>|-]+"
TEXTS = os.path.join(os.path.dirname(__file__), "license_texts")

# Names of licences and how headers usually name them.
TEMPLATES = [
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Use of this source code is governed by a BSD 2-clause license."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD 3-clause license."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law this work is dedicated to the public domain, CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain, the Unlicense."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files, to deal in the Software without restriction",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met",
    ),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission.",
    ),
]
# What the AGPL has beyond the GPL 3, from which its full text is made.
AGPL = """Remote Network Interaction. If you modify the Program, your modified version must prominently offer all users
interacting with it remotely through a computer network (if your version supports such interaction) an opportunity to
receive the Corresponding Source of your version by providing access to the Corresponding Source from a network server
at no charge, through some standard or customary means of facilitating copying of software."""


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^a-z0-9.]+|\.(?![0-9])"), lambda w: w != "")


def _counted(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(key, F.explode(_words(F.col(text))).alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def _text_keys(text: str) -> dict[str, Column]:
    """96 bits that stand for a header, so that no row with its text is shuffled."""
    return {f"{text}_key": F.xxhash64(text), f"{text}_check": F.hash(text)}


def header_scores(headers: DataFrame, templates: DataFrame, least: float = LEAST) -> DataFrame:
    """(header_key, header_check, license, score) of every distinct header that some template fits. `headers`: header, files."""
    named = _counted(templates.distinct(), "template", "template")
    vocabulary = named.select("term").distinct()
    header = list(_text_keys("header"))
    words = headers.select(*[c.alias(name) for name, c in _text_keys("header").items()], "files", F.explode(_words(F.col("header"))).alias("term"))
    # Words of no template go before anything is counted; every row of the rest has the files of its header.
    terms = words.join(F.broadcast(vocabulary), "term").groupBy(*header, "files", "term").agg(F.count(F.lit(1)).alias("tf"))
    total = headers.agg(F.coalesce(F.sum("files"), F.lit(0)).alias("all"))
    common = terms.groupBy("term").agg(F.sum("files").alias("files"))
    idf = vocabulary.join(common, "term", "left").crossJoin(F.broadcast(total)).select(  # one row
        "term", (F.log((1 + F.col("all")) / (1 + F.coalesce("files", F.lit(0)))) + 1).alias("idf")
    )
    weigh = lambda df: df.join(F.broadcast(idf), "term").withColumn("w", F.col("tf") * F.col("idf"))
    a, b = weigh(terms), weigh(named)
    a_norm = a.groupBy(*header).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("a_norm"))
    b_norm = b.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("b_norm"))
    dots = a.select(*header, "term", "w").join(F.broadcast(b.select("template", "term", F.col("w").alias("v"))), "term")
    dots = dots.groupBy(*header, "template").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    score = F.round(F.col("dot") / F.col("a_norm") / F.col("b_norm"), 6)
    scored = dots.join(a_norm, header).join(F.broadcast(b_norm), "template").join(F.broadcast(templates), "template")
    scored = scored.select(*header, "license", score.alias("score"))
    best = scored.groupBy(*header).agg(F.min(F.struct((-F.col("score")).alias("minus"), "license")).alias("best"))
    return best.select(*header, F.col("best.license").alias("license"), (-F.col("best.minus")).alias("score")).where(
        F.col("score") >= least
    )


def _directory(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def full_texts() -> dict[str, str]:
    """Full texts of licences by name."""
    texts = {}
    for name in sorted(os.listdir(TEXTS)):
        with open(os.path.join(TEXTS, name), encoding="utf-8") as file:
            texts[name.removesuffix(".txt")] = file.read()
    texts["AGPL-3.0"] = re.sub(r"GNU(\s+)General", r"GNU\1Affero General", re.sub("GNU GENERAL", "GNU AFFERO GENERAL", texts["GPL-3.0"])) + AGPL
    return texts


def _text_vectors(spark: SparkSession, texts: dict[str, str]) -> tuple[DataFrame, float]:
    """(term, idf, v: its share in the vector of every text, in their order), and the idf of words no text has."""
    counts = [Counter(w for w in re.split(r"[^a-z0-9.]+|\.(?![0-9])", text.lower()) if w) for text in texts.values()]
    spread = Counter(term for count in counts for term in count)
    idf = {term: log((1 + len(texts)) / (1 + times)) + 1 for term, times in spread.items()}
    vectors = [{term: (1 + log(tf)) * idf[term] for term, tf in count.items()} for count in counts]
    norms = [sqrt(sum(w * w for w in vector.values())) for vector in vectors]
    rows = [(term, idf[term], [v.get(term, 0.0) / norm for v, norm in zip(vectors, norms, strict=True)]) for term in sorted(idf)]
    return spark.createDataFrame(rows, "term string, idf double, v array<double>"), log(1 + len(texts)) + 1


def whole_files(candidates: DataFrame, texts: dict[str, str], least: float = FILE_LEAST) -> DataFrame:
    """(text_key, file_license, file_score) of the texts that are the text of a licence. `candidates`: text_key, text."""
    names = list(texts)
    vectors, unknown = _text_vectors(candidates.sparkSession, texts)
    terms = candidates.dropDuplicates(["text_key"]).select("text_key", F.explode(_words(F.col("text"))).alias("term"))
    terms = terms.groupBy("text_key", "term").agg(F.count(F.lit(1)).alias("tf")).join(F.broadcast(vectors), "term", "left")
    w = (1 + F.log("tf")) * F.coalesce("idf", F.lit(unknown))
    dots = [F.sum(F.coalesce(w * F.get("v", F.lit(k)), F.lit(0.0))).alias(f"dot{k}") for k in range(len(names))]
    sums = terms.groupBy("text_key").agg(F.sqrt(F.sum(w * w)).alias("norm"), *dots)
    scores = [F.struct((-F.round(F.col(f"dot{k}") / F.col("norm"), 6)).alias("minus"), F.lit(name).alias("license")) for k, name in enumerate(names)]
    best = sums.select("text_key", F.array_min(F.array(*scores)).alias("best"))
    found = best.select("text_key", F.col("best.license").alias("file_license"), (-F.col("best.minus")).alias("file_score"))
    return found.where(F.col("file_score") >= least)


def _headers(files: DataFrame) -> DataFrame:
    """Every run of pieces around a piece that speaks of a licence: place of the piece, header, single (no other piece)."""
    pieces = F.transform(F.split("text", PIECE_END), lambda p: F.trim(F.regexp_replace(p, LEADER, "")))
    cut = files.withColumn("pieces", pieces)
    places = F.filter(F.sequence(F.lit(0), F.size("pieces") - 1), lambda k: F.rlike(F.get("pieces", k), F.lit(HINT)))
    # Only the pieces around each place go on.
    near = cut.select(*files.columns, "pieces", F.explode(places).alias("place"))
    begin = F.greatest(F.col("place") - (WRAP - 1), F.lit(0))
    near = near.select(
        *files.columns, "place", (F.col("place") - begin).alias("at"), F.slice("pieces", begin + 1, F.col("place") - begin + WRAP).alias("around")
    )
    runs = [
        F.struct(F.slice("around", F.col("at") - before + 1, before + after + 1).alias("run"), F.lit(before + after == 0).alias("single"))
        for before in range(WRAP)
        for after in range(WRAP - before)
    ]
    inside = [(F.col("at") >= b) & (F.col("at") + a < F.size("around")) for b in range(WRAP) for a in range(WRAP - b)]
    some = F.array(*[F.when(fits, run) for fits, run in zip(inside, runs, strict=True)])
    some = F.filter(some, lambda r: r.isNotNull() & ~F.array_contains(r["run"], ""))
    made = near.select(*files.columns, "place", F.explode(some).alias("made"))
    return made.select(*files.columns, "place", F.array_join("made.run", " ").alias("header"), "made.single")


def license_scan(files: DataFrame, templates: DataFrame | None = None, least: float = LEAST) -> DataFrame:
    """One row per row of `files` (id, path, text): license, licenses, score, how (header, file, inherited, none)."""
    if templates is None:
        values = ", ".join(f"('{name}', '{text}')" for name, text in TEMPLATES)
        templates = files.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t(license, template)")
    keyed = files.select("id", "path", "text", F.xxhash64("path", "text").alias("file"))
    spoken = keyed.where(F.rlike("text", F.lit(HINT)))
    found = _headers(spoken.select("id", "file", "path", "text", F.length("text").alias("size")))
    found = found.drop("text")
    scratch = Scratch(files.sparkSession, "licenses")
    headers = scratch.save(found.groupBy("header").agg(F.count_if("single").alias("files")))
    fitting = scratch.save(header_scores(headers, templates, least))
    keys = _text_keys("header")
    scored = found.withColumns({**keys, "length": F.length("header")}).drop("header").join(fitting, list(keys))
    first = F.min(F.struct((-F.col("score")).alias("minus"), "license"))
    length = F.min(F.when(F.col("single"), F.col("length")))
    placed = scored.groupBy("id", "file", "place").agg(
        first.alias("first"), F.coalesce(length, F.lit(0)).alias("length"), F.max("size").alias("size"), F.first("path").alias("path")
    )
    by_header = placed.groupBy("id", "file").agg(
        F.min("first").alias("first"),
        F.sort_array(F.collect_set("first.license")).alias("licenses"),  # of the templates
        # Rows that repeat a file share its places.
        (F.sum("length") / F.max("size") >= FILE_SHARE).alias("is_file"),
        F.first("path").alias("path"),
    )
    # The clauses of the longer BSD licence contain those of the shorter one.
    both = F.array_contains("licenses", "BSD-2-Clause") & F.array_contains("licenses", "BSD-3-Clause")
    named = F.when(both & (F.col("first.license") == "BSD-2-Clause"), "BSD-3-Clause").otherwise(F.col("first.license"))
    by_header = by_header.select(
        "id", "file", "path", named.alias("license"), (-F.col("first.minus")).alias("score"), "is_file",
        F.when(both, F.array_remove("licenses", "BSD-2-Clause")).otherwise(F.col("licenses")).alias("licenses"),
    )
    keys = spoken.select("id", "file", "path", F.xxhash64("text").alias("text_key"))
    whole = scratch.save(whole_files(spoken.select(F.xxhash64("text").alias("text_key"), "text"), full_texts()))
    by_text = keys.join(whole, "text_key").select("id", "file", "path", F.col("file_license").alias("license"), F.col("file_score").alias("score"))
    by_text = by_text.distinct().select("*", F.lit(True).alias("is_file"), F.array("license").alias("licenses"))
    by_text = by_text.withColumn("text", F.lit(1))
    # A full text decides alone.
    own = by_text.unionByName(by_header.withColumn("text", F.lit(0))).groupBy("id", "file").agg(
        F.max_by(F.struct("path", "license", "score", "licenses", "is_file"), "text").alias("own")
    )
    own = scratch.save(own.select("id", "file", "own.*"))
    licensed = own.where("is_file AND path IS NOT NULL").groupBy(_directory(F.col("path")).alias("directory"))
    licensed = licensed.agg(F.min("license").alias("dir_license"))
    # Ancestors of the directories that have files, each directory once.
    directories = keyed.where("path IS NOT NULL").select(_directory(F.col("path")).alias("own_dir")).distinct()
    steps = F.split("own_dir", "/")
    ancestors = directories.select(
        "own_dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(steps)), lambda k: F.array_join(F.slice(steps, 1, k), "/"))).alias("directory")
    ).distinct()
    nearest = ancestors.join(licensed, "directory").groupBy("own_dir").agg(
        F.max_by("dir_license", F.length("directory")).alias("dir_license")
    )
    mine = own.drop("path").withColumnsRenamed({"id": "_id", "file": "_file"})
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("file") == F.col("_file"))
    result = keyed.select("id", "path", "file", _directory(F.col("path")).alias("own_dir")).join(mine, same, "left")
    result = result.join(nearest, "own_dir", "left")
    how = (
        F.when(F.col("is_file"), "file").when(F.col("license").isNotNull(), "header").when(F.col("dir_license").isNotNull(), "inherited")
    )
    return result.select(
        "id",
        "path",
        F.coalesce("license", "dir_license").alias("license"),
        F.coalesce(F.array_join("licenses", ","), F.col("dir_license"), F.lit("")).alias("licenses"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        how.otherwise("none").alias("how"),
    )
