"""Licence scans: TF-IDF cosine of header lines and licence files to templates, then inheritance by directory.

Statements are the lines that name a licence, and whole licence files. Equal statements are scored once. Terms weigh
(1 + ln n) * idf, with idf = ln((1 + N) / (1 + df)) + 1 over all distinct statements and templates. Sparse vectors meet
the templates in an equi-join on terms; the best template at ``LEAST`` cosine or more is the statement's licence. A file
without a licence of its own takes that of its nearest ancestor directory with a licence file, found by joining the
distinct directories' ancestor paths. All steps are DataFrame operations, on whole texts.

A best template of another family, variant or version than the statement names is no match. Statements without a match
are met, passage by passage, with whole licence texts and the usual variants of notices (``licence_passages``).

Defined cases: a null text has no statement; a null path is in no directory; repeated rows are judged alike; the best
of several statements wins, then the smaller licence name; of several licence files in a directory the best, then the
smaller licence name; without templates nothing has a licence; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladegrid.llm import licence_passages
from cladegrid.session import cut_lineage

LEAST = 0.6
MARKER = r"(?i)licen[sc]e|copyright|spdx-"
TERM = r"[a-z0-9][a-z0-9.+-]*[a-z0-9]|[a-z0-9]"
FILE_NAME = r"(?i)^(?:un)?licen[sc]e|^copying|^copyright"

# Short statements of common licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License, CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)


def statements(files: DataFrame) -> DataFrame:
    """(key, path, id, statement) of files (key, path, text): licence lines, and the texts with them and of licence files; id is a hash."""
    name = F.element_at(F.split("path", "/"), -1)
    is_file = F.coalesce(name.rlike(FILE_NAME), F.lit(False))
    marked = files.where(F.col("text").rlike(MARKER) | is_file & (F.col("text") != ""))
    lines = F.filter(F.split("text", r"\r?\n|\r"), lambda line: line.rlike(MARKER))
    both = F.array_distinct(F.array_append(lines, F.col("text")))
    return marked.select("key", "path", F.explode(both).alias("statement")).withColumn("id", F.md5("statement"))


def _terms(rows: DataFrame, text: str) -> DataFrame:
    """The terms of a text and their counts, ``term`` and ``n``, with the other columns."""
    found = F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))
    keys = [c for c in rows.columns if c != text]
    return rows.select(*keys, F.explode(found).alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("n"))


def score_statements(texts: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """(id, licence, score, whole) of the distinct statements (id, statement) whose best template reaches ``least``."""
    distinct = texts.groupBy("id").agg(F.first("statement").alias("statement"))
    own = cut_lineage(_terms(distinct, "statement"))
    models = texts.sparkSession.createDataFrame([(i, name, text) for i, (name, text) in enumerate(templates)], "template int, licence string, model string")
    models = _terms(models, "model")
    units = own.select("id").distinct().count() + models.select("template").distinct().count()
    terms = own.select("term").unionByName(models.select("term"))
    # only the terms' counts meet the rows, and of a statement only its norm and the terms that templates have
    idf = terms.groupBy("term").agg((F.log(F.lit(1.0 + units) / (F.lit(1.0) + F.count("*"))) + 1).alias("idf"))
    weight = (F.lit(1.0) + F.log(F.col("n").cast("double"))) * F.col("idf")
    own = own.join(idf, "term").withColumn("w", weight)
    models = models.join(idf, "term").withColumn("v", weight)
    norms = own.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    lengths = models.groupBy("template").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("length"))
    dots = own.join(models.select("template", "licence", "term", "v"), "term").groupBy("id", "template", "licence").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    cosine = dots.withColumn("whole", F.lit(False)).join(norms, "id").join(lengths, "template").select("id", "template", "licence", "whole", F.round(F.col("dot") / (F.col("norm") * F.col("length")), 6).alias("score"))
    best = cosine.where(F.col("score") >= least).groupBy("id").agg(_best("score", "licence", "template"))
    best = cut_lineage(best.select("id", "best.licence", "best.score", "best.whole", "best.template"))
    if templates is not TEMPLATES:
        return best.drop("template")
    named = lambda text: licence_passages.marks(licence_passages.joined_terms(F.col(text)))
    known = texts.sparkSession.createDataFrame([(i, text) for i, (_, text) in enumerate(templates)], "template int, model string").select("template", named("model").alias("known"))
    fitting = distinct.join(best, "id").join(F.broadcast(known), "template").where(named("statement") == F.col("known")).select("id", "licence", "score", "whole")
    others = cut_lineage(distinct.join(fitting.select("id"), "id", "left_anti"))
    further = licence_passages.score_passages(others, least).groupBy("id").agg(_best("score", "licence"))
    return fitting.unionByName(further.select("id", "best.licence", "best.score", "best.whole"))


def _best(score: str, licence: str, *others: str) -> Column:
    """A match of a whole text, then the highest score, then the smaller licence name."""
    return F.min(F.struct((~F.col("whole")).alias("part"), (-F.col(score)).alias("order"), F.col(licence).alias("licence"), F.col(score).alias("score"), "whole", *others)).alias("best")


def folder_of(path: Column) -> Column:
    """The directory of a path without the last slash; empty for the top."""
    return F.when(path.contains("/"), F.regexp_replace(path, r"(?s)/[^/]*$", "")).otherwise(F.when(path.isNotNull(), ""))


def nearest_folder(folders: DataFrame, licensed: DataFrame) -> DataFrame:
    """(folder, licence, score, from_folder) of folders with a licensed folder at or above them."""
    distinct = folders.select("folder").where("folder is not null").distinct()
    parts = F.split("folder", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    listed = distinct.withColumn("up", F.explode(F.array_distinct(above)))
    met = listed.join(licensed.select(F.col("folder").alias("up"), "licence", "score"), "up")
    best = F.max(F.struct(F.length("up").alias("size"), "up", "licence", "score")).alias("best")
    return met.groupBy("folder").agg(best).select("folder", "best.licence", "best.score", F.col("best.up").alias("from_folder"))


def scan_licences(files: DataFrame, key: str, path: str, text: str, templates: Sequence[tuple[str, str]] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """(key, path, licence, score, how, from_folder): how is ``own``, ``inherited`` or null."""
    rows = files.select(F.col(f"`{key}`").alias("key"), F.col(f"`{path}`").alias("path"), F.col(f"`{text}`").alias("text"))
    found = cut_lineage(statements(rows))
    scored = found.join(score_statements(found, templates, least), "id")
    own = scored.groupBy("key", "path").agg(_best("score", "licence")).select(F.col("key").alias("of"), F.col("path").alias("of_path"), "best.licence", "best.score")
    name = F.element_at(F.split("path", "/"), -1)
    licensed = scored.where(name.rlike(FILE_NAME)).groupBy(folder_of(F.col("path")).alias("folder")).agg(_best("score", "licence"))
    licensed = licensed.select("folder", "best.licence", "best.score")
    named = rows.select("key", "path", folder_of(F.col("path")).alias("folder"))
    joined = named.join(own, F.col("key").eqNullSafe(F.col("of")) & F.col("path").eqNullSafe(F.col("of_path")), "left").drop("of", "of_path")
    near = nearest_folder(named, licensed).select("folder", F.col("licence").alias("near"), F.col("score").alias("near_score"), "from_folder")
    joined = joined.join(near, "folder", "left")
    has = F.col("licence").isNotNull()
    how = F.when(has, "own").when(F.col("near").isNotNull(), "inherited")
    return joined.select("key", "path", F.coalesce("licence", "near").alias("licence"), F.when(has, F.col("score")).otherwise(F.col("near_score")).alias("score"), how.alias("how"), F.when(~has, F.col("from_folder")).alias("from_folder"))
