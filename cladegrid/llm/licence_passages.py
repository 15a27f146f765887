"""Passages of statements against whole licence texts and the usual variants of notices.

Passages are windows of terms around a marker, the first terms of a statement, windows of the size of short licence
texts from their opening words on, and whole statements that speak of warranty. Windows meet notices, the others meet
whole texts. Weights are those of ``licences`` with idf over the templates alone, so a passage scores alike in every
table; terms of no template weigh most. A passage and a notice must name the same licence family, variant and version,
a text must not be named otherwise in its first terms and must have the same clauses; else that template is no match.
"""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladegrid.session import cut_lineage

TERM = r"[a-z0-9][a-z0-9.+-]*[a-z0-9]|[a-z0-9]"
LEAST_TEXT = 0.85
HEAD = 12
# Terms before and after a marker.
SHAPES = ((1, 1), (3, 1), (1, 3), (5, 2), (8, 3), (3, 8), (12, 20))
# Sizes of windows from an opening on, as of ISC, MIT and BSD texts.
SIZES = (110, 165, 190, 220)
MARKED = r"licen[sc]|copyright|spdx-"
OPENING = r"^(?:permission (?:is|to)|redistribution and)\b"

_GNU = {"AGPL-3.0": ("Affero ", "AGPL", "3"), "GPL-2.0": ("", "GPL", "2"), "GPL-3.0": ("", "GPL", "3"), "LGPL-2.1": ("Lesser ", "LGPL", "2.1"), "LGPL-3.0": ("Lesser ", "LGPL", "3")}
_OTHERS = {
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 license", "Apache License Version 2.0, January 2004"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License"),
    "CC0-1.0": ("CC0 1.0 Universal license", "Creative Commons CC0 1.0 Universal Public Domain Dedication license"),
    "ISC": ("ISC License",),
    "MIT": ("MIT License", "MIT License (MIT)"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "Mozilla Public License, v. 2.0", "MPL 2.0 license"),
}
_CC = {"BY": "Attribution", "BY-NC": "Attribution-NonCommercial", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
_HEADER = "redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version"


def notices() -> list[tuple[str, str]]:
    """(licence, notice) of the usual licences, their names and SPDX ids."""
    named = {name: (forms, (name,)) for name, forms in _OTHERS.items()}
    for name, (word, short, version) in _GNU.items():
        forms = (f"GNU {word}General Public License, version {version}", f"GNU {word}General Public License v{version}.0", f"GNU {short} v{version} license", f"{short}v{version} license", f"{short}-{name.split('-')[1]} license", _HEADER.format(word, version))
        named[name] = (forms, (name, f"{name}-only", f"{name}-or-later", f"{name}+"))
    for short, long in _CC.items():
        for version in ("2.0", "2.5", "3.0", "4.0"):
            name = f"CC-{short}-{version}"
            named[name] = ((f"Creative Commons {long} {version} International License", f"Creative Commons {long} {version} license", f"CC {short} {version} license", f"{name} license"), (name,))
    rows = [(name, text.format(form)) for name, (forms, _) in named.items() for form in forms for text in ("{}", "Licensed under the {}", "Released under the terms of the {}")]
    return sorted(rows + [(name, f"SPDX-License-Identifier: {id_}") for name, (_, ids) in named.items() for id_ in ids])


def texts() -> list[tuple[str, str]]:
    """(licence, text) of the whole licence texts kept beside this module."""
    return [(p.name.removesuffix(".txt"), p.read_text()) for p in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))]


_NAMED = {
    "gpl": r"general public|gpl", "lesser": r"lesser|lgpl|library general", "affero": r"affero|agpl", "apache": r"\bapache\b", "mit": r"\bmit\b", "isc": r"\bisc\b", "mpl": r"mozilla|\bmpl",
    "bsd": r"\bbsd\b", "2-clause": r"\b2-clause|simplified bsd|freebsd", "3-clause": r"\b3-clause|new bsd|modified bsd", "4-clause": r"\b4-clause", "cc": r"creative commons|\bcc\b", "cc0": r"\bcc0|\bcc zero|public domain dedication",
    "nc": r"non-?commercial|\bby-nc|\bby nc", "sa": r"share-?alike|\bby[ -](?:nc[ -])?sa\b", "nd": r"no-?deriv|\bby[ -](?:nc[ -])?nd\b",
}
_VERSION = r"(?:version|\bv|gplv|gpl|mpl|apache|apache licen[sc]e|apache software licen[sc]e|public licen[sc]e|\bby|\bnc|\bsa|\bnd|attribution|commercial|alike|derivatives|derivs|cc0)[ .-]?v? ?(\d(?:\.\d+)*)\b"
_CLAUSES = {"endorse": r"endorse or promote", "advertising": r"advertising materials"}


def _flags(text: Column, patterns: dict[str, str]) -> Column:
    return F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(name)) for name, p in patterns.items()]))


def joined_terms(text: Column) -> Column:
    return F.array_join(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)), " ")


def marks(passage: Column) -> Column:
    """Family, variant and version terms of a passage of joined terms, sorted."""
    versions = F.transform(F.regexp_extract_all(passage, F.lit(_VERSION), F.lit(1)), lambda v: F.regexp_replace(v, r"(?:\.0)+$", ""))
    return F.array_sort(F.array_distinct(F.concat(_flags(passage, _NAMED), versions)))


def _head(passage: Column) -> Column:
    return F.substring_index(passage, " ", HEAD)


def _counts(rows: DataFrame) -> DataFrame:
    return rows.select("id", "whole", F.explode(F.split("passage", " ")).alias("term")).groupBy("id", "whole", "term").agg(F.count("*").alias("n"))


def passages(statements: DataFrame) -> DataFrame:
    """(of, whole, passage) of statements (id, statement)."""
    terms = F.regexp_extract_all(F.lower("statement"), F.lit(TERM), F.lit(0))
    named = "|".join(_NAMED.values())
    # a statement without any name and warranty has no passages
    rows = statements.select(F.col("id").alias("of"), terms.alias("terms")).where("size(terms) > 0").where(F.array_join("terms", " ").rlike(f"{named}|warrant"))
    places = F.sequence(F.lit(1), F.size("terms"))
    cut = lambda start, size: F.array_join(F.slice("terms", F.greatest(start, F.lit(1)), size), " ")
    around = F.filter(places, lambda i: F.element_at("terms", i).rlike(MARKED))
    window = lambda b, a: lambda i: cut(i - b, F.least(i, F.lit(b + 1)) + a)
    windows = [F.transform(around, window(*shape)) for shape in SHAPES]
    short = rows.select("of", F.explode(F.array_distinct(F.concat(F.array(cut(F.lit(1), F.lit(HEAD))), *windows))).alias("passage"))
    opening = F.filter(places, lambda i: cut(i, F.lit(2)).rlike(OPENING))
    text_of = lambda n: lambda i: cut(i, F.lit(n))
    longer = F.concat(F.array(F.array_join("terms", " ")), *[F.transform(opening, text_of(n)) for n in SIZES])
    long = rows.select("of", F.explode(F.array_distinct(longer)).alias("passage")).where(F.col("passage").contains("warrant"))
    return short.where(F.col("passage").rlike(named)).select("of", F.lit(False).alias("whole"), "passage").unionByName(long.select("of", F.lit(True).alias("whole"), "passage"))


def score_passages(statements: DataFrame, least: float, short: Sequence[tuple[str, str]] | None = None, whole: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """(id, licence, score, whole) of statements (id, statement), a row for each licence of their passages."""
    short, whole = notices() if short is None else short, texts() if whole is None else whole
    listed = [(i, name, text, k == 1) for k, part in enumerate((short, whole)) for i, (name, text) in enumerate(part)]
    models = statements.sparkSession.createDataFrame(listed, "id int, licence string, text string, whole boolean").withColumn("passage", joined_terms(F.col("text")))
    counts = _counts(models)
    idf = counts.groupBy("term").agg((F.log(F.lit(1.0 + len(listed)) / (F.lit(1.0) + F.count("*"))) + 1).alias("idf"))
    most = F.log(F.lit(1.0 + len(listed))) + 1
    weight = (F.lit(1.0) + F.log(F.col("n").cast("double"))) * F.coalesce("idf", most)
    # the tables of templates have a fixed size, so they are broadcast
    weights = counts.join(idf, "term").withColumn("v", weight)
    lengths = weights.groupBy("id", "whole").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("length"))
    allowed = models.where("not whole").groupBy("licence").agg(F.flatten(F.collect_set(marks(F.col("passage")))).alias("allowed"))
    known = models.join(allowed, "licence", "left").join(lengths, ["id", "whole"])
    known = known.select(F.col("id").alias("template"), "whole", "licence", "length", marks(F.col("passage")).alias("named"), F.coalesce("allowed", F.array().cast("array<string>")).alias("allowed"), _flags(F.col("passage"), _CLAUSES).alias("clauses"))
    weights = weights.select(F.col("id").alias("template"), "whole", "term", "v")

    found = cut_lineage(passages(statements).withColumn("id", F.md5("passage")))
    own = found.groupBy("id", "whole").agg(F.first("passage").alias("passage"))
    terms = _counts(own).join(F.broadcast(idf), "term", "left").withColumn("w", weight)
    norms = terms.groupBy("id", "whole").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = terms.join(F.broadcast(weights), ["term", "whole"]).groupBy("id", "whole", "template").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    scored = dots.join(norms, ["id", "whole"]).join(F.broadcast(known), ["template", "whole"])
    scored = scored.withColumn("score", F.round(F.col("dot") / (F.col("norm") * F.col("length")), 6))
    scored = scored.where(F.col("score") >= F.when(F.col("whole"), LEAST_TEXT).otherwise(least)).join(own, ["id", "whole"])
    own_named = marks(F.when(F.col("whole"), _head(F.col("passage"))).otherwise(F.col("passage")))
    scored = scored.withColumns({"own_named": own_named, "own_clauses": _flags(F.col("passage"), _CLAUSES)})
    fits = F.when(F.col("whole"), (F.size(F.array_except("own_named", "allowed")) == 0) & (F.col("own_clauses") == F.col("clauses"))).otherwise(F.col("own_named") == F.col("named"))
    best = scored.where(fits).groupBy("id", "whole", "licence").agg(F.max("score").alias("score"))
    return found.join(best, ["id", "whole"]).groupBy(F.col("of").alias("id"), "licence", "whole").agg(F.max("score").alias("score"))
