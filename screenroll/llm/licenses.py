"""License scan: TF-IDF cosine of lines and word windows to license templates, then inheritance by path.

Every text gives its license candidates: the lines that share a telling term with a template,
weighted by TF-IDF (term counts in the line; document frequencies of the template terms over all
texts; other terms count as distinct and rare) and compared by cosine. Where no line reaches
``THRESHOLD``, so are the windows of up to twice a template's length around every telling term, across line
breaks: a notice within a long line or wrapped over lines counts as one alone. The best template at or above ``THRESHOLD`` is the file's own
license. License files (by name) hand their license down: a file without a license of its own
takes that of the nearest ancestor directory with one, found by one equi-join of all ancestor
paths with the licensed directories.

Only DataFrame functions run on this path. Texts are read twice in narrow passes (term counts,
then scores); what is shuffled are term counts, paths and names.

Defined results: NULL and empty texts have no license of their own but inherit one; rows with a
NULL path have only their own; a directory with license files of several licenses hands down the
first by name; equal rows give equal results; an empty table gives an empty result; the result
columns replace columns of the same name.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let as _let
from .common import small_or_plain, stage

# Names of licenses and the wording of their headers and notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3 or later."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
THRESHOLD = 0.5
LICENSE_FILES = ("license", "licence", "copying", "notice")
_SPLIT = "[^a-z0-9]+"


def _terms(text: str) -> list[str]:
    """Terms of a template, by the same rule as ``_tokens``."""
    return [t for t in re.split(_SPLIT, text.lower()) if t]


VOCABULARY = sorted({t for _, text in TEMPLATES for t in _terms(text)})


def _tokens(line: Column) -> Column:
    """Lower-case terms of a line: runs of letters and digits."""
    return F.split(F.lower(line), _SPLIT)


def document_frequencies(df: DataFrame, text: str = "text") -> tuple[int, dict[str, int]]:
    """Number of rows, and in how many each template term occurs; one row per term reaches the driver."""
    known = F.array(*[F.lit(t) for t in VOCABULARY])
    found = df.select(F.explode(F.array_append(F.array_intersect(_tokens(F.coalesce(text, F.lit(""))), known), F.lit(""))).alias("term"))
    counts = {r["term"]: r["n"] for r in found.groupBy("term").agg(F.count("*").alias("n")).collect()}
    return counts.pop("", 0), counts


def weights(rows: int, frequency: dict[str, int]) -> dict[str, float]:
    """Inverse document frequencies of the template terms, in steps of 1/1024 so that all engines agree."""
    return {t: round(1024 * (1 + math.log((1 + rows) / (1 + frequency.get(t, 0))))) / 1024 for t in VOCABULARY}


def own_license(df: DataFrame, idf: dict[str, float], text: str = "text") -> DataFrame:
    """``df`` with ``own_license`` and ``own_score`` (NULL and 0 without one)."""
    unknown = max(idf.values())
    known = F.array(*[F.lit(t) for t in VOCABULARY])
    numbers = lambda values: F.array(*[F.lit(float(v)) for v in values])
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda a, v: a + v)
    # A line below the threshold without these terms stays below it: the others are too light.
    anchors = _anchors(idf)
    telling = "|".join(anchors)
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.lower(x).rlike(telling))

    def compared(counts: Column, others: Column) -> Column:
        square = dot(counts, F.zip_with(counts, numbers(idf[t] ** 2 for t in VOCABULARY), lambda n, w: n * w))
        norm = F.sqrt(square + others * F.lit(unknown ** 2))
        choices = []
        for name, template in TEMPLATES:
            terms = _terms(template)
            length = math.sqrt(sum((terms.count(t) * idf[t]) ** 2 for t in set(terms)))
            inner = dot(counts, numbers(terms.count(t) * idf[t] ** 2 / length for t in VOCABULARY))
            choices.append(F.struct((inner / F.greatest(norm, F.lit(1e-9))).alias("score"), F.lit(name).alias("name")))
        return F.array_max(F.array(*choices))

    def scored(tokens: Column) -> Column:
        return _let(
            F.transform(known, lambda t: F.size(F.filter(tokens, lambda x: x == t)).cast("double")),
            lambda counts: compared(counts, F.size(tokens) - F.aggregate(counts, F.lit(0.0), lambda a, v: a + v)))

    terms_of = lambda x: F.filter(_tokens(x), lambda t: t != "")
    none = F.struct(F.lit(0.0).alias("score"), F.lit("").alias("name"))
    places = F.array(*[F.struct(F.lit(t).alias("term"), F.lit(back).alias("back"), F.lit(width).alias("width"))
                       for t, back, width in _windows(anchors)])

    def around(tokens: Column, at: Column) -> Column:
        # The windows in which a telling term stands as it does in a template.
        first = lambda w: at["place"] - w["back"]
        return F.array_max(F.transform(F.filter(places, lambda w: w["term"] == at["term"]), lambda w: scored(F.slice(
            tokens, F.greatest(first(w), F.lit(0)) + 1, w["width"] + F.least(first(w), F.lit(0))))))

    def searched(tokens: Column) -> Column:
        marked = F.transform(tokens, lambda t, i: F.when(t.isin(*anchors), F.struct(t.alias("term"), i.alias("place"))))
        return F.aggregate(F.filter(marked, lambda m: m.isNotNull()), none, lambda best, m: F.greatest(best, around(tokens, m)))

    rows = df.withColumn("_best", F.coalesce(F.array_max(F.transform(lines, lambda x: _let(terms_of(x), scored))), none))
    # A notice that stands on a line of its own has the score of that line.
    open_ = (F.col("_best.score") < THRESHOLD) & F.lower(text).rlike(f"(?<![a-z0-9])(?:{telling})(?![a-z0-9])")
    rows = rows.withColumn("_best", F.when(open_, F.greatest("_best", _let(terms_of(F.col(text)), searched))).otherwise(F.col("_best")))
    good = F.col("_best.score") >= THRESHOLD
    return rows.withColumn("own_license", F.when(good, F.col("_best.name"))).withColumn(
        "own_score", F.when(good, F.col("_best.score")).otherwise(0.0)).drop("_best")


def _anchors(idf: dict[str, float]) -> list[str]:
    """Terms of which every line at the threshold has one.

    Per template the lightest terms are left out as long as all of them together keep the cosine
    below the threshold.
    """
    out = set()
    for _, template in TEMPLATES:
        terms = _terms(template)
        values = sorted(((terms.count(t) * idf[t], t) for t in set(terms)))
        whole, light = sum(v * v for v, _ in values), 0.0
        for v, t in values:
            light += v * v
            if math.sqrt(light / whole) >= THRESHOLD:
                out.add(t)
    return sorted(out)


def _windows(anchors: list[str]) -> list[tuple[str, int, int]]:
    """Per anchor and place in a template: words before it and length of windows of 1, 1.5 and 2 templates."""
    out = set()
    for _, template in TEMPLATES:
        terms = _terms(template)
        for place, term in enumerate(terms):
            if term in anchors:
                out |= {(term, place + more // 2, len(terms) + more) for more in (0, len(terms) // 2, len(terms))}
    return sorted(out)


def _parent(path: Column) -> Column:
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise("")


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", path: str = "path") -> DataFrame:
    """Per row: key, path, own_license, own_score, license and the directory it comes from.

    ``license`` is the own license, else that of the nearest ancestor directory with a license file.
    """
    rows = df.select(key, F.col(path).alias("path"), F.col(text).alias("text"))
    idf = weights(*document_frequencies(rows))
    own = stage(own_license(rows, idf).drop("text"), "license-own")
    name = F.lower(F.regexp_extract("path", "([^/]*)$", 1))
    is_file = F.regexp_extract(name, "^([a-z]+)", 1).isin(*LICENSE_FILES)
    given = stage(
        own.where(is_file & F.col("own_license").isNotNull()).select(_parent(F.col("path")).alias("directory"), "own_license")
        .groupBy("directory").agg(F.min("own_license").alias("given")), "license-given")
    parts = F.split(_parent(F.col("path")), "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.struct(
        i.alias("depth"), F.array_join(F.slice(parts, F.lit(1), i), "/").alias("directory")))
    # Files of a directory share their ancestors: the join runs over directories, not files.
    directories = own.where("own_license is null and path is not null").select(_parent(F.col("path")).alias("home")).distinct()
    steps = directories.withColumn("path", F.concat("home", F.lit("/x"))).select("home", F.inline(ancestors))
    nearest = steps.join(small_or_plain(given, given.count(), 120), "directory").groupBy("home").agg(
        F.max(F.struct("depth", "directory", "given")).alias("n")).select("home", "n.directory", "n.given")
    inherited = own.withColumn("home", F.when(F.col("own_license").isNull(), _parent(F.col("path")))).join(nearest, "home", "left")
    return inherited.select(
        key, "path", "own_license", "own_score", F.coalesce("own_license", "given").alias("license"),
        F.when(F.col("own_license").isNull(), F.col("directory")).alias("inherited_from"))


def with_paths(documents: DataFrame) -> DataFrame:
    """Documents as files: a source tree per source, every eighth file a LICENSE of its directory."""
    n = F.col("doc_id")
    folder = F.concat_ws("/", F.col("source"), F.expr("doc_id div 4000").cast("string"), F.expr("doc_id div 400 % 10").cast("string"))
    return documents.withColumn("path", F.when(n % 8 == 0, F.concat(folder, F.lit("/LICENSE"), n.cast("string"), F.lit(".txt"))).otherwise(
        F.concat(folder, F.lit("/src/"), n.cast("string"), F.lit(".txt"))))


def report(documents: DataFrame) -> DataFrame:
    """The scan of ``documents`` laid out as files; scores to six digits."""
    return scan(with_paths(documents)).withColumn("own_score", F.round("own_score", 6))
