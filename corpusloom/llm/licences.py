"""Licence scans by canonical digest.

A text is normalised (case, punctuation, copyright lines, equivalent spellings)
and its digest looked up among those of known licences. Units are the whole text
and each of its lines, so that a notice of one line inside a text is found too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import ascii_lower, fresh
from corpusloom.operators.skew import salted_join
from corpusloom.scratch import Scratch

# Published notices and licence texts.
KNOWN = {
    "all-rights-reserved": ["All rights reserved."],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "cc-by-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0."],
    "gpl-3.0": ["This work is licensed under the GNU General Public License, version 3."],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
        "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
        "THE SOFTWARE.",
    ],
}
# What licences are called.
NAMES = {
    "agpl-3.0": ["GNU Affero General Public License, version 3", "GNU AGPL v3"],
    "apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"],
    "bsd-2-clause": ["BSD 2-Clause License", "2-clause BSD License", "Simplified BSD License"],
    "bsd-3-clause": ["BSD 3-Clause License", "3-clause BSD License", "New BSD License"],
    "cc-by-4.0": ["Creative Commons Attribution 4.0 International License", "CC BY 4.0"],
    "cc-by-nc-4.0": ["Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 4.0"],
    "cc-by-sa-4.0": ["Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 4.0"],
    "cc0-1.0": ["CC0 1.0 Universal", "CC0 1.0"],
    "gpl-2.0": ["GNU General Public License, version 2", "GNU GPL v2", "GNU General Public License v2.0"],
    "gpl-3.0": ["GNU General Public License, version 3", "GNU GPL v3", "GNU General Public License v3.0"],
    "isc": ["ISC License"],
    "lgpl-3.0": ["GNU Lesser General Public License, version 3", "GNU LGPL v3"],
    "mit": ["MIT License", "Expat License"],
    "mpl-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0"],
}
# How a notice names its licence.
FORMS = [
    f"{whole}{verb} under {article}{{}}"
    for whole in ("", "This work is ", "This project is ", "This software is ", "This file is ")
    for verb in ("licensed", "released", "distributed")
    for article in ("", "the ", "a ")
] + ["SPDX-License-Identifier: {}"]
# Spellings that mean the same, after case is folded: pattern, replacement.
SPELLINGS = (
    (r"licence", "license"),
    (r"sub-licens", "sublicens"),
    (r"non-commercial", "noncommercial"),
    (r"organis(ation|e)", r"organiz$1"),
    (r"favour", "favor"),
    (r"merchantibility", "merchantability"),
    (r"https://", "http://"),
)
COPYRIGHT_LINE = r"(?m)^[ \t#*/;%-]*(copyright\b|\(c\)|©)[^\n]*(19|20)[0-9][0-9][^\n]*$"
PUNCTUATION = r"[^0-9a-z\x{80}-\x{10FFFF}]+"


def canonical(text: Column) -> Column:
    """Small letters, no copyright lines, one spelling, words parted by one space."""
    out = F.regexp_replace(ascii_lower(text), COPYRIGHT_LINE, " ")
    for pattern, replacement in SPELLINGS:
        out = F.regexp_replace(out, pattern, replacement)
    return F.trim(F.regexp_replace(out, PUNCTUATION, " "))


def notices() -> dict[str, list[str]]:
    """Whole texts and notices that are known without a register, notices from names and forms."""
    out = {name: list(texts) for name, texts in KNOWN.items()}
    for licence, names in NAMES.items():
        out.setdefault(licence, []).extend(form.format(name) for form in FORMS for name in [*names, licence])
    return out


def read_register(spark: SparkSession, folder: str) -> DataFrame:
    """``(license, text)`` of a folder of whole licence texts, a file each, named by the licence."""
    files = spark.read.text(folder, wholetext=True).select("value", F.col("_metadata.file_name").alias("file"))
    return files.select(F.lower(F.regexp_replace("file", r"\.(txt|md)$", "")).alias("license"), F.col("value").alias("text"))


def known_digests(
    spark: SparkSession, known: dict[str, list[str]] | None = None, register: DataFrame | None = None
) -> DataFrame:
    """``(license, digest, n)`` of known texts and their canonical lengths.

    ``register`` is a table of ``(license, text)``, as of ``read_register``, of any size.
    """
    rows = [(name, t) for name, texts in (notices() if known is None else known).items() for t in texts]
    table = spark.createDataFrame(rows, "license string, text string")
    if register is not None:
        table = table.unionByName(register.select("license", "text"))
    form = table.select("license", canonical(F.col("text")).alias("c")).where("c != ''")
    found = form.select("license", F.sha2("c", 256).alias("digest"), F.length("c").alias("n"))
    # Of licences with one text the first by name.
    return found.groupBy("digest", "n").agg(F.min("license").alias("license"))


def scan(
    docs: DataFrame,
    known: DataFrame,
    scratch: Scratch,
    text_col: str = "text",
    into: str = "found",
    rows_per_slice: int = 100_000,
) -> DataFrame:
    """``docs`` with ``into``: an array of ``(line, license)``; line 0 is the whole text.

    Lines count from 1 where a text has two or more. Null and empty texts, and
    texts without words, have no licence; texts may have any length and any number of lines. Units whose
    canonical length no known text has go at once; the digests of the others are joined with ``known``. Texts
    meet their findings by digest, and a text with very many copies is split. ``into`` replaces a
    column of that name.
    """
    key, hit = fresh(docs, "_key", "_hit")
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.split(text, "\n")
    every = F.when(F.size(lines) > 1, F.concat(F.array(text), lines)).otherwise(F.array(text))
    keyed = docs.withColumn(key, F.unhex(F.md5(text)))
    units = keyed.select(F.col(key).alias("key"), F.posexplode(every).alias("line", "unit"))
    # As many lengths as known texts at most, and Spark sends them to all executors only where that is little.
    known = scratch.save(known, "known")
    lengths = known.select("n").distinct()
    shortest = known.agg(F.coalesce(F.min("n"), F.lit(1))).scalar()
    # No rule makes a text longer, so short units needn't be rewritten.
    formed = units.where(F.length("unit") >= shortest).select("key", "line", canonical(F.col("unit")).alias("c"))
    likely = formed.withColumn("n", F.length("c")).join(lengths, "n", "left_semi")
    digests = likely.select("key", "line", F.sha2("c", 256).alias("digest"))
    hits = scratch.save(
        digests.join(known.select("digest", "license"), "digest").groupBy("key")
        .agg(F.array_sort(F.collect_set(F.struct("line", "license"))).alias("hit")),
        "hits",
    )
    sizes = keyed.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows_per_slice)
    spread = F.xxhash64(F.lit(0), *[F.col(c) for c in docs.columns if c != text_col])
    met = salted_join(
        keyed, hits.select(F.col("key").alias(key), F.col("hit").alias(hit)), [key], sizes, spread, rows_per_slice, "left"
    )
    none = F.array().cast("array<struct<line:int,license:string>>")
    return met.withColumn(into, F.coalesce(F.col(hit), none)).drop(key, hit)
