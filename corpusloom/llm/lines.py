"""Site-relative line deduplication.

For each host, the share of its pages that contain a line is set against a
boilerplate ratio; lines above it are dropped from all pages of the host. Lines
are counted by digest and combined before the shuffle, so neither a hot host nor
a hot line is gathered. Texts meet the positions to drop by host and digest of
the text; a text with very many copies is split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import fresh, let
from corpusloom.operators.skew import salted_join
from corpusloom.scratch import Scratch

RATIO_PERCENT = 10
LEAST_PAGES = 3
ROWS_PER_SLICE = 100_000


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text))


def boilerplate_lines(
    docs: DataFrame, host_col: str, text_col: str, ratio_percent: int, least_pages: int
) -> DataFrame:
    """``(site, line)``: digests of the lines in more than the given share of a site's pages."""
    site = F.coalesce(F.col(host_col).cast("string"), F.lit(""))
    totals = docs.groupBy(site.alias("site")).agg(F.count(F.lit(1)).alias("pages"))
    stripped = F.transform(F.split(text_col, "\n"), lambda x: F.trim(F.translate(x, "\t\x0b\x0c\r", "    ")))
    rows = docs.select(site.alias("site"), F.explode(F.array_distinct(F.array_remove(stripped, ""))).alias("t"))
    counts = rows.groupBy("site", _digest(F.col("t")).alias("line")).agg(F.count(F.lit(1)).alias("n"))
    return (
        counts.where(F.col("n") >= least_pages)
        .join(totals, "site")
        .where(100 * F.col("n") > ratio_percent * F.col("pages"))
        .select("site", "line", "n")
    )


def drop_site_lines(
    docs: DataFrame,
    scratch: Scratch,
    host_col: str = "source",
    text_col: str = "text",
    ratio_percent: int = RATIO_PERCENT,
    least_pages: int = LEAST_PAGES,
    rows_per_slice: int = ROWS_PER_SLICE,
    lines: str = "n_lines",
    dropped: str = "n_dropped",
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of the text, and two counts.

    Lines are compared without the blanks around them and counted once per page;
    empty lines are never dropped. Null texts stay null and have no lines; a null
    host is the same site as an empty one. A text may have any number of lines. The counts replace columns of those
    names; other columns stay.
    """
    site, key, at, places = fresh(docs, "_site", "_key", "_at", "_places")
    found = scratch.save(boilerplate_lines(docs, host_col, text_col, ratio_percent, least_pages), "lines")
    keyed = docs.withColumn(site, F.coalesce(F.col(host_col).cast("string"), F.lit(""))).withColumn(
        key, _digest(F.coalesce(text_col, F.lit("")))
    )
    rows = keyed.where(F.col(text_col).isNotNull()).select(
        F.col(site).alias("site"), F.col(key).alias("key"), F.posexplode(F.split(text_col, "\n")).alias("at", "t")
    )
    stripped = F.trim(F.translate(F.col("t"), "\t\x0b\x0c\r", "    "))
    rows = rows.where(stripped != "").select("site", "key", "at", _digest(stripped).alias("line"))
    hits = salted_join(rows, found.select("site", "line"), ["site", "line"], found, F.col("key"), rows_per_slice)
    # A text has as many rows as copies, which are counted to split hot ones.
    hits = hits.groupBy("site", "key").agg(F.collect_set("at").alias("places"))
    hits = scratch.save(hits, "hits")
    sizes = (
        keyed.groupBy(F.col(site), F.col(key)).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows_per_slice)
    )
    small = hits.select(F.col("site").alias(site), F.col("key").alias(key), F.col("places").alias(places))
    spread = F.xxhash64(*[F.col(c) for c in docs.columns if c != text_col])
    met = salted_join(keyed, small, [site, key], sizes, spread, rows_per_slice, "left")
    # What stays is a difference of sets of places, so the work is linear in the lines.
    lines_of = F.split(text_col, "\n")
    kept = let(
        lines_of,
        lambda ls: F.transform(
            F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col(places)), lambda i: F.get(ls, i)
        ),
    )
    text = F.when(F.col(places).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    total = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(F.split(text_col, "\n"))).cast("bigint")
    gone = F.coalesce(F.size(places), F.lit(0))
    gone = F.when(gone < 0, 0).otherwise(gone).cast("bigint")
    out = met.withColumn(lines, total).withColumn(dropped, gone)
    return out.withColumn(text_col, text).drop(site, key, places)
