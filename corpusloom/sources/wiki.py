"""Documents from Wikipedia XML dumps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.markup import wiki_text

#: Lines at the beginning of a dump in which its namespaces are named.
HEAD_LINES = 200
PAGE_SCHEMA = (
    "title string, ns int, id bigint, redirect struct<_title: string>, "
    "revision struct<text: struct<_VALUE: string>>"
)


def dump_paths(spark: SparkSession, pattern: str, url_limit: int | None = None) -> list[str]:
    """Dump files matching a glob, in name order, at most ``url_limit`` of them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = sorted(status.getPath().toString() for status in fs.globStatus(path) or [])
    return found[:url_limit]


def local_namespaces(spark: SparkSession, path: str) -> list[str]:
    """What a dump's own language calls files and categories, from the head of the file.

    The list stands in the first lines, before all pages; a file without one adds no names.
    """
    head = spark.read.text(path).limit(HEAD_LINES)
    pattern = r'<namespace key="(?:6|14)"[^>]*>([^<]+)</namespace>'
    found = head.select(F.regexp_extract("value", pattern, 1).alias("name"))
    return [r["name"] for r in found.where("name != ''").collect()]


def read_dump(
    spark: SparkSession, pattern: str, language: str, url_limit: int | None = None
) -> DataFrame:
    """``(id, title, url, language, text, file_name)`` of the articles of a dump."""
    paths = dump_paths(spark, pattern, url_limit)
    if not paths:
        raise FileNotFoundError(pattern)
    namespaces = local_namespaces(spark, paths[0])
    pages = spark.read.format("xml").option("rowTag", "page").schema(PAGE_SCHEMA).load(paths)
    pages = pages.select("*", F.col("_metadata.file_name").alias("file_name"))
    return articles(pages, language, namespaces).where(F.col("text") != "")


def articles(pages: DataFrame, language: str, namespaces: Sequence[str] = ()) -> DataFrame:
    """Plain text of the pages in the article namespace that are not redirects."""
    kept = pages.where((F.col("ns") == 0) & F.col("redirect").isNull())
    return kept.select(
        F.col("id").cast("string").alias("id"),
        "title",
        _url(F.col("title"), language).alias("url"),
        F.lit(language).alias("language"),
        wiki_text(F.col("revision.text._VALUE"), namespaces).alias("text"),
        "file_name",
    )


def _url(title: Column, language: str) -> Column:
    name = F.url_encode(F.replace(title, F.lit(" "), F.lit("_")))
    return F.concat(F.lit(f"https://{language}.wikipedia.org/wiki/"), name)
