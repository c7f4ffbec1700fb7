"""Near-duplicates: MinHash signatures, LSH bands, candidate edges, groups."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import minhash
from corpusloom.operators.components import connected_components
from corpusloom.operators.exact import remove_duplicates
from corpusloom.operators.skew import ROWS_PER_SLICE, salted_join
from corpusloom.scratch import Scratch


@dataclass(frozen=True)
class FuzzyConfig:
    """Field names are those of the YAML file.

    ``buckets_per_shuffle`` bands are grouped at a time: fewer take less room on disk
    at once and more passes. Results are the same.
    """

    seed: int = 42
    char_ngrams: int = 5
    num_buckets: int = 20
    hashes_per_bucket: int = 13
    use_64_bit_hash: bool = False
    buckets_per_shuffle: int = 20
    false_positive_check: bool = False
    num_anchors: int = 2
    jaccard_threshold: float = 0.8


def minhash_signatures(
    df: DataFrame, config: FuzzyConfig, id_col: str = "id", text_field: str = "text"
) -> DataFrame:
    """``(id, signature)``; texts shorter than one shingle have no row."""
    return df.select(
        id_col,
        minhash.signature(
            F.col(text_field),
            hashes=config.num_buckets * config.hashes_per_bucket,
            width=config.char_ngrams,
            seed=config.seed,
            wide=config.use_64_bit_hash,
        ).alias("signature"),
    ).where(F.col("signature").isNotNull())


def lsh_bands(
    df: DataFrame, config: FuzzyConfig, id_col: str = "id", text_field: str = "text"
) -> DataFrame:
    """``(id, band, bucket)``, ``num_buckets`` rows per document."""
    signatures = minhash_signatures(df, config, id_col, text_field)
    keys = minhash.bands(F.col("signature"), config.num_buckets, config.hashes_per_bucket)
    return signatures.select(id_col, F.posexplode(keys).alias("band", "bucket"))


def candidate_edges(
    df: DataFrame,
    config: FuzzyConfig,
    scratch: Scratch,
    id_col: str = "id",
    text_field: str = "text",
    rows_per_slice: int = ROWS_PER_SLICE,
    without: DataFrame | None = None,
) -> DataFrame:
    """``(src, dst)``: each member of a bucket linked to the bucket's anchors.

    Documents whose id is listed in ``without`` leave the bands, so that no texts are joined for it.

    One anchor, the smallest id, gives the same components as all pairs of the
    bucket at a cost linear in its size. With the false-positive check on,
    there are ``num_anchors``, and edges below the Jaccard threshold go.
    """
    rows = lsh_bands(df, config, id_col, text_field)
    rows = scratch.save(rows if without is None else rows.join(without, id_col, "left_anti"), "bands")
    if config.buckets_per_shuffle < 1:
        raise ValueError("buckets_per_shuffle must be at least 1")
    edges = None
    for first in range(0, config.num_buckets, config.buckets_per_shuffle):
        some = rows
        if config.buckets_per_shuffle < config.num_buckets:
            some = rows.where(F.col("band").between(first, first + config.buckets_per_shuffle - 1))
        for linked in _bucket_edges(some, config, scratch, id_col, rows_per_slice):
            edges = linked if edges is None else edges.unionByName(linked)
    edges = edges.select("src", "dst").distinct()
    if config.false_positive_check:
        edges = verified_edges(edges, df, config, scratch, id_col, text_field, rows_per_slice)
    return edges


def _bucket_edges(
    rows: DataFrame, config: FuzzyConfig, scratch: Scratch, id_col: str, rows_per_slice: int
) -> list[DataFrame]:
    """The links of ``(id, band, bucket)`` rows to the anchors of their buckets, one table per anchor."""
    key = ["band", "bucket"]
    buckets = (
        rows.groupBy(*key)
        .agg(F.min(id_col).alias("src"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )
    # Saved at each step: few buckets have two members, and Spark joins a table
    # it knows to be small without shuffling the bands again.
    edges = []
    for _ in range(config.num_anchors if config.false_positive_check else 1):
        buckets = scratch.save(buckets, "buckets")
        later = salted_join(
            rows, buckets.select(*key, "src"), key, buckets, F.col(id_col), rows_per_slice
        ).where(F.col(id_col) > F.col("src"))
        later = scratch.save(later.select(*key, "src", F.col(id_col).alias("dst")), "linked")
        edges.append(later)
        # The next anchor of a bucket is its smallest id above the last one.
        buckets = (
            later.groupBy(*key)
            .agg(F.min("dst").alias("src"), F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1)
        )
    return edges


def edge_overlap(
    edges: DataFrame,
    df: DataFrame,
    config: FuzzyConfig,
    scratch: Scratch,
    id_col: str = "id",
    text_field: str = "text",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """``(src, dst, shared, total)``: intersection and union size of the shingle sets."""
    edges = scratch.save(edges, "pairs")
    nodes = edges.select(F.col("src").alias(id_col)).union(edges.select("dst")).distinct()
    sets = scratch.save(
        minhash.shingle_sets(df.join(nodes, id_col, "left_semi"), id_col, text_field, config.char_ngrams),
        "shingles",
    )
    # A document is `dst` of a bounded number of edges, but may be the anchor of very many.
    with_dst = edges.join(sets.select(F.col(id_col).alias("dst"), F.col("set").alias("b")), "dst")
    degrees = edges.groupBy("src").agg(F.count(F.lit(1)).alias("n"))
    both = salted_join(
        with_dst,
        sets.select(F.col(id_col).alias("src"), F.col("set").alias("a")),
        ["src"],
        degrees,
        F.col("dst"),
        rows_per_slice,
    )
    shared = F.size(F.array_intersect("a", "b")).cast("bigint")
    return both.select("src", "dst", shared.alias("shared"), (F.size("a") + F.size("b")).alias("_both")).select(
        "src", "dst", "shared", (F.col("_both") - F.col("shared")).alias("total")
    )


def verified_edges(
    edges: DataFrame,
    df: DataFrame,
    config: FuzzyConfig,
    scratch: Scratch,
    id_col: str = "id",
    text_field: str = "text",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """The edges whose exact Jaccard similarity reaches the threshold."""
    per_mille = round(config.jaccard_threshold * 1000)
    overlap = edge_overlap(edges, df, config, scratch, id_col, text_field, rows_per_slice)
    return overlap.where(F.col("shared") * 1000 >= F.col("total") * per_mille).select("src", "dst")


def duplicate_groups(
    df: DataFrame,
    config: FuzzyConfig,
    scratch: Scratch,
    id_col: str = "id",
    text_field: str = "text",
    without: DataFrame | None = None,
) -> DataFrame:
    """``(id, group_id)`` of every document in a group of near-duplicates, but those in ``without``."""
    # Bands and buckets go once the components are written.
    own = Scratch(scratch.spark)
    edges = candidate_edges(df, config, own, id_col, text_field, without=without)
    groups = connected_components(edges, scratch)
    own.close()
    return groups.select(F.col("id").alias(id_col), F.col("component").alias("group_id"))


def fuzzy_dedup(
    df: DataFrame,
    config: FuzzyConfig,
    scratch: Scratch,
    id_col: str = "id",
    text_field: str = "text",
) -> DataFrame:
    """Keep the smallest id of each group, and every document outside the groups."""
    groups = duplicate_groups(df, config, scratch, id_col, text_field)
    return remove_duplicates(df, groups.where(F.col(id_col) != F.col("group_id")), scratch, id_col)
