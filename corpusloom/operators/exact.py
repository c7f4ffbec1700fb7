"""Exact duplicates by content digest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import digest
from corpusloom.operators.skew import ROWS_PER_SLICE, salted_join
from corpusloom.scratch import Scratch


def exact_duplicates(
    df: DataFrame,
    scratch: Scratch,
    id_col: str = "id",
    text_field: str = "text",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """``(id, group_id, copies)`` of every document that repeats an earlier one.

    ``group_id`` is the smallest id with that text. The texts are scanned once
    for their digests; grouping and joining move only ids and 16-byte digests,
    and the digest of a text copied over and over is split by ``salted_join``.
    """
    digests = scratch.save(
        df.where(F.col(text_field).isNotNull()).select(id_col, digest(F.col(text_field)).alias("_digest")),
        "digests",
    )
    # Saved, since only texts with copies are left: Spark then knows the size
    # and joins a small table without shuffling the digests again.
    groups = scratch.save(
        digests.groupBy("_digest")
        .agg(F.min(id_col).alias("group_id"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1),
        "groups",
    )
    members = salted_join(
        digests, groups, ["_digest"], groups, F.col(id_col), rows_per_slice
    )
    return members.where(F.col(id_col) != F.col("group_id")).select(
        id_col, "group_id", F.col("n").alias("copies")
    )


def remove_duplicates(
    df: DataFrame, duplicates: DataFrame, scratch: Scratch, id_col: str = "id"
) -> DataFrame:
    """The documents whose id is not listed in ``duplicates``.

    The list is written, so Spark knows its bytes: below the broadcast threshold
    the texts stay where they are, beyond it both sides are joined by id.
    """
    listed = scratch.save(duplicates.select(id_col), "duplicates")
    return df.join(listed, id_col, "left_anti")


def exact_dedup(
    df: DataFrame, scratch: Scratch, id_col: str = "id", text_field: str = "text"
) -> DataFrame:
    """Keep the document with the smallest id of each group of equal texts."""
    duplicates = exact_duplicates(df, scratch, id_col, text_field)
    return remove_duplicates(df, duplicates, scratch, id_col)
