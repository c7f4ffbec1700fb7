"""Connected components by alternating large-star and small-star (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.skew import ROWS_PER_SLICE, salted_join
from corpusloom.scratch import Scratch


def _to_smallest(
    pairs: DataFrame, reach: DataFrame, rows_per_slice: int
) -> DataFrame:
    """Link each ``v`` of ``pairs(u, v)`` to the smallest node seen from ``u`` in ``reach(u, v)``.

    The minimum is combined before the shuffle; a node with very many
    neighbours is split by its degree.
    """
    smallest = reach.groupBy("u").agg(
        F.least(F.col("u"), F.min("v")).alias("m"), F.count(F.lit(1)).alias("n")
    )
    linked = salted_join(
        pairs, smallest.select("u", "m"), ["u"], smallest, F.col("v"), rows_per_slice
    )
    return linked.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _large_star(edges: DataFrame, rows_per_slice: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _to_smallest(both.where(F.col("v") > F.col("u")), both, rows_per_slice).distinct()


def _small_star(edges: DataFrame, rows_per_slice: int) -> DataFrame:
    selves = edges.select("u", F.col("u").alias("v")).distinct()
    return _to_smallest(edges.unionByName(selves), edges, rows_per_slice).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("sum")
    ).first()
    return row["n"], row["sum"]


def connected_components(
    edges: DataFrame,
    scratch: Scratch,
    max_rounds: int | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """``(id, component)`` of every node of ``edges(src, dst)``; component = smallest id.

    Each round writes its edges to shared storage, so the lineage stays short
    and a lost executor costs one round. The number of rounds grows with
    the logarithm of the longest path; ``max_rounds``, if given, raises beyond it.
    """
    current = scratch.save(
        edges.where(F.col("src") != F.col("dst"))
        .select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
        .distinct(),
        "edges",
    )
    state = _state(current)
    before, rounds = None, 0
    while state != before:
        if rounds == max_rounds:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        rounds += 1
        # Salted joins read their input twice: write between the two halves.
        large = scratch.save(_large_star(current, rows_per_slice), "large")
        following = scratch.save(_small_star(large, rows_per_slice), "edges")
        scratch.drop(large)
        scratch.drop(current)
        current, before, state = following, state, _state(following)
    members = current.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return members.unionByName(roots)
