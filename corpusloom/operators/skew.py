"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_SLICE = 1_000_000


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    sizes: DataFrame,
    spread_by: Column,
    rows_per_slice: int = ROWS_PER_SLICE,
    how: str = "inner",
    strategy: str | None = None,
) -> DataFrame:
    """Inner (or left) join of ``big`` and ``small`` on ``on``.

    ``sizes`` gives the rows of ``big`` per key as column ``n``. Every key with
    more than ``rows_per_slice`` rows is cut in slices by a hash of
    ``spread_by`` (a hash and not ``rand``, so that a re-run task sends its
    rows to the same place), and its ``small`` rows are repeated once per
    slice. The table of such keys is joined without a hint: it has at most
    rows / rows_per_slice rows, and Spark sends it to all executors only where
    its measured size is below the broadcast threshold. ``strategy`` is a join hint
    for where the plan should be the same at any size.
    """
    on = list(on)
    hot = sizes.where(F.col("n") > rows_per_slice).select(
        *on, F.ceil(F.col("n") / rows_per_slice).cast("int").alias("_slices")
    )
    slices = F.coalesce("_slices", F.lit(1))
    left = (
        big.join(hot, on, "left")
        .withColumn("_slice", F.pmod(F.xxhash64(spread_by), slices).cast("int"))
        .drop("_slices")
    )
    right = (
        small.join(hot, on, "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), slices - 1)))
        .drop("_slices")
    )
    right = right.hint(strategy) if strategy else right
    return left.join(right, [*on, "_slice"], how).drop("_slice")
