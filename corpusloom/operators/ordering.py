"""Global order without a global window: range partitions plus offsets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.scratch import Scratch

_ROW_BITS = 33


def ordinals(
    df: DataFrame, scratch: Scratch, order_by: Sequence[str] = (), name: str = "ordinal"
) -> DataFrame:
    """Number the rows 0, 1, 2, ... in ``order_by`` order, or in storage order.

    Rows are numbered inside their partition and shifted by the size of the
    partitions before it. The table of offsets has one row per partition.
    """
    placed = df
    if order_by:
        placed = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    # Written once: partition numbers must not change between the two passes.
    placed = scratch.save(placed.withColumn("_place", F.monotonically_increasing_id()), name)
    placed = placed.withColumn("_part", F.shiftright("_place", _ROW_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    row = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + row)
        .drop("_part", "_place", "_offset")
    )


def running_sum(
    df: DataFrame,
    value: str,
    order_by: Sequence[str],
    scratch: Scratch,
    group_by: Sequence[str] = (),
    name: str = "running",
) -> DataFrame:
    """Inclusive running sum of ``value`` per group, in ``order_by`` order.

    ``group_by`` + ``order_by`` must be a total order. Rows are range
    partitioned on both, so a group with a third of all rows spreads over a
    third of the partitions: each sums its own part, and a table with one row
    per (group, partition) carries the sums of the parts before it.
    """
    group_by, order_by = list(group_by), list(order_by)
    keys = [*group_by, *order_by]
    placed = scratch.save(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id()),
        name,
    )
    before = Window.partitionBy(*group_by).orderBy("_part")
    offsets = (
        placed.groupBy(*group_by, "_part")
        .agg(F.sum(value).alias("_sum"))
        .select(
            *[F.col(g).alias(f"_{g}") for g in group_by],
            F.col("_part").alias("_offset_part"),
            F.coalesce(
                F.sum("_sum").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("_offset"),
        )
    )
    within = Window.partitionBy(*group_by, "_part").orderBy(*order_by)
    local = placed.withColumn(
        "_local", F.sum(value).over(within.rowsBetween(Window.unboundedPreceding, 0))
    )
    match = reduce(
        lambda c, g: c & F.col(g).eqNullSafe(F.col(f"_{g}")),
        group_by,
        F.col("_part") == F.col("_offset_part"),
    )
    return (
        local.join(offsets, match)
        .withColumn(name, F.col("_offset") + F.col("_local"))
        .select(*df.columns, name)
    )
