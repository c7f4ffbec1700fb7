"""Helpers that several of the operators share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpusloom.scratch import Scratch

#: White space between words: `[\x20\x09-\x0D]+`.
BLANKS = r"[\x20\x09-\x0D]+"
KEY_CHARS = 16
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` doesn't have yet, so that no input column is hidden."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """Runs of other than blank characters; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def joined(values: Sequence[str]) -> str:
    return ",".join(values)


class WordHashes(dict):
    """64-bit hashes of words (bytes), remembered up to a fixed number of words."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def positioned(
    df: DataFrame,
    scratch: Scratch,
    group: str,
    order_by: Sequence[str],
    keep: Sequence[str] | None = None,
    dealt: int | None = None,
) -> DataFrame:
    """The ``keep`` columns with each row's place ``pos`` in its group, from 0, and the group's ``size``.

    Rows are dealt by ranges of ``group`` and ``order_by``, so a group with a third
    of all rows spreads over a third of the tasks. Each numbers its own stretch; a
    table with one row per stretch carries the counts of the stretches before it.
    Nulls sort first. Rows equal in all these columns may take each other's places.
    ``keep`` (all, if not given) has ``group``; what only orders isn't written.

    Spark samples the keys that deal rows on the driver, so these are short: the
    first ``dealt`` columns of ``order_by``, the last of them, if it is text, by its
    first characters, which sort as the whole does.
    """
    keys, keep = [group, *order_by], list(keep or df.columns)
    last = keys[: 1 + (dealt or len(order_by))][-1]
    short = F.substring(last, 1, KEY_CHARS) if isinstance(df.schema[last].dataType, StringType) else F.col(last)
    ranges = [*keys[: keys.index(last)], short]
    placed = df.repartitionByRange(*ranges).sortWithinPartitions(*keys)
    placed = placed.select(*keep, F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_place"))
    placed = scratch.save(placed, "positioned")
    stretches = placed.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_stretch")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first")
    )
    whole = Window.partitionBy("_group")
    before = whole.orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    stretches = stretches.select(
        "_group",
        "_stretch",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(whole).alias("size"),
    )
    met = placed.join(stretches, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_stretch")))
    return met.withColumn("pos", F.col("_place") + F.col("_shift")).select(*keep, "pos", "size")


def running(
    df: DataFrame,
    scratch: Scratch,
    group: str,
    order: str,
    values: dict[str, str],
    combine: Callable[[str], Column],
    join: Callable[[Column, Column], Column],
) -> DataFrame:
    """``df`` with each value combined over the rows before it in its group, by ``order``.

    ``values`` names the new column of each; 0 where nothing comes before. ``combine`` is the
    aggregate (sum, exclusive or) and ``join`` the same for two columns. Neither
    ``group`` nor ``order`` is null, and no group has an ``order`` twice. As in
    ``positioned``, a large group is several stretches.
    """
    placed = df.repartitionByRange(group, order).sortWithinPartitions(group, order)
    placed = scratch.save(placed.withColumn("_part", F.spark_partition_id()), "running")
    none, past = F.lit(0).cast("bigint"), Window.unboundedPreceding
    earlier = Window.partitionBy("_group").orderBy("_stretch").rowsBetween(past, -1)
    stretches = placed.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_stretch")).agg(
        *[combine(c).alias(c) for c in values]
    )
    stretches = stretches.select(
        "_group", "_stretch", *[F.coalesce(combine(c).over(earlier), none).alias(f"_{c}") for c in values]
    )
    within = Window.partitionBy(group, "_part").orderBy(order).rowsBetween(past, -1)
    local = placed.withColumns({v: F.coalesce(combine(c).over(within), none) for c, v in values.items()})
    met = local.join(stretches, (F.col(group) == F.col("_group")) & (F.col("_part") == F.col("_stretch")))
    return met.withColumns({v: join(F.col(v), F.col(f"_{c}")) for c, v in values.items()}).select(
        *df.columns, *values.values()
    )
