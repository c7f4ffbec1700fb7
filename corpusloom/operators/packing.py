"""Packing of several examples into one training sequence."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.ordering import running_sum
from corpusloom.scratch import Scratch

SHARD_ROWS = 20_000


def pack_by_offset(
    df: DataFrame, seq_length: int, order_by: Sequence[str], scratch: Scratch, size_col: str = "n_tokens"
) -> DataFrame:
    """Add ``bin``: consecutive examples share one until it starts the next.

    The last example of a bin may run over its end.
    """
    summed = running_sum(df, size_col, order_by, scratch, name="_end")
    return summed.withColumn("bin", F.expr(f"(_end - {size_col}) div {seq_length}")).drop("_end")


def pieces(
    df: DataFrame, seq_length: int, id_col: str = "id", size_col: str = "n_tokens", group_by: Sequence[str] = ()
) -> DataFrame:
    """``(id, part, from, to, size)`` and groups: each example cut where it is longer than a sequence.

    Parts are whole sequences but for the last; tokens ``from`` to ``to`` (not
    included) of an example are in one part. An empty example, or one without a
    size, is one empty part.
    """
    size = F.coalesce(F.col(size_col).cast("bigint"), F.lit(0).cast("bigint"))
    last = F.greatest(F.ceil(size / seq_length) - 1, F.lit(0)).cast("int")
    part = F.explode(F.sequence(F.lit(0), last)).alias("part")
    cut = df.select(*group_by, F.col(id_col).alias("id"), size.alias("_size"), part)
    begin = F.col("part").cast("bigint") * seq_length
    end = F.least(begin + seq_length, F.col("_size"))
    return cut.select(*group_by, "id", "part", begin.alias("from"), end.alias("to"), (end - begin).alias("size"))


def pack_ffd(
    df: DataFrame,
    seq_length: int,
    id_col: str = "id",
    size_col: str = "n_tokens",
    rows: int | None = None,
    shard_rows: int = SHARD_ROWS,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """``(shard, bin, id, part, from, to, size)`` by first-fit-decreasing; no bin exceeds ``seq_length``.

    Longer examples are packed in ``pieces``, so no token is lost. Packing runs inside
    shards cut by a hash of id and part, so shards are even and of about
    ``shard_rows`` pieces at any data size. ``rows`` is the number of pieces, if known.
    Examples of different groups (splits, for one) share no bin; the result has these columns first.
    """
    group_by = list(group_by)
    cut = pieces(df, seq_length, id_col, size_col, group_by)
    rows = cut.count() if rows is None else rows
    shards = max(1, -(-rows // shard_rows))
    id_type = df.schema[id_col].dataType.simpleString()
    names = [*group_by, "shard", "bin", "id", "part", "from", "to", "size"]
    kinds = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in group_by)
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("id", "part"), F.lit(shards)).cast("int"))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", "id", "part"], ascending=[False, True, True])
        return group.assign(bin=first_fit(group["size"].to_numpy(), seq_length))[names]

    return (
        dealt.groupBy(*group_by, "shard")
        .applyInPandas(pack, f"{kinds}shard int, bin int, id {id_type}, part int, from bigint, to bigint, size bigint")
        .withColumnRenamed("id", id_col)
    )


def packed_sequences(
    examples: DataFrame,
    seq_length: int,
    scratch: Scratch,
    id_col: str = "id",
    group_by: Sequence[str] = (),
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row per training sequence: ``token_ids``, ``loss_mask``, and where each piece is in it.

    ``examples`` has ``token_ids``, ``n_prompt`` (tokens at the front that bring no loss) and
    ``n_tokens``. ``pieces`` lists, in the order of the sequence, ``(start, size, id, part)``; attention
    must not cross a ``start``, and positions count from it. Bins are found from the sizes
    alone; the ids then travel once, to their sequence, which holds at most ``seq_length`` of them.
    """
    group_by = list(group_by)
    settled = scratch.save(
        examples.select(*group_by, F.col(id_col).alias("id"), "token_ids", "n_prompt", F.col("n_tokens").cast("bigint").alias("n_tokens")),
        "examples",
    )
    bins = scratch.save(
        pack_ffd(settled, seq_length, group_by=group_by, shard_rows=shard_rows).select("shard", "bin", "id", "part", "from", "to"),
        "bins",
    )
    size = (F.col("to") - F.col("from")).cast("int")
    ids = F.slice("token_ids", (F.col("from") + 1).cast("int"), size)
    given = F.greatest(F.lit(0), F.least(size, F.col("n_prompt") - F.col("from"))).cast("int")
    mask = F.concat(F.array_repeat(F.lit(0), given), F.array_repeat(F.lit(1), size - given))
    piece = F.struct((-size).alias("less"), "id", "part", ids.alias("ids"), mask.alias("mask"))
    rows = settled.join(bins, "id").groupBy(*group_by, "shard", "bin").agg(F.array_sort(F.collect_list(piece)).alias("p"))
    placed = F.aggregate(
        "p",
        F.struct(F.lit(0).alias("at"), F.array().cast(f"array<struct<start: int, size: int, id: {settled.schema['id'].dataType.simpleString()}, part: int>>").alias("pieces")),
        lambda a, x: F.struct(
            (a["at"] - x["less"]).alias("at"),
            F.concat(a["pieces"], F.array(F.struct(a["at"].alias("start"), (-x["less"]).alias("size"), x["id"].alias("id"), x["part"].alias("part")))).alias("pieces"),
        ),
        lambda a: a["pieces"],
    )
    return rows.select(
        *group_by,
        "shard",
        "bin",
        F.flatten(F.transform("p", lambda x: x["ids"])).alias("token_ids"),
        F.flatten(F.transform("p", lambda x: x["mask"])).alias("loss_mask"),
        placed.alias("pieces"),
    )


def first_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The first bin with room for each size, in the order given.

    A tree over the bins holds the largest room below each node, so a bin is
    found, and its room lowered, in a number of steps that grows with the logarithm of the bins.
    """
    leaves = 1 << max(0, len(sizes) - 1).bit_length()
    room = [capacity] * (2 * leaves)
    bins = np.empty(len(sizes), dtype=np.int32)
    for i, size in enumerate(sizes.tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        bins[i] = node - leaves
        room[node] -= size
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
    return bins
