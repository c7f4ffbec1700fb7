"""Splits, blends and samples by a stable hash of the id: no shuffle of documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import bucket, fraction

SPLITS = ("train", "validation", "test")
RATE_STEPS = 1_000_000


def parse_weights(weights: str | Sequence[int]) -> list[int]:
    """``"998,1,1"`` or a sequence."""
    parts = weights.split(",") if isinstance(weights, str) else weights
    values = [int(w) for w in parts]
    if not values or min(values) < 0 or sum(values) == 0:
        raise ValueError(f"bad split weights {weights!r}")
    return values


def split_by_weight(
    df: DataFrame,
    weights: str | Sequence[int] = "998,1,1",
    id_col: str = "id",
    names: Sequence[str] = SPLITS,
) -> DataFrame:
    """Add ``split``, in proportion to the weights; a null id counts as an empty one."""
    values = parse_weights(weights)
    slot = bucket(F.coalesce(F.col(id_col).cast("string"), F.lit("")), sum(values))
    split: Column | None = None
    edge = 0
    for name, weight in zip(names, values, strict=True):
        edge += weight
        inside = slot < edge
        split = F.when(inside, name) if split is None else split.when(inside, name)
    return df.withColumn("split", split)


def blend_rates(
    df: DataFrame, weights: Mapping[str, float] | Sequence[str], source_col: str
) -> DataFrame:
    """``(source, rate)``: the share of each source to keep, not rounded.

    The scarcest source, relative to its weight, is kept whole. A plain list of
    sources weighs them equally. Sources without a weight are not in the blend.
    """
    if not isinstance(weights, Mapping):
        weights = dict.fromkeys(weights, 1.0)
    positive = [(source, float(w)) for source, w in weights.items() if w > 0]
    table = df.sparkSession.createDataFrame(
        pd.DataFrame(positive, columns=[source_col, "weight"]), f"{source_col} string, weight double"
    )
    counts = df.groupBy(source_col).agg(F.count(F.lit(1)).alias("n"))
    wanted = counts.join(table, source_col).withColumn("per_row", F.col("weight") / F.col("n"))
    # One row per weight that the caller has given, so one task may hold them.
    most = F.max("per_row").over(Window.partitionBy())
    return wanted.select(source_col, (F.col("per_row") / most).alias("rate"))


def blend_sources(
    df: DataFrame,
    weights: Mapping[str, float] | Sequence[str],
    source_col: str = "file_name",
    id_col: str = "id",
) -> DataFrame:
    """A mix with rows per source in proportion to the weights.

    The rates have at most one row per weight given by the caller, so they are
    broadcast, and a source with most of the rows is not gathered anywhere.
    """
    rates = blend_rates(df, weights, source_col)
    kept = df.join(F.broadcast(rates), source_col).where(fraction(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) < F.col("rate"))
    return kept.select(*df.columns)


def sample_preview(df: DataFrame, fraction: float, id_col: str = "id") -> DataFrame:
    """About ``fraction`` of the rows, the same ones on every run."""
    return df.where(bucket(F.col(id_col), RATE_STEPS) < round(fraction * RATE_STEPS))
