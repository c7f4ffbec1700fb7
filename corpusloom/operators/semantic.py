"""Semantic deduplication: clusters of embeddings, cosine inside a cluster (SemDeDup).

Inside a cluster the items are ranked; one is a duplicate when its cosine to an
earlier-ranked one exceeds ``1 - eps``. Comparing all pairs of a cluster that
holds a third of the data cannot finish, so the search is cut down exactly:

* equal vectors become one, the first in rank;
* an item close to the first-ranked item of its sign-hash cell is decided there
  and then, which takes in large groups of near copies at linear cost;
* a cluster too large for one block is indexed by up to ``PIVOTS`` pivots, directions
  along which it is widest. An item lives in one cell, the tuple of its bands along
  them. Vectors with a cosine above the floor lie within a fixed distance, and so do
  their projections, so an item looks into its own cell and into those neighbours
  that this distance reaches, and meets every item it has to exactly once;
* the items of a cell, or of small cells side by side, are packed, up to ``BLOCK`` to a row that knows the box
  around their projections. Two packs meet if their boxes are within that distance, and of each the
  items that are within it of the other's box. Packs are read where they meet and not sent there, so
  whatever the number of pairs, no vector is written once more for them.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import vectors
from corpusloom.functions.vectors import matrix, unit_rows
from corpusloom.operators.exact import remove_duplicates
from corpusloom.operators.skew import salted_join
from corpusloom.scratch import Scratch

BLOCK = 8192
#: Bytes of the vectors of a pack, at most.
PACK_BYTES = 4 << 20
#: Clusters of up to so many blocks are compared by one task each; a file of packs has so many blocks as well.
WHOLE = 4
PIVOTS = 8
#: Rows, by a hash of their id, from which the pivots are taken. They only set the
#: pivots' directions, and so the balance of cells; every item is indexed.
PIVOT_SAMPLE = 4096
MAX_CENTROID_BYTES = 256 << 20
KEEP = ("hard", "easy", "random")
#: The name of the built-in encoder, which is asked for and never a silent stand-in.
BUILT_IN = "hashed-tokens"


@dataclass(frozen=True)
class SemanticConfig:
    """Field names are those of the YAML file."""

    num_files: int = 16
    embedding_model_name_or_path: str = ""
    embedding_batch_size: int = 128
    embedding_pooling_strategy: str = "mean_pooling"
    embedding_column: str = "embeddings"
    write_embeddings_to_disk: bool = True
    write_to_filename: bool = False
    max_iter: int = 100
    n_clusters: int = 1000
    random_state: int = 1234
    sim_metric: str = "cosine"
    which_to_keep: str = "hard"
    batched_cosine_similarity: int = 1024
    clustering_input_partition_size: str = "2gb"
    eps_to_extract: float = 0.01


def embed(
    df: DataFrame,
    config: SemanticConfig,
    text_field: str = "text",
    encoder: Callable[[list[str]], np.ndarray] | None = None,
) -> DataFrame:
    """Add the embedding column, by ``encoder`` or, where the configuration names it, the built-in one."""
    if encoder is None and config.embedding_model_name_or_path != BUILT_IN:
        raise ValueError(
            f"embedding_model_name_or_path is {config.embedding_model_name_or_path!r}: pass an encoder of "
            f"text batches for it, or name {BUILT_IN!r}"
        )
    vector = vectors.embed(
        F.col(text_field),
        encoder,
        pooling=config.embedding_pooling_strategy,
        batch_size=config.embedding_batch_size,
    )
    return df.withColumn(config.embedding_column, vector)


def write_embeddings(df: DataFrame, config: SemanticConfig, path: str, id_col: str, file_col: str = "file_name") -> None:
    """Ids and vectors as Parquet in ``num_files`` files, or by source file with ``write_to_filename``."""
    by_file = config.write_to_filename and file_col in df.columns
    table = df.select(id_col, config.embedding_column, *([file_col] if by_file else []))
    table = table.repartition(config.num_files)
    table.write.mode("overwrite").partitionBy(*([file_col] if by_file else [])).parquet(path)


def _size_in_bytes(size: str) -> int:
    """``"2gb"`` and the like."""
    units = {"kb": 10, "mb": 20, "gb": 30, "tb": 40}
    text = size.strip().lower()
    unit = text[-2:]
    return int(float(text[:-2]) * (1 << units[unit])) if unit in units else int(text)


def has_direction(vector: Column) -> Column:
    """Whether a vector is there and not zero: only such vectors can be compared by angle."""
    return F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def train_centroids(df: DataFrame, config: SemanticConfig) -> np.ndarray:
    """K-means centroids, at most ``n_clusters`` of them, as a ``k x d`` array.

    Without any vector that has a direction there are none.
    """
    if config.sim_metric != "cosine":
        raise ValueError(f"sim_metric {config.sim_metric!r}: clusters are compared by cosine")
    column = config.embedding_column
    directed = df.where(has_direction(F.col(column)))
    points = directed.select(array_to_vector(F.col(column).cast("array<double>")).alias("features"))
    first = directed.select(F.size(column)).head()
    if first is None:
        return np.empty((0, 0))
    rows = max(1, _size_in_bytes(config.clustering_input_partition_size) // (8 * first[0]))
    needed = -(-directed.count() // rows)
    if points.rdd.getNumPartitions() < needed:
        points = points.repartition(needed)
    if config.n_clusters == 1:
        return np.array([points.select(Summarizer.mean(F.col("features"))).first()[0].toArray()])
    model = KMeans(
        k=config.n_clusters,
        maxIter=config.max_iter,
        seed=config.random_state,
        distanceMeasure=config.sim_metric,
    ).fit(points)
    return np.array(model.clusterCenters())


def assign_clusters(
    df: DataFrame, centroids: np.ndarray, column: str, names: list[int] | None = None
) -> DataFrame:
    """Add ``cluster`` (nearest centroid) and ``centroid_sim`` (cosine to it).

    Both are null for a null or zero vector, and if there are no centroids.
    """
    if centroids.nbytes > MAX_CENTROID_BYTES:
        raise ValueError("centroids exceed the broadcast limit; lower n_clusters")
    labels = np.array(names if names is not None else range(len(centroids)), dtype=np.int64)
    shared = df.sparkSession.sparkContext.broadcast((unit_rows(centroids), labels))

    @F.pandas_udf("cluster int, centroid_sim double")
    def nearest(column: pd.Series) -> pd.DataFrame:
        units, label = shared.value
        out = pd.DataFrame({"cluster": pd.array([None] * len(column), "Int32"), "centroid_sim": np.nan})
        there = np.flatnonzero([v is not None and len(label) > 0 and bool(np.any(v)) for v in column])
        if len(there):
            sims = unit_rows(matrix(column.iloc[there])) @ units.T
            best = sims.argmax(axis=1)
            out.loc[there, "cluster"] = label[best]
            out.loc[there, "centroid_sim"] = sims[np.arange(len(best)), best]
        return out

    found = df.withColumn("_nearest", nearest.asNondeterministic()(column))
    sim = F.when(F.col("_nearest.cluster").isNotNull(), F.col("_nearest.centroid_sim"))
    return found.select(*df.columns, "_nearest.cluster", sim.alias("centroid_sim"))


def rank_key(keep: str, id_col: str) -> Column:
    """Items sort by this key, then by id; the earlier of two similar items stays."""
    if keep not in KEEP:
        raise ValueError(f"which_to_keep must be one of {KEEP}")
    if keep == "random":
        digits = F.substring(F.md5(F.col(id_col).cast("string").cast("binary")), 1, 12)
        return F.conv(digits, 16, 10).cast("double")
    rounded = F.round("centroid_sim", 9)
    return rounded if keep == "hard" else -rounded


def _ranked(assigned: DataFrame, column: str, id_col: str, keep: str) -> DataFrame:
    """``(id, cluster, key, vector)`` of the items in a cluster."""
    return assigned.where(F.col("cluster").isNotNull()).select(
        F.col(id_col).alias("id"), "cluster", rank_key(keep, id_col).alias("key"), F.col(column).alias("vector")
    )


def _first_copies(ranked: DataFrame) -> DataFrame:
    """One row per distinct vector of a cluster: the first in rank."""
    first = F.min(F.struct("key", "id"))
    return (
        ranked.groupBy("cluster", "vector")
        .agg(first.alias("first"))
        .select("first.id", "cluster", "first.key", "vector")
    )


def _near_cell_head(items: DataFrame, floor: float) -> DataFrame:
    """Ids of items closer than ``floor`` to the first-ranked item of their cell.

    A cell is a cluster and a sign hash, which near copies share. Finding a
    cell head moves keys and ids only; the vectors of heads are fetched by id.
    """
    cell = ["cluster", "code"]
    coded = items.withColumn("code", vectors.sign_hash("vector"))
    cells = (
        coded.groupBy(*cell)
        .agg(F.min(F.struct("key", "id")).alias("head"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )
    heads = cells.select(*cell, "head.*").join(
        items.select("id", F.col("vector").alias("head_vector")), "id"
    )
    heads = heads.select(
        *cell, F.col("key").alias("head_key"), F.col("id").alias("head_id"), "head_vector"
    )
    met = salted_join(coded, heads, cell, cells.select(*cell, "n"), F.col("id"))
    return (
        met.where(F.col("id") != F.col("head_id"))
        .where(vectors.cosine("vector", "head_vector") > floor)
        .select("id")
    )


def reach(floor: float) -> float:
    """How far apart two unit vectors with a cosine above ``floor`` can be."""
    return math.sqrt(max(0.0, 2 - 2 * floor)) + 1e-6


def pivot_axes(items: DataFrame, sizes: DataFrame, floor: float, block: int) -> np.ndarray:
    """Orthonormal directions along which the clusters above ``block`` items are widest, widest first.

    From a bounded sample of them. None if all clusters are small, or if the floor is so low that
    its distance spans the sphere.
    """
    large = sizes.where(F.col("n") > block).select("cluster")
    if 2 * reach(floor) > 1.5 or large.isEmpty():
        return np.empty((0, 0))
    drawn = items.join(large, "cluster").select("id", "cluster", "vector").orderBy(F.xxhash64("id"), "id")
    drawn = drawn.limit(PIVOT_SAMPLE).toPandas()
    units = unit_rows(matrix(drawn["vector"]))
    for cluster in drawn["cluster"].unique():
        members = (drawn["cluster"] == cluster).to_numpy()
        units[members] -= units[members].mean(axis=0)
    return np.linalg.svd(units, full_matrices=False)[2][:PIVOTS]


def cells(axes: np.ndarray, floor: float, guests: bool) -> Callable[[Column, Column], Column]:
    """A function of vector and number of axes in use: the cells an item is in, or looks into.

    Bands are a little wider than twice the reach, so along an axis at most one
    neighbour is within it, and of the combinations of neighbours those whose boundaries
    are together within it are looked into. Eight bits of a cell's number are one band.
    """
    width = max(2 * reach(floor) * (1 + 1e-9), 2 / 250)
    within = reach(floor) ** 2

    @F.pandas_udf("array<bigint>")
    def numbers(column: pd.Series, axes_used: pd.Series) -> pd.Series:
        out = np.empty(len(column), dtype=object)
        used = axes_used.to_numpy()
        for n in np.unique(used):
            rows = np.flatnonzero(used == n)
            if not n:
                for r in rows:
                    out[r] = [0]
                continue
            scaled = (unit_rows(matrix(column.iloc[rows])) @ axes[:n].T + 1) / width
            # Rounding may put a projection just outside -1 to 1; one band more on each side holds it.
            band = np.floor(scaled).astype(np.int64) + 1
            weight = np.int64(1) << (8 * np.arange(n, dtype=np.int64))
            home = (band * weight).sum(axis=1)
            if not guests:
                for r, cell in zip(rows, home, strict=True):
                    out[r] = [cell]
                continue
            part = scaled - np.floor(scaled)
            step = np.where(part < 0.5, -1, 1) * weight
            gap = (np.minimum(part, 1 - part) * width) ** 2
            choices = (np.arange(1 << n)[:, None] >> np.arange(n)) & 1
            near = gap @ choices.T <= within
            found = home[:, None] + step @ choices.T
            for i, r in enumerate(rows):
                out[r] = found[i][near[i]]
        return pd.Series(out)

    # Not deterministic, so that filters on the cells do not compute them twice.
    return numbers.asNondeterministic()


@dataclass(frozen=True)
class Meeting:
    """Items in their cells; probes in all they look into, and both counted by cell, where these are asked for."""

    items: DataFrame
    probes: DataFrame
    grid: DataFrame
    sizes: DataFrame
    axes: np.ndarray


def meeting(
    probes: DataFrame, items: DataFrame, floor: float, scratch: Scratch, block: int = BLOCK
) -> Meeting:
    """Where probes meet items. ``grid`` has, by cell, ``probe_rows`` and ``item_rows``.

    A cluster of up to ``block`` items is one cell. Above, each doubling brings one and a
    half more axes into use, so that looking into neighbours pays.
    """
    sizes = scratch.save(items.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")), "cluster_sizes")
    axes = pivot_axes(items, sizes, floor, block)
    wanted = F.ceil(1.5 * F.log2(F.col("n") / block)).cast("int")
    used = sizes.select("cluster", F.greatest(F.lit(0), F.least(F.lit(len(axes)), wanted)).alias("axes"))

    def placed(df: DataFrame, guests: bool) -> DataFrame:
        if not len(axes):
            return df.withColumn("cell", F.lit(0).cast("bigint"))
        numbers = cells(axes, floor, guests)
        return df.join(used, "cluster").withColumn("cell", F.explode(numbers("vector", "axes"))).drop("axes")

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("cluster", "cell").agg(F.count(F.lit(1)).alias(f"{name}_rows"))

    at_home, looking = placed(items, False), placed(probes, True).drop("vector")
    if len(axes):
        at_home = scratch.save(at_home, "at_home")
    grid = counted(looking, "probe").join(counted(at_home, "item"), ["cluster", "cell"])
    return Meeting(at_home, looking, grid, sizes, axes)


def pack(items: DataFrame, axes: np.ndarray, block: int) -> DataFrame:
    """``(cluster, low, high, first, last, looks, ids, keys, probe, vectors)``, up to ``block`` items to a row.

    ``low`` and ``high`` are the corners of the box around their projections on ``axes``; items are in rank
    order, with keys from ``first`` to ``last``; ``looks`` tells whether any is a ``probe``.
    """
    order = ["cluster", "cell", "key", "id"]
    parts = max(1, math.ceil(items.count() / (WHOLE * block)))
    dealt = items.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows, of = 0, (None, None)

        def flushed() -> pa.RecordBatch:
            some = pa.Table.from_batches(held).combine_chunks()
            some = some.take(pc.sort_indices(
                some, [("key", "ascending"), ("id", "ascending")], null_placement="at_start"
            ))
            keys, vectors = some.column("key"), some.column("vector").combine_chunks()
            at = _units(vectors.flatten(), len(vectors)) @ axes.T if len(axes) else np.empty((len(vectors), 0))
            one = lambda values: pa.ListArray.from_arrays([0, len(values)], values)
            columns = {
                "cluster": pa.array([of[0]], pa.int32()),
                "low": one(pa.array(at.min(axis=0), pa.float64())),
                "high": one(pa.array(at.max(axis=0), pa.float64())),
                "first": keys.slice(0, 1).combine_chunks(),
                "last": keys.slice(len(keys) - 1).combine_chunks(),
                "looks": pa.array([pc.any(some.column("probe")).as_py()], pa.bool_()),
                "ids": one(some.column("id").combine_chunks()),
                "keys": one(keys.combine_chunks()),
                "probe": one(some.column("probe").combine_chunks()),
                "vectors": one(vectors.flatten()),
            }
            held.clear()
            return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        for batch in batches:
            if not len(batch):
                continue
            vector = batch.column(5)
            # Ragged vectors can't be compared at all; the first one tells the width.
            most = max(1, min(block, PACK_BYTES // max(1, vector[0].values.nbytes)))
            cluster, cell = (batch.column(i).to_numpy() for i in (0, 1))
            change = np.flatnonzero((cluster[1:] != cluster[:-1]) | (cell[1:] != cell[:-1])) + 1
            for begin, end in zip([0, *change.tolist()], [*change.tolist(), len(batch)], strict=True):
                here = (int(cluster[begin]), int(cell[begin]))
                # A cell begins a pack of its own, unless the last pack is still small.
                if rows and (here[0] != of[0] or here != of and 2 * rows >= most):
                    yield flushed()
                    rows = 0
                of = here
                while begin < end:
                    taken = min(end - begin, most - rows)
                    held.append(batch.slice(begin, taken))
                    begin, rows = begin + taken, rows + taken
                    if rows >= most:
                        yield flushed()
                        rows = 0
        if rows:
            yield flushed()

    kinds = {c: items.schema[c].dataType.simpleString() for c in ("id", "vector")}
    box = "low array<double>, high array<double>, first double, last double, looks boolean"
    return dealt.select(*order, "probe", "vector").mapInArrow(
        packed,
        f"cluster int, {box}, ids array<{kinds['id']}>, keys array<double>, probe array<boolean>, vectors {kinds['vector']}",
    )


def _units(flat: pa.Array, rows: int) -> np.ndarray:
    return unit_rows(flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1))


def _earlier(keys: np.ndarray, ids: pa.Array, of_keys: np.ndarray, of_ids: pa.Array) -> np.ndarray:
    """How many of the ranked items ``of_keys, of_ids`` come before each of ``keys, ids``."""
    low, high = (np.searchsorted(of_keys, keys, side) for side in ("left", "right"))
    tied = np.flatnonzero(low < high)
    if len(tied):
        mine, others = ([(x is not None, x) for x in some.to_pylist()] for some in (ids, of_ids))
        for i in tied:
            low[i] = bisect_left(others, mine[i], low[i], high[i])
    return low


def _compared(pairs: DataFrame, axes: np.ndarray, floor: float, step: int, schema: T.StructType) -> DataFrame:
    """``(id, max_sim)`` of the probes of pack ``a`` that have an earlier item above ``floor`` in pack ``b``.

    Cosines are taken in single precision first; rows that come near the floor are taken again.
    """
    within = reach(floor) ** 2 * (1 + 1e-9)
    names = ["ids", "keys", "probe", "vectors", "low", "high"]

    def best_of(a: dict[str, pa.Array], b: dict[str, pa.Array]) -> tuple[np.ndarray, np.ndarray]:
        units_a, units_b = (_units(x["vectors"], len(x["ids"])) for x in (a, b))

        def close(units: np.ndarray, other: dict[str, pa.Array]) -> np.ndarray:
            if not len(axes):
                return np.ones(len(units), bool)
            at, low, high = units @ axes.T, other["low"].to_numpy(), other["high"].to_numpy()
            return (np.maximum(0, np.maximum(low - at, at - high)) ** 2).sum(axis=1) <= within

        rows = np.flatnonzero(a["probe"].to_numpy(zero_copy_only=False) & close(units_a, b))
        cols = np.flatnonzero(close(units_b, a))
        before = _earlier(
            a["keys"].to_numpy()[rows], a["ids"].take(pa.array(rows)), b["keys"].to_numpy()[cols], b["ids"].take(pa.array(cols))
        )
        rows, before = rows[before > 0], before[before > 0]
        best = np.full(len(rows), -2.0)
        if not len(rows):
            return rows, best
        units_a, units_b = units_a[rows], units_b[cols]
        short_a, short_b = units_a.astype(np.float32), units_b.astype(np.float32)
        margin = (units_a.shape[1] + 4) * 2.0**-23
        for i in range(0, len(rows), step):
            here = before[i : i + step]
            for j in range(0, here.max(), step):
                end = min(j + step, here.max())
                later = np.arange(j, end)[None, :] >= here[:, None] if here.min() < end else None
                sims = short_a[i : i + step] @ short_b[j:end].T
                if later is not None:
                    sims[later] = -2.0
                again = np.flatnonzero(sims.max(axis=1) > floor - margin)
                if len(again):
                    sims = units_a[i + again] @ units_b[j:end].T
                    if later is not None:
                        sims[later[again]] = -2.0
                    best[i + again] = np.maximum(best[i + again], sims.max(axis=1))
        return rows[best > floor], best[best > floor]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                a, b = ({c: batch.column(f"{side}_{c}")[i].values for c in names} for side in "ab")
                rows, best = best_of(a, b)
                yield pa.RecordBatch.from_arrays([a["ids"].take(pa.array(rows)), pa.array(best)], names=["id", "max_sim"])

    return pairs.select(*[f"{side}_{c}" for side in "ab" for c in names]).mapInArrow(compare, schema)


def _probe(
    items: DataFrame,
    decided: DataFrame | None,
    floor: float,
    config: SemanticConfig,
    scratch: Scratch,
    block: int,
) -> DataFrame:
    """``(id, max_sim)``: the largest cosine above ``floor`` to an earlier item, of all but the ``decided``.

    The packs of a cluster of up to ``WHOLE`` blocks meet in one task. Of a larger one, every two
    partitions of packs are a task, which reads them from the table: a product without a
    shuffle, so the disk in use grows with the items and not with the pairs.
    """
    probes = items if decided is None else items.join(decided, "id", "left_anti")
    met = meeting(probes, items, floor, scratch, block)
    marked = met.items.withColumn("probe", F.lit(True))
    if decided is not None:
        gone = decided.select("id").distinct().withColumn("gone", F.lit(True))
        marked = met.items.join(gone, "id", "left").withColumn("probe", F.col("gone").isNull())
    packs = scratch.save(pack(marked, met.axes, block), "packs", ["cluster"])
    large = [r["cluster"] for r in met.sizes.where(F.col("n") > WHOLE * block).select("cluster").collect()]
    schema = T.StructType([items.schema["id"], T.StructField("max_sim", T.DoubleType())])
    gap = F.zip_with(
        F.zip_with("a_low", "b_high", lambda x, y: x - y),
        F.zip_with("b_low", "a_high", lambda x, y: x - y),
        lambda x, y: F.greatest(F.lit(0.0), x, y),
    )
    apart = F.aggregate(gap, F.lit(0.0), lambda total, x: total + x * x)
    meets = (apart <= reach(floor) ** 2 * (1 + 1e-9)) & (F.col("b_first") <= F.col("a_last"))

    def sides(some: DataFrame) -> tuple[DataFrame, DataFrame]:
        named = lambda side: [F.col(c).alias(f"{side}_{c}") for c in some.columns]
        return some.where("looks").select(*named("a")), some.select(*named("b"))

    def compared(pairs: DataFrame) -> DataFrame:
        return _compared(pairs.where(meets), met.axes, floor, config.batched_cosine_similarity, schema)

    # Dealt by number and not by bytes: the work grows with the square of a cluster.
    parts = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left, right = sides(packs.where(~F.col("cluster").isin(large)))
    found = [compared(left.repartition(parts, "a_cluster").join(right, F.col("a_cluster") == F.col("b_cluster")))]
    for cluster in large:
        left, right = sides(packs.where(F.col("cluster") == cluster).drop("cluster"))
        found.append(scratch.save(compared(left.crossJoin(right.hint("shuffle_replicate_nl"))), "compared"))
    every = found[0]
    for some in found[1:]:
        every = every.unionByName(some)
    return every.groupBy("id").agg(F.max("max_sim").alias("max_sim"))


def nearest_earlier(
    assigned: DataFrame,
    config: SemanticConfig,
    scratch: Scratch,
    id_col: str = "id",
    floor: float | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """``(id, max_sim)`` of every item with an earlier one of its cluster above ``floor``.

    ``floor`` defaults to ``1 - eps``. The exact maximum needs every comparison
    the cells leave open; to only know which items go, use
    ``semantic_duplicates``, which decides most of them earlier.
    """
    floor = 1 - config.eps_to_extract if floor is None else floor
    ranked = scratch.save(
        _ranked(assigned, config.embedding_column, id_col, config.which_to_keep), "ranked"
    )
    items = scratch.save(_first_copies(ranked), "items")
    found = _probe(items, None, floor, config, scratch, block)
    copies = ranked.select("id").join(items.select("id"), "id", "left_anti")
    return found.unionByName(copies.withColumn("max_sim", F.lit(1.0))).withColumnRenamed("id", id_col)


def semantic_duplicates(
    assigned: DataFrame,
    config: SemanticConfig,
    scratch: Scratch,
    id_col: str = "id",
    block: int = BLOCK,
) -> DataFrame:
    """The ids to remove: a cosine above ``1 - eps`` to an earlier item of the cluster."""
    floor = 1 - config.eps_to_extract
    ranked = scratch.save(
        _ranked(assigned, config.embedding_column, id_col, config.which_to_keep), "ranked"
    )
    items = scratch.save(_first_copies(ranked), "items")
    copies = ranked.select("id").join(items.select("id"), "id", "left_anti")
    decided = scratch.save(_near_cell_head(items, floor), "decided")
    found = _probe(items, decided, floor, config, scratch, block).select("id")
    return copies.unionByName(decided).unionByName(found).withColumnRenamed("id", id_col)


def semantic_rank(assigned: DataFrame, config: SemanticConfig, id_col: str = "id") -> DataFrame:
    """Add ``key``, by which (then by id) the items of a cluster are ranked."""
    return assigned.withColumn("key", rank_key(config.which_to_keep, id_col))


def semantic_dedup(
    df: DataFrame,
    config: SemanticConfig,
    scratch: Scratch,
    id_col: str = "id",
    text_field: str = "text",
    encoder: Callable[[list[str]], np.ndarray] | None = None,
    embeddings_path: str | None = None,
) -> DataFrame:
    """Embed, cluster and drop; documents without a vector, or with a zero one, are kept.

    With ``embeddings_path`` and ``write_embeddings_to_disk``, the vectors are written there.
    """
    duplicates = semantic_duplicate_ids(df, config, scratch, id_col, text_field, encoder, embeddings_path)
    return remove_duplicates(df, duplicates, scratch, id_col)


def semantic_duplicate_ids(
    df: DataFrame,
    config: SemanticConfig,
    scratch: Scratch,
    id_col: str = "id",
    text_field: str = "text",
    encoder: Callable[[list[str]], np.ndarray] | None = None,
    embeddings_path: str | None = None,
) -> DataFrame:
    """The ids that ``semantic_dedup`` drops."""
    column = config.embedding_column
    embedded = df if column in df.columns else embed(df, config, text_field, encoder)
    names = [id_col, column, *(["file_name"] if "file_name" in df.columns else [])]
    points = scratch.save(embedded.select(*names).where(F.col(column).isNotNull()), "embeddings")
    if embeddings_path and config.write_embeddings_to_disk:
        write_embeddings(points, config, embeddings_path, id_col)
    assigned = assign_clusters(points.select(id_col, column), train_centroids(points, config), column)
    return semantic_duplicates(assigned, config, scratch, id_col)
