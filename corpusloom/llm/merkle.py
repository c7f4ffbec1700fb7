"""Merkle manifest of a dataset with incremental witnesses.

Leaves are appended to a tree in order. An appender keeps, for each level, the run
of up to 16 subtrees that is still open; a leaf's partial witness hangs on the
subtree it is in. When the last sibling of a run arrives, the run becomes one
subtree and the witnesses of all its leaves grow by their siblings.

A tree of any size is appended to in aligned blocks of ``16 ** 3`` leaves, one
appender for each, spread over the cluster. A block's root is one subtree three
levels up, so the roots of a tree's blocks are further appends to the same tree,
again in blocks, until one node is left. The way back hands each block the witness
of its root, which completes those of its leaves. A group with a third of all
leaves is as many blocks as its size asks for, and no task holds more than one.
The roots of the groups are the leaves of one more such tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import positioned
from corpusloom.scratch import Scratch

FAN = 16
HEIGHT = 3
BLOCK = FAN**HEIGHT
WITNESS = "array<struct<at: int, others: string>>"


def leaf_digest(*columns: Column) -> Column:
    """Lower-case hex SHA-256 of the values: each ``-`` if null, else UTF-8 bytes, ``:``, value."""
    parts = []
    for column in columns:
        value = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(nodes: int) -> int:
    """Levels from ``nodes`` nodes up to one."""
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // FAN), levels + 1
    return levels


class Appender:
    """One block of a tree, as its leaves arrive; ``root`` is set when it is complete."""

    def __init__(self, levels: int, witnesses: bool = True):
        self.levels = levels
        self.open: list[list[tuple[str, list[int]]]] = [[] for _ in range(levels)]
        self.witnesses: list[list[tuple[int, str]]] | None = [] if witnesses else None
        self.root: str | None = None

    def append(self, digest: str) -> None:
        members = []
        if self.witnesses is not None:
            members = [len(self.witnesses)]
            self.witnesses.append([])
        self._put(0, digest, members)

    def close(self) -> None:
        """No more leaves: the last run of each level is shorter."""
        for level in range(self.levels):
            if self.open[level]:
                self._complete(level)

    def _put(self, level: int, digest: str, members: list[int]) -> None:
        if level == self.levels:
            self.root = digest
            return
        self.open[level].append((digest, members))
        if len(self.open[level]) == FAN:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        digests = [digest for digest, _ in run]
        for at, (_, members) in enumerate(run):
            if members:
                others = "".join(digests[:at] + digests[at + 1 :])
                for leaf in members:
                    self.witnesses[leaf].append((at, others))
        self._put(level + 1, sha("".join(digests)), [leaf for _, members in run for leaf in members])


def fold(digest: str, witness: list[tuple[int, str]]) -> str:
    """The root that ``digest`` and its siblings lead to."""
    for at, others in witness:
        digest = sha(others[: 64 * at] + digest + others[64 * at :])
    return digest


def _dealt(nodes: DataFrame) -> DataFrame:
    """Every block's rows together and in order; a row at ``pos`` -1 comes before them."""
    return nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of one block after the other, from batches that cut blocks anywhere."""
    rows: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and (row["tree"], row["block"]) != (rows[0]["tree"], rows[0]["block"]):
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def _batched(made: Iterator[dict], schema: pa.Schema, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    waiting: list[dict] = []
    for row in made:
        waiting.append(row)
        if len(waiting) == rows:
            yield pa.RecordBatch.from_pylist(waiting, schema)
            waiting = []
    if waiting:
        yield pa.RecordBatch.from_pylist(waiting, schema)


def _levels_of(size: int) -> int:
    """A block's height: up to the tree's root if the tree is one block."""
    return HEIGHT if size > BLOCK else height(size)


_NODE = pa.schema(
    [("tree", pa.string()), ("pos", pa.int64()), ("size", pa.int64()), ("digest", pa.string())]
)


def _raise(nodes: DataFrame) -> DataFrame:
    """``(tree, pos, size, digest)`` of the blocks' roots."""

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[dict]:
            for rows in _blocks(batches):
                size = rows[0]["size"]
                block = Appender(_levels_of(size), witnesses=False)
                for row in rows:
                    block.append(row["digest"])
                block.close()
                yield {"tree": rows[0]["tree"], "pos": rows[0]["block"], "size": -(-size // BLOCK), "digest": block.root}

        yield from _batched(made(), _NODE)

    nodes = nodes.select("tree", (F.col("pos") / BLOCK).cast("bigint").alias("block"), "pos", "size", "digest")
    return _dealt(nodes).mapInArrow(roots, "tree string, pos bigint, size bigint, digest string")


@dataclass(frozen=True)
class Grown:
    """The levels of all trees, each in blocks of the one above, and the trees' roots."""

    levels: list[DataFrame]
    roots: DataFrame


def grow(leaves: DataFrame, scratch: Scratch) -> Grown:
    """Append ``leaves(tree, pos, size, digest)``; roots are ``(tree, digest)``.

    A round divides the number of nodes by 4096, so there are few.
    """
    levels, roots = [leaves], None
    while True:
        above = scratch.save(_raise(levels[-1]), "level")
        done = above.where("size = 1").select("tree", "digest")
        roots = done if roots is None else roots.unionByName(done)
        above = above.where("size > 1")
        if above.isEmpty():
            return Grown(levels, roots)
        levels.append(above)


def _headers(level: DataFrame, top: DataFrame, above: DataFrame | None) -> DataFrame:
    """``(tree, block, witness, subroot, root)`` of the blocks of a level.

    ``top`` has what lies above each tree's root, ``above`` the witnesses of the next level.
    """
    alone = level.where((F.col("pos") == 0) & (F.col("size") <= BLOCK)).select("tree")
    own = top.join(alone, "tree").withColumn("block", F.lit(0).cast("bigint"))
    if above is not None:
        own = own.unionByName(above.withColumnRenamed("pos", "block"))
    return own.select("tree", "block", "witness", "subroot", "root")


def _with_headers(level: DataFrame, headers: DataFrame) -> DataFrame:
    rows = level.withColumn("block", (F.col("pos") / BLOCK).cast("bigint"))
    return _dealt(rows.unionByName(headers.withColumn("pos", F.lit(-1).cast("bigint")), allowMissingColumns=True))


def _lower(level: DataFrame, headers: DataFrame) -> DataFrame:
    """``(tree, pos, witness, subroot, root)`` of a level's nodes, with whole witnesses."""
    schema = pa.schema(
        [
            ("tree", pa.string()),
            ("pos", pa.int64()),
            ("witness", pa.list_(pa.struct([("at", pa.int32()), ("others", pa.string())]))),
            ("subroot", pa.string()),
            ("root", pa.string()),
        ]
    )

    def complete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[dict]:
            for head, *rows in _blocks(batches):
                block = Appender(_levels_of(rows[0]["size"]))
                for row in rows:
                    block.append(row["digest"])
                block.close()
                for row, own in zip(rows, block.witnesses, strict=True):
                    witness = [{"at": at, "others": others} for at, others in own] + head["witness"]
                    yield {
                        "tree": row["tree"],
                        "pos": row["pos"],
                        "witness": witness,
                        "subroot": head["subroot"],
                        "root": head["root"],
                    }

        yield from _batched(made(), schema, 256)

    nodes = level.select("tree", "pos", "size", "digest")
    return _with_headers(nodes, headers).mapInArrow(
        complete, f"tree string, pos bigint, witness {WITNESS}, subroot string, root string"
    )


def witnesses(grown: Grown, top: DataFrame, scratch: Scratch) -> DataFrame:
    """Headers of the blocks of leaves: what completes the witnesses of their leaves.

    ``top(tree, witness, subroot, root)`` is what lies above each tree's root.
    """
    above = None
    for level in reversed(grown.levels[1:]):
        above = scratch.save(_lower(level, _headers(level, top, above)), "witnesses")
    return _headers(grown.levels[0], top, above)


def manifest(
    docs: DataFrame,
    scratch: Scratch,
    leaf: Column,
    claim: Column | None = None,
    id_col: str = "doc_id",
    group_col: str = "source",
    whole_witness: bool = False,
) -> DataFrame:
    """One row per document: its place in the manifest and whether its claim holds.

    ``leaf`` is a document's digest (see ``leaf_digest``). The leaves of a group
    (``group_col``; null is a group of its own, before all others, and not the same as
    an empty name) ascend by id, a null id first, and rows with equal ids by digest
    and claim, so equal rows are leaves of their own. Groups ascend bytewise. The
    result has ``id``, ``group``, ``leaf``, ``subroot`` (the group's root), ``root``,
    ``proof_sha256`` (digest of the siblings up to the root, which is that of the empty
    string where there are none), ``folded_root`` (what ``claim``, or ``leaf`` where it
    is null or not given, and the siblings lead to) and ``verified`` (that is the root).
    ``whole_witness`` adds the siblings themselves, about 1 kB a level. An empty
    table gives no rows. Other columns, whatever their names, aren't read.
    """
    group = F.col(group_col).cast("string")
    rows = docs.select(
        # Null first, and told from the empty name.
        F.when(group.isNull(), "0").otherwise(F.concat(F.lit("1"), group)).alias("tree"),
        F.col(id_col).alias("id"),
        leaf.alias("digest"),
        (F.lit(None) if claim is None else claim).cast("string").alias("claim"),
    )
    placed = scratch.save(positioned(rows, scratch, "tree", ["id", "digest", "claim"], dealt=2), "leaves")
    grown = grow(placed.select("tree", "pos", "size", "digest"), scratch)
    groups = grown.roots.select(F.lit("all").alias("whole"), F.col("tree").alias("name"), "digest")
    groups = scratch.save(positioned(groups, scratch, "whole", ["name"]), "groups")
    nodes = groups.select(F.col("whole").alias("tree"), "pos", "size", "digest")
    over = grow(nodes, scratch)
    none = F.array().cast(WITNESS)
    crown = over.roots.select("tree", none.alias("witness"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    above = scratch.save(_lower(nodes, witnesses(over, crown, scratch)), "above")
    top = groups.join(above.select("pos", "witness", "root"), "pos")
    top = scratch.save(top.select(F.col("name").alias("tree"), "witness", F.col("digest").alias("subroot"), "root"), "top")
    headers = witnesses(grown, top, scratch)

    plain = ["group_key", "leaf", "subroot", "root", "proof_sha256", "folded_root"]
    siblings = pa.list_(pa.struct([("at", pa.int32()), ("others", pa.string())]))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        fields = [("id", first.schema.field("id").type), *[(c, pa.string()) for c in plain], ("verified", pa.bool_())]
        schema = pa.schema(fields + [("witness", siblings)] * whole_witness)

        def made() -> Iterator[dict]:
            for head, *rows in _blocks(chain([first], batches)):
                above = [(x["at"], x["others"]) for x in head["witness"]]
                tail = "".join(others for _, others in above)
                block = Appender(_levels_of(rows[0]["size"]))
                for row in rows:
                    block.append(row["digest"])
                block.close()
                for row, own in zip(rows, block.witnesses, strict=True):
                    folded = fold(row["claim"] or row["digest"], own + above)
                    out = {
                        "id": row["id"],
                        "group_key": row["tree"],
                        "leaf": row["digest"],
                        "subroot": head["subroot"],
                        "root": head["root"],
                        "proof_sha256": sha("".join(others for _, others in own) + tail),
                        "folded_root": folded,
                        "verified": folded == head["root"],
                    }
                    if whole_witness:
                        out["witness"] = [{"at": at, "others": others} for at, others in own + above]
                    yield out

        yield from _batched(made(), schema, 256 if whole_witness else 4096)

    kind = placed.schema["id"].dataType.simpleString()
    found = _with_headers(placed, headers).mapInArrow(
        verify,
        f"id {kind}, {', '.join(f'{c} string' for c in plain)}, verified boolean" + f", witness {WITNESS}" * whole_witness,
    )
    named = F.when(F.col("group_key") != "0", F.substring("group_key", 2, 2**31 - 1))
    return found.select("id", named.alias("group"), *[c for c in found.columns if c not in ("id", "group_key")])
