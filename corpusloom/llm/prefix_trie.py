"""Prefix trie of conversations by digests of fixed-length blocks of turns.

A node is a distinct sequence of first turns. Conversations are compared block by
block first: a block is ``block`` turns, its digest covers them and their places,
and what came before a block is the digest of all blocks before it. Conversations
that agree up to a block and in its digest take the same way through it, so one of
them stands for all, and no turn of the others is looked at. Only blocks where
siblings diverge, or where one of them ends, are refined: there, each turn's prefix
digest is made and grouped.

Digests are 128 bits, combined by exclusive or of hashes of (place, role, text), so
that they can be added up from several stretches of a conversation: a conversation
with a third of all turns is shared out by ranges of its turns.

Every node belongs to its smallest member. A conversation's own nodes are the last
ones on its way, and hang below a node of a smaller conversation. Sums over
subtrees are therefore sums over the tree of conversations (made in a number of
rounds that is logarithmic in its height) and running sums within conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import positioned, running, words
from corpusloom.operators.skew import salted_join
from corpusloom.scratch import Scratch

BLOCK = 4
ROWS_PER_SLICE = 20_000
CHUNK_IDS = 1 << 15


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def read_turns(
    conversations: DataFrame,
    scratch: Scratch,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``(conv, pos, size, d1, d2, words)``: each turn's place, digest and number of words.

    Turns of a conversation go by ``turn_col``, nulls first, equal ones by role, then
    text; equal rows are turns of their own. A null role or text is an empty
    one. Rows without a conversation belong to none and go. Texts are sorted by, but
    not kept.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    turns = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv"),
        F.col(turn_col).alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.xxhash64(F.lit(1), role, text).alias("d1"),
        F.xxhash64(F.lit(2), text, role).alias("d2"),
        F.size(words(text)).cast("bigint").alias("words"),
    )
    return positioned(turns, scratch, "conv", ["turn", "role", "text"], ["conv", "d1", "d2", "words"])


def as_they_are(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``turns`` and ``(conv, length)``, for ``trie``."""
    return turns.select("conv", "pos", "d1", "d2", "words"), turns.where("pos = 0").select("conv", F.col("size").alias("length"))


def with_shared_openings(
    turns: DataFrame, scratch: Scratch, opening: Column, every: int = 20, most: int = 3
) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are taken from another one.

    ``opening`` (of ``conv``, at most ``most``) is the number ``h`` of turns of
    conversation ``conv - conv % every`` that come first: all if it has fewer, none if
    there is no such conversation. A conversation's own turns follow, without its first
    ``h``. Returns turns and ``(conv, length)``; a conversation may be left without turns.
    """
    turns = scratch.save(turns, "read")
    base = F.col("conv") - F.col("conv") % every
    heads = scratch.save(
        turns.where((F.col("conv") % every == 0) & (F.col("pos") < most)).withColumnRenamed("conv", "base"), "heads"
    )
    convs = turns.where("pos = 0").select("conv", "size", base.alias("base"), opening.cast("bigint").alias("h"))
    found = heads.where("pos = 0").select("base", F.col("size").alias("there"))
    taken = F.least("h", F.coalesce("there", F.lit(0)))
    convs = convs.join(found, "base", "left").withColumn("taken", taken)
    convs = scratch.save(
        convs.withColumn("length", F.col("taken") + F.greatest(F.col("size") - F.col("h"), F.lit(0))), "conversations"
    )
    first = convs.select("conv", "base", "taken").join(heads.drop("size"), "base").where("pos < taken")
    sizes = convs.select("conv", F.col("size").alias("n"))
    own = salted_join(
        turns.drop("size"), convs.select("conv", "h", "taken"), ["conv"], sizes, F.col("pos"), ROWS_PER_SLICE
    ).where("pos >= h")
    names = ["conv", "pos", "d1", "d2", "words"]
    own = own.withColumn("pos", F.col("pos") - F.col("h") + F.col("taken")).select(*names)
    return first.select(*names).unionByName(own), convs.select("conv", "length")


def _steps(turns: DataFrame, blocks: DataFrame, scratch: Scratch, block: int) -> DataFrame:
    """``(depth, ka, kb, pa, pb, conv, weight, words)``: the ways through the blocks that need a look.

    ``k`` is the digest of the prefix that ends with a turn, ``p`` of the one before it.
    """
    at = ["j", "sa", "sb"]
    groups = scratch.save(
        blocks.groupBy(*at).agg(
            F.count(F.lit(1)).alias("n"),
            F.min("conv").alias("conv"),
            F.min(F.struct("ea", "eb")).alias("lo"),
            F.max(F.struct("ea", "eb")).alias("hi"),
        ),
        "groups",
    )
    together = groups.where("lo = hi").select("conv", *at, F.col("n").alias("weight"))
    apart = groups.where("lo != hi").select(*at, "n")
    each = salted_join(blocks.select("conv", *at), apart.select(*at), at, apart, F.col("conv"), ROWS_PER_SLICE)
    chosen = together.unionByName(each.select("conv", *at, F.lit(1).cast("bigint").alias("weight")))
    inside = Window.partitionBy("conv", "j").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    met = turns.join(chosen, ["conv", "j"])
    met = met.withColumns({"ka": _xor(F.bit_xor("a").over(inside), F.col("sa")), "kb": _xor(F.bit_xor("b").over(inside), F.col("sb"))})
    return met.select(
        (F.col("pos") + 1).alias("depth"),
        "ka",
        "kb",
        _xor(F.col("ka"), F.col("a")).alias("pa"),
        _xor(F.col("kb"), F.col("b")).alias("pb"),
        "conv",
        "weight",
        "words",
    )


def _ends(convs: DataFrame, blocks: DataFrame, block: int) -> DataFrame:
    """``(depth, ka, kb, ends_sha256)`` of the nodes where conversations end.

    Ids are put in order and joined in chunks by range; SHA-256 can only be fed in
    order, so a node's chunks, however many, pass through one hasher, one by one.
    """
    last = F.floor((F.col("length") - 1) / block).cast("bigint")
    ended = convs.withColumn("j", last).join(blocks.select("conv", "j", "ea", "eb"), ["conv", "j"], "left")
    key = ["ka", "kb", "depth"]
    zero = F.lit(0).cast("bigint")
    ended = ended.select(
        F.col("length").alias("depth"), F.coalesce("ea", zero).alias("ka"), F.coalesce("eb", zero).alias("kb"), "conv"
    )

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        now, ids = None, []

        def put() -> None:
            if ids:
                out.append(dict(zip(key, now, strict=True)) | {"first": ids[0], "ids": ",".join(map(str, ids))})
                ids.clear()

        for batch in batches:
            for *at, conv in zip(*(batch.column(c).to_pylist() for c in (*key, "conv")), strict=True):
                if at != now or len(ids) == CHUNK_IDS:
                    put()
                    now = at
                ids.append(conv)
            if out:
                yield pa.RecordBatch.from_pylist(out, chunk)
                out.clear()
        put()
        if out:
            yield pa.RecordBatch.from_pylist(out, chunk)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            out: list[dict] = []
            for row in batch.to_pylist():
                at = [row[c] for c in key]
                if at == now:
                    digest.update(b",")
                else:
                    if digest is not None:
                        out.append(dict(zip(key, now, strict=True)) | {"ends_sha256": digest.hexdigest()})
                    now, digest = at, hashlib.sha256()
                digest.update(row["ids"].encode())
            yield pa.RecordBatch.from_pylist(out, done)
        if digest is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(key, now, strict=True)) | {"ends_sha256": digest.hexdigest()}], done)

    keys = [(c, pa.int64()) for c in key]
    chunk = pa.schema([*keys, ("first", pa.int64()), ("ids", pa.string())])
    done = pa.schema([*keys, ("ends_sha256", pa.string())])
    kinds = "ka bigint, kb bigint, depth bigint"
    parts = ended.repartitionByRange(*key, "conv").sortWithinPartitions(*key, "conv")
    parts = parts.select(*key, "conv").mapInArrow(chunks, f"{kinds}, first bigint, ids string")
    parts = parts.repartition(*key).sortWithinPartitions(*key, "first")
    return parts.mapInArrow(hashed, f"{kinds}, ends_sha256 string")


def _totals(forest: DataFrame, scratch: Scratch) -> DataFrame:
    """``(conv, leaves, saved)`` summed over each conversation and those below it.

    ``forest`` is ``(conv, up, leaves, saved)``. After a round, a sum covers twice as
    many generations, and ``up`` leads twice as far.
    """
    state = scratch.save(forest, "forest")
    while True:
        hanging = state.where("up is not null")
        if hanging.isEmpty():
            return state.select("conv", "leaves", "saved")
        sums = scratch.save(
            hanging.groupBy("up").agg(
                F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"), F.count(F.lit(1)).alias("n")
            ),
            "sums",
        )
        further = state.where("up is not null").select(F.col("conv").alias("up"), F.col("up").alias("further"))
        jumps = salted_join(hanging.select("conv", "up"), further, ["up"], sums, F.col("conv"), ROWS_PER_SLICE)
        below = sums.select(F.col("up").alias("conv"), "more_leaves", "more_saved")
        grown = state.drop("up").join(below, "conv", "left").join(
            jumps.select("conv", F.col("further").alias("up")), "conv", "left"
        )
        after = scratch.save(
            grown.select(
                "conv",
                "up",
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            ),
            "forest",
        )
        scratch.drop(state)
        scratch.drop(sums)
        state = after


def trie(turns: DataFrame, convs: DataFrame, scratch: Scratch, block: int = BLOCK) -> DataFrame:
    """The nodes of the prefix trie of ``turns(conv, pos, d1, d2, words)``.

    ``convs(conv, length)`` has every conversation, also those without turns, which end
    at the root. One row per distinct prefix: ``conv_id`` (smallest conversation that starts
    with it), ``depth``, ``parent_conv_id`` (null at the root), ``n_convs``, ``n_children``,
    ``n_leaves`` (childless nodes of the subtree, itself included), ``saved_tokens``
    (over the subtree, words of a node's last turn for each conversation but one) and
    ``ends_sha256`` (of the ids of the conversations that end there, ascending,
    comma-joined). Equal conversations share all nodes. No conversations, no rows.
    """
    rows = turns.select(
        "conv",
        "pos",
        "words",
        F.floor(F.col("pos") / block).cast("bigint").alias("j"),
        F.xxhash64("d1", "d2", "pos").alias("a"),
        F.xxhash64("pos", "d2", "d1").alias("b"),
    )
    rows = scratch.save(rows, "turns")
    blocks = rows.groupBy("conv", "j").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    blocks = running(blocks, scratch, "conv", "j", {"a": "sa", "b": "sb"}, F.bit_xor, _xor)
    ends = {"ea": _xor(F.col("sa"), F.col("a")), "eb": _xor(F.col("sb"), F.col("b"))}
    blocks = scratch.save(blocks.withColumns(ends).drop("a", "b"), "blocks")

    nodes = _steps(rows, blocks, scratch, block).groupBy("depth", "ka", "kb").agg(
        F.min("conv").alias("conv_id"),
        F.sum("weight").alias("n_convs"),
        F.max("words").alias("words"),
        F.min("pa").alias("pa"),
        F.min("pb").alias("pb"),
    )
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    root = convs.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = root.select(
        zero.alias("depth"), zero.alias("ka"), zero.alias("kb"), "conv_id", "n_convs", zero.alias("words"), none.alias("pa"), none.alias("pb")
    )
    nodes = scratch.save(nodes.unionByName(root), "nodes")

    up = nodes.where("depth > 0").withColumn("pd", F.col("depth") - 1)
    children = scratch.save(up.groupBy("pd", "pa", "pb").agg(F.count(F.lit(1)).alias("n")), "children")
    parents = nodes.select(
        F.col("depth").alias("pd"), F.col("ka").alias("pa"), F.col("kb").alias("pb"), F.col("conv_id").alias("parent_conv_id")
    )
    linked = salted_join(up, parents, ["pd", "pa", "pb"], children, F.col("conv_id"), ROWS_PER_SLICE).drop("pd", "pa", "pb")
    linked = linked.unionByName(nodes.where("depth = 0").drop("pa", "pb").withColumn("parent_conv_id", none))
    of = children.select(F.col("pd").alias("depth"), F.col("pa").alias("ka"), F.col("pb").alias("kb"), F.col("n").alias("n_children"))
    linked = linked.join(of, ["depth", "ka", "kb"], "left").withColumn("n_children", F.coalesce("n_children", zero))
    linked = linked.withColumns(
        {"leaves": (F.col("n_children") == 0).cast("bigint"), "saved": (F.col("n_convs") - 1) * F.col("words")}
    )
    linked = scratch.save(linked.drop("words"), "linked")

    tops = linked.where("parent_conv_id != conv_id").select(
        F.col("conv_id").alias("conv"), F.col("parent_conv_id").alias("up"), (F.col("depth") - 1).alias("under")
    )
    tops = scratch.save(tops, "tops")
    own = linked.groupBy(F.col("conv_id").alias("conv")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    forest = own.join(tops.select("conv", "up"), "conv", "left").select("conv", "up", "leaves", "saved")
    totals = _totals(forest, scratch)
    below = tops.join(totals, "conv").groupBy(F.col("up").alias("conv_id"), F.col("under").alias("depth")).agg(
        F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
    )
    gained = linked.select("conv_id", "depth", "leaves", "saved").join(below, ["conv_id", "depth"], "left").select(
        "conv_id",
        "depth",
        (-F.col("depth")).alias("deepest_first"),
        (F.col("leaves") + F.coalesce("more_leaves", zero)).alias("leaves"),
        (F.col("saved") + F.coalesce("more_saved", zero)).alias("saved"),
    )
    sums = running(
        gained, scratch, "conv_id", "deepest_first", {"leaves": "deeper_leaves", "saved": "deeper_saved"}, F.sum, lambda a, b: a + b
    ).select(
        "conv_id",
        "depth",
        (F.col("leaves") + F.col("deeper_leaves")).alias("n_leaves"),
        (F.col("saved") + F.col("deeper_saved")).alias("saved_tokens"),
    )
    out = linked.drop("leaves", "saved").join(sums, ["conv_id", "depth"])
    out = out.join(_ends(convs, blocks, block), ["depth", "ka", "kb"], "left")
    nobody = F.sha2(F.lit("").cast("binary"), 256)
    return out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", nobody).alias("ends_sha256"),
    )
