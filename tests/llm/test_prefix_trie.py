"""The prefix trie against dictionaries of whole prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import prefix_trie

TURNS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations(rows, opening=None):
    """Turns of each conversation, as sequences, with shared openings if ``opening`` is given."""
    own: dict = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn), role or "", text or ""))
    own = {c: tuple(t[1:] for t in sorted(ts)) for c, ts in own.items()}
    if opening is None:
        return own
    return {c: own.get(c - c % 20, ())[: opening(c)] + ts[opening(c) :] for c, ts in own.items()}


def plain_trie(convs):
    nodes: dict = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    out = []
    for path, members in nodes.items():
        under = [p for p in nodes if p[: len(path)] == path]
        leaves = [p for p in under if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in under)]
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1].split()) for p in under if p)
        ends = ",".join(map(str, sorted(c for c in members if len(convs[c]) == len(path))))
        out.append(
            (
                min(members),
                len(path),
                min(nodes[path[:-1]]) if path else None,
                len(members),
                sum(len(p) == len(path) + 1 for p in under),
                len(leaves),
                saved,
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def found(spark, scratch, rows, block=4, shared=False):
    df = spark.createDataFrame(rows, TURNS).repartition(3).selectExpr("*", "1 as pos", "2 as conv", "'x' as d1", "3 as words")
    turns = prefix_trie.read_turns(df, scratch)
    if shared:
        opening = F.crc32(F.col("conv").cast("string").cast("binary")) % 4
        both = prefix_trie.with_shared_openings(turns, scratch, opening)
    else:
        both = prefix_trie.as_they_are(turns)
    out = prefix_trie.trie(*both, scratch, block).select(*COLUMNS)
    return sorted(map(tuple, out.collect()), key=str)


def random_rows(n, longest, kinds, seed):
    rng = random.Random(seed)
    return [
        (c, t, rng.choice(["user", "assistant"]), " ".join(["w"] * rng.randrange(kinds)))
        for c in range(n)
        for t in range(rng.randrange(1, longest))
    ]


@pytest.mark.parametrize(("block", "slices"), [(1, 20_000), (3, 2), (4, 20_000)])
def test_trie_matches_plain_prefixes(spark, scratch, monkeypatch, block, slices):
    monkeypatch.setattr(prefix_trie, "ROWS_PER_SLICE", slices)
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 3)
    rows = random_rows(60, 9, 2, block)
    rows += [(100 + c, t, "user", f"same {t}") for c in range(20) for t in range(11)]  # copies
    rows += [(200 + c, t, "user", f"same {t}") for c in range(5) for t in range(4 + c)]  # ends in the copies' way
    assert found(spark, scratch, rows, block) == plain_trie(conversations(rows))


def test_shared_openings(spark, scratch):
    rows = random_rows(45, 6, 3, 7) + [(c, 0, "user", "no base") for c in range(61, 80)] + [(80, 0, None, None), (83, 0, None, None)]
    convs = conversations(rows, lambda c: zlib.crc32(str(c).encode()) % 4)
    assert any(not turns for turns in convs.values())
    assert found(spark, scratch, rows, shared=True) == plain_trie(convs)


def test_nulls_ties_repeats_and_long_conversations(spark, scratch):
    rows = [(1, None, "user", "first"), (1, 0, "b", "x y"), (1, 0, "a", "y"), (1, 0, "a", "x"), (1, 0, "a", "x")]
    rows += [(2, 5, None, None), (2, 5, None, None), (3, 5, "", ""), (3, None, "", ""), (None, 1, "user", "nobody's")]
    rows += [(4, t, "user", f"turn {t % 5}") for t in range(300)] + [(5, 0, "user", "w " * 200_000)]
    rows += [(6, t, "user", f"turn {t % 5}") for t in range(150)]
    assert found(spark, scratch, rows) == plain_trie(conversations(rows))


def test_empty_tables(spark, scratch):
    assert found(spark, scratch, []) == []
    assert found(spark, scratch, [], shared=True) == []
    assert found(spark, scratch, [(None, 0, "user", "x")]) == []
