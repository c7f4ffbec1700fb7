"""The Merkle manifest against a plain tree built level by level."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import merkle

DOC = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row) -> str:
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def plain_tree(nodes: list[str]) -> tuple[str, list[list[tuple[int, list[str]]]]]:
    """The root, and each leaf's siblings with its place, level by level."""
    paths: list[list] = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, members = [], []
        for s in range(0, len(nodes), 16):
            run = nodes[s : s + 16]
            for k in range(len(run)):
                for i in under[s + k]:
                    paths[i].append((k, run[:k] + run[k + 1 :]))
            above.append(sha("".join(run)))
            members.append([i for k in range(len(run)) for i in under[s + k]])
        nodes, under = above, members
    return nodes[0], paths


def expected(rows):
    groups: dict = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        own = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[name] = own, *plain_tree([leaf(r) for r in own])
    root, crown = plain_tree([trees[name][1] for name in names])
    out = []
    for name, above in zip(names, crown, strict=True):
        own, subroot, paths = trees[name]
        for row, path in zip(own, paths, strict=True):
            path = path + above
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            text = row[4] if row[4] is None or not tampered else "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
            digest = leaf((*row[:4], text))
            for at, others in path:
                digest = sha("".join(others[:at] + [digest] + others[at:]))
            proof = sha("".join(x for _, others in path for x in others))
            out.append((row[0], leaf(row), subroot, root, proof, digest, digest == root))
    return out


def made(spark, scratch, rows):
    docs = spark.createDataFrame(rows, DOC).repartition(5)
    docs = docs.selectExpr("*", "1 as pos", "'x' as tree", "2 as size", "3 as id", "4 as digest")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    claim = F.when(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, merkle.leaf_digest(*fields, lower)
    )
    return merkle.manifest(docs, scratch, merkle.leaf_digest(*fields, F.col("text")), claim, whole_witness=True)


def key(row):
    return tuple((x is not None, x) for x in row)


@pytest.mark.parametrize("sizes", [(1,), (1, 1, 17), (16, 15, 300, 4096, 4097, 2, 5000)])
def test_manifest_matches_a_plain_tree(spark, scratch, sizes):
    rows = [
        (1000 * g + i, f"s{g}", None if i % 7 == 0 else "en", i, f"Text Ä {i}" if i % 3 else "plain")
        for g, n in enumerate(sizes)
        for i in range(n)
    ]
    out = made(spark, scratch, rows).collect()
    got = [tuple(r[c] for c in ("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in out]
    assert sorted(got, key=key) == sorted(expected(rows), key=key)
    for r in out[:50]:
        assert merkle.fold(r["leaf"], [(w["at"], w["others"]) for w in r["witness"]]) == r["root"]
        assert sha("".join(w["others"] for w in r["witness"])) == r["proof_sha256"]


def test_nulls_repeats_many_groups_and_long_texts(spark, scratch):
    rows = [(i, f"é{i % 40}", "en", i, "A") for i in range(100)]
    rows += [(None, None, None, None, None), (None, None, None, None, None), (3, None, "", 0, ""), (5, "", "", 0, "B" * 300_000)]
    rows += [(7, "é7", "en", 7, "A")] * 20 + [(7, "é7", "en", 7, "C")]
    out = made(spark, scratch, rows).collect()
    got = [tuple(r[c] for c in ("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in out]
    assert sorted(got, key=key) == sorted(expected(rows), key=key)
    assert {r["group"] for r in out} == {r[1] for r in rows}


def test_empty_table(spark, scratch):
    assert made(spark, scratch, spark.createDataFrame([], DOC).collect()).count() == 0


def test_appender_holds_one_open_run_a_level():
    block = merkle.Appender(3)
    for i in range(16 * 16 + 5):
        block.append(sha(str(i)))
        assert all(len(run) < 16 for run in block.open)
    block.close()
    assert block.root is not None
    assert {len(w) for w in block.witnesses} == {3}
