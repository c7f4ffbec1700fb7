"""Repeated passages against a dictionary of all windows."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from corpusloom.llm import substrings

DOC = "doc_id long, text string"


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def expected(rows, window):
    first: dict = {}
    for i, text in rows:
        w = words(text)
        for k in range(len(w) - window + 1):
            if i is not None:
                g = tuple(w[k : k + window])
                first[g] = min(first.get(g, i), i)
    out = []
    for i, text in rows:
        w = words(text)
        gone = {
            k + j
            for k in range(len(w) - window + 1)
            for j in range(window)
            if i is not None and first[tuple(w[k : k + window])] < i
        }
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def found(spark, scratch, rows, window):
    docs = spark.createDataFrame(rows, DOC).repartition(4).selectExpr("*", "1 as id", "'x' as n_words", "2 as block", "3 as body")
    out = substrings.drop_repeated_passages(docs, scratch, window=window)
    return sorted(map(tuple, out.select("id", "n_words", "n_removed", "text").collect()), key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["ä", "日本", " ", "a b"]
    own = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passages = [own(rng.randrange(3, 40)) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = [rng.choice([own(rng.randrange(0, 12)), rng.choice(passages)]) for _ in range(rng.randrange(0, 6))]
        rows.append((rng.randrange(100), rng.choice([" ", "\n", "\t "]).join(parts)))
    return rows + rows[:10] + [(None, passages[0]), (None, None), (200, None), (201, ""), (202, " \n"), (-5, passages[1])]


@pytest.mark.parametrize(("window", "bytes_", "share", "sorted_"), [(5, 500, 2048, 50), (5, 8 << 20, 10**9, 10**6), (2, 3000, 50, 100), (1, 900, 2048, 100)])
def test_words_match_all_windows(spark, scratch, monkeypatch, window, bytes_, share, sorted_):
    monkeypatch.setattr(substrings, "BLOCK_BYTES", bytes_)
    monkeypatch.setattr(substrings, "HEAVY_SHARE", share)
    monkeypatch.setattr(substrings, "REPORT_SHARE", 4 * share)
    monkeypatch.setattr(substrings, "BUCKET_PIECES", 100)
    rows = corpus(window)
    assert found(spark, scratch, rows, window) == expected(rows, window)


def test_copies_runs_of_one_word_and_long_texts(spark, scratch, monkeypatch):
    monkeypatch.setattr(substrings, "BLOCK_BYTES", 20_000)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, passage) for i in range(200)] + [(1000 + i, "x " * (i + 1)) for i in range(40)]
    rows += [(2000 + i, f"own{i} {passage} more{i}") for i in range(100)]
    rows += [(3000, " ".join(f"long{i}" for i in range(30_000))), (3001, " ".join(f"long{i}" for i in range(29_000, 31_000)))]
    assert found(spark, scratch, rows, 13) == expected(rows, 13)


def test_empty_table(spark, scratch):
    assert found(spark, scratch, [], 13) == []


def test_equal_words_have_equal_hashes():
    words = [b"a", b"ab", b"ba", b"a", b"x" * 5000, "ä".encode(), b"x" * 5000, b"ab"]
    found = substrings.Block(np.zeros(1), np.ones(1), np.array([len(words)]), b" ".join(words)).hashes().tolist()
    assert {w: h for w, h in zip(words, found, strict=True)} == dict(zip(words, found, strict=True))
    assert len(set(found)) == len(set(words)) and found[0] == found[3] and found[1] == found[7] and found[4] == found[6]


def test_pieces_cover_every_window_once():
    rng = np.random.default_rng(3)
    counts = np.array([0, 30, 12, 13, 0, 200])
    text = b" ".join(b"w%d" % rng.integers(15) for _ in range(counts.sum()))
    block = substrings.Block(np.arange(6), np.ones(6, np.uint8), counts, text)
    for heavy in (None, rng.random(substrings.SLOTS) < 0.5):
        pieces = block.pieces(13, heavy)
        seen = [w for a, b in zip(pieces.first, pieces.last, strict=True) for w in range(a, b + 1)]
        starts = np.cumsum(counts) - counts
        assert seen == [s + k for s, n in zip(starts, counts, strict=True) for k in range(max(0, n - 12))]
        assert (pieces.last - pieces.first).max() <= 13 - substrings.MINIMISER
