"""Line dedup, licence scans, mixing, token shards and extraction on small tables."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import extract, licences, lines, mixing, tokens_out

DOC = "id long, source string, text string"


@pytest.mark.parametrize("rows_per_slice", [100_000, 2])
def test_site_lines_match_a_plain_count(spark, scratch, rows_per_slice):
    rows = [(i, "a", f"menu\nown {i}\n\n menu ") for i in range(6)]
    rows += [(i, "b", "menu" if i == 10 else f"other {i}") for i in range(10, 40)]
    rows += [(50, None, "x"), (51, "", "x"), (52, "", "x"), (53, "a", None), (54, "a", "")]
    df = spark.createDataFrame(rows, DOC).withColumn("_site", F.lit(1)).withColumn("n_lines", F.lit("old"))
    out = lines.drop_site_lines(df, scratch, rows_per_slice=rows_per_slice)
    got = {r["id"]: (r["text"], r["n_lines"], r["n_dropped"], r["_site"]) for r in out.collect()}
    assert len(got) == len(rows)
    pages = Counter(s or "" for _, s, _ in rows)
    seen = Counter((s or "", x) for _, s, t in rows for x in {y.strip() for y in (t or "").split("\n")} - {""})
    for i, s, t in rows:
        bad = [seen[s or "", x.strip()] >= 3 and 100 * seen[s or "", x.strip()] > 10 * pages[s or ""] for x in (t or "").split("\n")]
        kept = None if t is None else "\n".join(x for x, b in zip(t.split("\n"), bad, strict=True) if not b)
        assert got[i] == (kept, 0 if t is None else len(bad), sum(bad), 1), i
    assert lines.drop_site_lines(df.limit(0), scratch).count() == 0


def test_a_text_of_very_many_boilerplate_lines(spark, scratch):
    import time

    body = "\n".join(f"line {i}" for i in range(100_000))
    df = spark.createDataFrame([(i, "a", body + f"\nown {i}\n") for i in range(3)], DOC)
    start = time.time()
    out = lines.drop_site_lines(df, scratch).collect()
    assert {r["id"]: r["text"] for r in out} == {i: f"own {i}\n" for i in range(3)}
    assert time.time() - start < 60


def test_licences_are_found_whole_and_by_line(spark, scratch):
    mit = licences.KNOWN["mit"][1]
    rows = [
        (8, "", "Licensed under the MIT License"),
        (9, "", "notes\nThis Project is licenced under the GNU GPL v3!\n# SPDX-License-Identifier: BSD-3-Clause"),
        (1, "", "Copyright (c) 2020 A B\n" + mit.upper().replace(",", " ,")),
        (2, "", "some text\nreleased under the MIT Licence\nmore"),
        (3, "", "Released under the MIT License, but not quite"),
        (4, "", None),
        (5, "", ""),
        (6, "", " .,\n"),
    ] + [(7, "", "Released under the MIT License.")] * 5
    df = spark.createDataFrame(rows, DOC).withColumn("_hit", F.lit(1)).withColumn("found", F.lit("old"))
    out = licences.scan(df, licences.known_digests(spark), scratch, rows_per_slice=2).collect()
    assert len(out) == len(rows)
    got = {r["id"]: [tuple(x) for x in r["found"]] for r in out}
    assert got[8] == [(0, "mit")] and got[9] == [(2, "gpl-3.0"), (3, "bsd-3-clause")]
    assert (0, "mit") in got[1] and got[2] == [(2, "mit")] and got[7] == [(0, "mit")]
    assert got[3] == got[4] == got[5] == got[6] == []
    assert licences.scan(df.limit(0), licences.known_digests(spark), scratch).count() == 0


def test_a_register_of_whole_texts(spark, scratch, tmp_path):
    long = "\n".join(f"{i}. You may use clause {i}, if you organise it." for i in range(5000))
    (tmp_path / "Own-1.0.txt").write_text(long)
    (tmp_path / "Other").write_text("Some other text of a licence")
    (tmp_path / "Empty").write_text(" .\n")
    known = licences.known_digests(spark, register=licences.read_register(spark, str(tmp_path)))
    texts = [long.replace("organise", "ORGANIZE").replace(".", " ."), "© 2021 Me\n" + long, long + " more", "a\nSome Other text, of a License\nb"]
    df = spark.createDataFrame([(i, "", t) for i, t in enumerate(texts)], DOC)
    got = {r["id"]: [tuple(x) for x in r["found"]] for r in licences.scan(df, known, scratch).collect()}
    assert got == {0: [(0, "own-1.0")], 1: [(0, "own-1.0")], 2: [], 3: [(2, "other")]}
    none = licences.scan(df, licences.known_digests(spark, known={}), scratch)
    assert all(r["found"] == [] for r in none.collect())


def test_mixture_keeps_its_budgets(spark, scratch):
    rows = [(i, "big" if i < 300 else "mid" if i < 360 else "low", "w " * (1 + i % 7)) for i in range(400)]
    rows += [(500, None, None), (501, "none", ""), (0, "big", "w")]
    df = spark.createDataFrame(rows, DOC).withColumn("_key", F.lit("k")).withColumn("epoch", F.lit("e"))
    plan = {r["source"]: r for r in mixing.plan(df, scratch, id_col="id").collect()}
    weights = np.array([r["weight"] for r in plan.values() if r["tokens"]])
    assert abs(weights.sum() - 1) < 1e-9
    assert plan["low"]["weight"] > plan["low"]["tokens"] / sum(r["tokens"] for r in plan.values())
    assert plan["low"]["budget"] / plan["low"]["tokens"] <= mixing.MAX_EPOCHS + 1e-6
    drawn = mixing.mix(df, scratch, id_col="id")
    assert drawn.columns == df.columns
    got = drawn.collect()
    words = Counter()
    for r in got:
        words[r["source"]] += len(r["text"].split())
    for s in ("big", "mid", "low"):
        assert plan[s]["budget"] - 16 <= words[s] <= plan[s]["budget"], s
    assert not {r["source"] for r in got} & {None, "none"}
    times = Counter(r["id"] for r in got if r["source"] == "low")
    assert max(times.values()) - min([times[i] for i in range(360, 400)]) <= 1
    assert mixing.mix(df.limit(0), scratch, id_col="id").count() == 0


def test_permutation_is_one_and_turns_back():
    for n in (1, 2, 5, 64, 1000):
        x = np.arange(n)
        y = tokens_out.feistel(x, n, 7)
        assert sorted(y) == list(x)
        assert (tokens_out.feistel(y, n, 7, inverse=True) == x).all()


def test_shards_hold_the_whole_stream(spark, scratch):
    texts = [None, "", "a b c", "é ü " * 50, "word " * 900, "same", "same", "<|endoftext|>"]
    df = spark.createDataFrame([(i, "s", t) for i, t in enumerate(texts)], DOC).withColumn("slot", F.lit("x")).coalesce(1)
    config = tokens_out.TokenConfig(length=32, per_shard=5)
    path = f"{scratch.root}/out"
    rows = {r["sequence"]: r for r in tokens_out.materialise(df, scratch, path, config=config).collect()}
    known = tokens_out.encoder(config)
    stream = [t for x in texts if x for t in [*known.encode_ordinary(x), config.end]]
    assert sum(r["n_tokens"] for r in rows.values()) == len(stream)
    read = tokens_out.read_slots(path, 0, 10**6)
    back = np.concatenate([read[rows[s]["slot"]] for s in range(len(rows))])
    assert back[: len(stream)].tolist() == stream and (back[len(stream) :] == config.end).all()
    assert (tokens_out.read_slots(path, 3, 9) == read[3:12]).all()
    assert tokens_out.materialise(df.limit(0), scratch, f"{scratch.root}/none", config=config).count() == 0


def test_extraction_of_odd_pages(spark, scratch):
    page = "<html><body><nav><a href='/'>Home</a></nav><article><p>Body {0}  of &amp; the\npage.</p></article><script>x()</script></body></html>"
    rows = [(i, f"http://h.example/{i}", page.format(i)) for i in range(8)]
    rows += [(20, None, None), (21, "not a url", ""), (22, "http://h.example/x", "<"), (23, "http://i.example/", "<p>Alone here.</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("_key", F.lit(1))
    out = {r["page_id"]: r["text"] for r in extract.extract(df, scratch).collect()}
    assert len(out) == len(rows)
    assert all(out[i] == f"Body {i} of & the page." for i in range(8)), out[0]
    assert out[20] == out[21] == "" and out[23] == "Alone here."
    assert extract.extract(df.limit(0), scratch).count() == 0
