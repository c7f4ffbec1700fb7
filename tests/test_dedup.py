from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import minhash
from corpusloom.operators import exact, fuzzy, semantic
from corpusloom.operators.components import connected_components
from corpusloom.operators.skew import salted_join
from corpusloom.scratch import Scratch

CONFIG = fuzzy.FuzzyConfig()


def docs(spark, rows):
    return spark.createDataFrame(rows, "id bigint, text string").repartition(3)


def ids(df, col="id"):
    return sorted(r[0] for r in df.select(col).collect())


def test_salted_join_splits_a_hot_key(spark):
    big = spark.range(1000).select((F.col("id") % 10 * (F.col("id") % 3 == 0).cast("int")).alias("k"), "id")
    small = spark.range(10).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    sizes = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    plain = sorted(map(tuple, big.join(small, "k").select("k", "id", "v").collect()))
    split = salted_join(big, small, ["k"], sizes, F.col("id"), rows_per_slice=50)
    assert sorted(map(tuple, split.select("k", "id", "v").collect())) == plain


@pytest.mark.parametrize("rows_per_slice", [2, 1_000_000])
def test_exact_duplicates_with_a_hot_text(spark, scratch, rows_per_slice):
    rows = [(i, "same") for i in range(30)] + [(30, "other"), (31, None), (32, None), (33, "")]
    found = exact.exact_duplicates(docs(spark, rows), scratch, rows_per_slice=rows_per_slice)
    assert sorted(map(tuple, found.collect())) == [(i, 0, 30) for i in range(1, 30)]


def test_exact_dedup_keeps_null_texts_and_repeats_to_nothing(spark, scratch):
    df = docs(spark, [(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")])
    once = exact.exact_dedup(df, scratch)
    assert ids(once) == [1, 3, 4, 5]
    assert ids(exact.exact_dedup(once, scratch)) == [1, 3, 4, 5]


def test_remove_duplicates_beyond_the_broadcast_limit(spark, scratch):
    df, dups = spark.range(100), spark.range(0, 100, 3)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert ids(exact.remove_duplicates(df, dups, scratch)) == [i for i in range(100) if i % 3]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def brute_signature(text, config=CONFIG):
    points = [ord(ch) for ch in text]
    hashes = set()
    for i in range(len(points) - config.char_ngrams + 1):
        h = points[i]
        for c in points[i + 1 : i + config.char_ngrams]:
            h = (h * minhash.RADIX + c) % minhash.PRIME
        hashes.add(h)
    pairs = minhash.coefficients(config.seed, config.num_buckets * config.hashes_per_bucket)
    return [min((a * h + b) % minhash.PRIME for h in hashes) for a, b in pairs] if hashes else None


def test_signature_is_exact(spark):
    texts = ["abcd", "abcde", "日本語の文章です。", "x" * 700, "".join(map(chr, range(65, 1200))), None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string").coalesce(1)
    got = [r[0] for r in df.select(minhash.signature(F.col("text"))).collect()]
    assert got == [brute_signature(t) if t else None for t in texts]


def test_minima_are_exact_at_both_ends_and_over_many_chunks():
    p = minhash.PRIME
    for a, b in [(1, 0), (p - 1, p - 1), (1, p - 1), (p - 1, 0), (12345, 678)]:
        ends = [(-b * pow(a, -1, p)) % p, ((-b - 1) * pow(a, -1, p)) % p]
        values = [0, 1, 2, p // 2, p - 2, p - 1, *ends]
        got = minhash._Minima([(a, b)])([np.array([v]) for v in values])
        assert got[:, 0].tolist() == [(a * v + b) % p for v in values]
    pairs = minhash.coefficients(3, 5)
    sets = [np.array([7]), np.arange(3 * minhash._CHUNK + 1) * 9973 % p, np.arange(50)]
    want = [[min((a * int(v) + b) % p for v in s) for a, b in pairs] for s in sets]
    assert minhash._Minima(pairs)(sets).tolist() == want


def test_shingle_sets_leave_in_batches_of_their_own(spark, monkeypatch):
    texts = ["".join(map(chr, range(0x4E00 + 50 * i, 0x4E00 + 50 * i + 40 + i % 3))) for i in range(60)]
    rows = [*enumerate([*texts, None, "", "abcd", "aaaaaaaa"])]
    df = spark.createDataFrame(rows, "id bigint, text string").coalesce(1)
    monkeypatch.setattr(minhash, "_BATCH", 100)
    made = {r["id"]: r["set"] for r in minhash.shingle_sets(df, "id").collect()}
    assert made == {i: None if t is None else minhash.shingle_set(t, 5).tolist() for i, t in rows}
    seen = []
    source = df.select("id", "text")
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, schema: seen.append(f) or source)
    minhash.shingle_sets(df, "id")
    batch = pa.RecordBatch.from_pydict({"id": [i for i, _ in rows], "text": [t for _, t in rows]})
    out = list(seen[0](iter([batch])))
    assert sum(map(len, out)) == len(rows) and max(len(b.column(1).flatten()) for b in out) <= 150


def test_wide_signature_agrees_for_equal_texts_only(spark):
    df = spark.createDataFrame([("abcdefgh",), ("abcdefgh",), ("hgfedcba",)], "text string").coalesce(1)
    a, b, c = [r[0] for r in df.select(minhash.signature(F.col("text"), hashes=8, wide=True)).collect()]
    assert a == b != c and max(a) < 2**62


def near_copies(rng, base, count):
    for _ in range(count):
        at = rng.randrange(len(base))
        yield base[:at] + rng.choice("xyz") + base[at + 1 :]


def corpus(copies=40):
    rng = random.Random(5)
    text = lambda: "".join(rng.choice("abcdefghij klmnop") for _ in range(1500))
    hot = text()
    rows = [hot, *near_copies(rng, hot, copies), *[text() for _ in range(10)], "tiny"]
    return list(enumerate(rows))


@pytest.mark.parametrize("rows_per_slice", [3, 1_000_000])
def test_candidates_do_not_depend_on_slicing(spark, scratch, rows_per_slice):
    df = docs(spark, corpus())
    edges = fuzzy.candidate_edges(df, CONFIG, scratch, rows_per_slice=rows_per_slice)
    assert {r.dst for r in edges.collect()} == set(range(1, 41))


def test_fuzzy_dedup(spark, scratch):
    df = docs(spark, corpus())
    kept = fuzzy.fuzzy_dedup(df, CONFIG, scratch)
    assert ids(kept) == [0, *range(41, 52)]
    assert ids(fuzzy.fuzzy_dedup(kept, CONFIG, scratch)) == ids(kept)
    again = fuzzy.fuzzy_dedup(df.orderBy(F.desc("id")), CONFIG, scratch)
    assert ids(again) == ids(kept)


def test_false_positive_check_is_exact(spark, scratch):
    rows = corpus(copies=12)
    text = dict(rows)
    df = docs(spark, rows)
    config = fuzzy.FuzzyConfig(false_positive_check=True, jaccard_threshold=0.99)
    all_edges = fuzzy.candidate_edges(
        df, fuzzy.FuzzyConfig(false_positive_check=True, jaccard_threshold=0.0), scratch
    )
    candidates = {tuple(r) for r in all_edges.collect()}
    shingles = {i: {t[k : k + 5] for k in range(len(t) - 4)} for i, t in text.items()}
    jaccard = lambda a, b: len(shingles[a] & shingles[b]) / len(shingles[a] | shingles[b])
    got = {tuple(r) for r in fuzzy.candidate_edges(df, config, scratch, rows_per_slice=2).collect()}
    assert got == {e for e in candidates if jaccard(*e) >= 0.99}
    assert 0 < len(got) < len(candidates)


def union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_union_find(spark, scratch, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    edges += [(i, i + 1) for i in range(1000, 1040)] + [(5000, 5001 + i) for i in range(100)]
    df = spark.createDataFrame(edges, "src bigint, dst bigint")
    got = dict(map(tuple, connected_components(df, scratch, rows_per_slice=20).collect()))
    assert got == union_find([e for e in edges if e[0] != e[1]])


def test_components_of_nothing_and_round_limit(spark, scratch):
    empty = spark.createDataFrame([], "src bigint, dst bigint")
    assert connected_components(empty, scratch).count() == 0
    chain = spark.createDataFrame([(i, i + 1) for i in range(50)], "src bigint, dst bigint")
    with pytest.raises(RuntimeError):
        connected_components(chain, scratch, max_rounds=1)


def brute_semantic(ids_, vectors, cluster, sim, floor, order):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    best = {}
    rank = sorted(range(len(ids_)), key=lambda i: order(i))
    for at, i in enumerate(rank):
        sims = [unit[i] @ unit[j] for j in rank[:at] if cluster[j] == cluster[i]]
        if sims and max(sims) > floor:
            best[int(ids_[i])] = max(sims)
    return best


@pytest.mark.parametrize("keep", ["hard", "easy"])
@pytest.mark.parametrize("floor", [0.99, 0.5, -1.0])
def test_semantic_matches_brute_force(spark, scratch, keep, floor):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 8))
    ball = base[0] + rng.standard_normal((50, 8)) * 0.01
    vectors = np.concatenate([base, ball, base[:10]]).astype(np.float32)
    centroids = rng.standard_normal((2, 8))
    config = semantic.SemanticConfig(
        which_to_keep=keep, eps_to_extract=1 - floor, n_clusters=2, batched_cosine_similarity=7
    )
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "id bigint, embeddings array<float>").repartition(3)
    assigned = scratch.save(semantic.assign_clusters(df, centroids, "embeddings"), "assigned")
    table = {r.id: (r.cluster, round(r.centroid_sim, 9)) for r in assigned.collect()}
    sign = 1 if keep == "hard" else -1
    n = range(len(vectors))
    want = brute_semantic(
        list(n), vectors.astype(np.float64), [table[i][0] for i in n], None, floor,
        lambda i: (sign * table[i][1], i),
    )
    got = semantic.nearest_earlier(assigned, config, scratch, block=16).collect()
    assert {r.id for r in got} == set(want)
    assert all(abs(r.max_sim - want[r.id]) < 1e-6 for r in got)
    dropped = semantic.semantic_duplicates(assigned, config, scratch, block=16)
    assert sorted(r.id for r in dropped.collect()) == sorted(want)


def test_semantic_dedup_end_to_end(spark, scratch):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(6))) for i in range(10)]
    rows += [(100, rows[0][1]), (101, rows[1][1]), (102, None)]
    config = semantic.SemanticConfig(n_clusters=3, embedding_model_name_or_path=semantic.BUILT_IN)
    kept = semantic.semantic_dedup(docs(spark, rows), config, scratch)
    assert 102 in ids(kept) and 100 not in ids(kept) and 101 not in ids(kept)
    assert set(range(10)) <= set(ids(kept))


def test_own_encoder_gets_batches(spark):
    config = semantic.SemanticConfig(embedding_batch_size=2)
    encoder = lambda texts: np.array([[len(t), len(texts)] for t in texts])
    df = docs(spark, [(i, "x" * i) for i in range(1, 6)] + [(9, None)]).coalesce(1)
    out = {r.id: r.embeddings for r in semantic.embed(df, config, encoder=encoder).collect()}
    assert out[9] is None and out[3][0] == 3.0 and max(v[1] for v in out.values() if v) == 2.0


def test_no_silent_encoder(spark):
    for name in ("", "some/model"):
        with pytest.raises(ValueError, match="encoder"):
            semantic.embed(docs(spark, [(1, "a")]), semantic.SemanticConfig(embedding_model_name_or_path=name))
    with pytest.raises(ValueError, match="sim_metric"):
        semantic.train_centroids(spark.createDataFrame([(1, [1.0])], "id int, embeddings array<float>"), semantic.SemanticConfig(sim_metric="l2"))


BUILT_IN = semantic.SemanticConfig(n_clusters=4, embedding_model_name_or_path=semantic.BUILT_IN)


@pytest.mark.parametrize("texts", [["", " ", "", "\n", ""], ["", "  ", "", "", "", "one two", "three four", "one two"], [None, None], []])
def test_blank_documents_are_no_copies(spark, scratch, texts):
    kept = semantic.semantic_dedup(docs(spark, list(enumerate(texts))), BUILT_IN, scratch)
    expected = [i for i, t in enumerate(texts) if not (t or "").strip() or t not in texts[:i]]
    assert ids(kept) == expected


def test_one_cluster_and_more_clusters_than_items(spark, scratch):
    df = docs(spark, [(0, "a b c"), (1, "a b c"), (2, "d e f")])
    for n in (1, 1000):
        config = semantic.SemanticConfig(n_clusters=n, embedding_model_name_or_path=semantic.BUILT_IN)
        assert ids(semantic.semantic_dedup(df, config, scratch)) == [0, 2]


def test_embeddings_are_written_in_the_files_asked_for(spark, scratch, tmp_path):
    config = semantic.SemanticConfig(n_clusters=2, num_files=3, embedding_model_name_or_path=semantic.BUILT_IN)
    df = docs(spark, [(i, f"text {i}") for i in range(30)])
    semantic.semantic_duplicate_ids(df, config, scratch, embeddings_path=str(tmp_path / "e"))
    assert len(list((tmp_path / "e").glob("part-*"))) == 3 and spark.read.parquet(str(tmp_path / "e")).count() == 30


def test_pivots_compare_far_fewer_pairs_and_find_all(spark, scratch):
    """100,000 vectors of one cluster, spread as real ones are: widely along few directions."""
    rng = np.random.default_rng(1)
    n, d = 100_000, 32
    scale = 1 / np.arange(1, d + 1)
    vectors = (rng.standard_normal((n, d)) * scale).astype(np.float32)
    vectors[n // 2 : n // 2 + 2000] = vectors[:2000] * (1 + 0.002 * rng.standard_normal((2000, d)).astype(np.float32))
    table = spark.createDataFrame(
        [(i, 0, 0.0, v.tolist()) for i, v in enumerate(vectors)], "id bigint, cluster int, key double, vector array<float>"
    )
    items = scratch.save(table.repartition(8), "items")
    floor = 0.99
    met = semantic.meeting(items, items, floor, scratch, block=2048)
    compared = met.grid.agg(F.sum(F.col("probe_rows").cast("double") * F.col("item_rows"))).first()[0]
    assert compared < n * n / 8
    units = vectors.astype(np.float64) / np.linalg.norm(vectors, axis=1, keepdims=True)
    sims = units[n // 2 : n // 2 + 300] @ units.T
    homes = {r.id: r.cell for r in met.items.select("id", "cell").collect()}
    looks = {}
    for r in met.probes.where(F.col("id").between(n // 2, n // 2 + 299)).select("id", "cell").collect():
        looks.setdefault(r.id, []).append(r.cell)
    pairs = [(n // 2 + a, b) for a, b in zip(*np.nonzero(sims > floor), strict=True)]
    assert len(pairs) > 300
    for a, b in pairs:
        assert looks[a].count(homes[int(b)]) == 1


def test_no_vector_is_written_once_more_for_each_pair(spark, scratch, monkeypatch):
    """vectors were sent to every cell they look into, and there to every block of the others."""
    rng = np.random.default_rng(4)
    n, d, block = 1500, 12, 64
    vectors = rng.standard_normal((n, d)) * (0.25 / np.arange(1, d + 1))
    vectors[:, 0] += 1
    vectors[n - 100 :] = vectors[:100] * (1 + 0.01 * rng.standard_normal((100, d)))
    vectors = vectors.astype(np.float32)
    # Two small clusters beside the large one, and keys that many items share.
    cluster = [0 if i % 10 else 1 + i % 20 // 10 for i in range(n)]
    sims = np.round(rng.random(n), 2)
    rows = [(i, c, float(s), v.tolist()) for i, (c, s, v) in enumerate(zip(cluster, sims, vectors, strict=True))]
    assigned = spark.createDataFrame(rows, "id bigint, cluster int, centroid_sim double, embeddings array<float>").repartition(3)
    tables, save = {}, scratch.save

    def kept(df, name, *rest):
        tables[name] = (save(df, name, *rest), df._jdf.queryExecution().executedPlan().toString())
        return tables[name][0]

    monkeypatch.setattr(scratch, "save", kept)
    config = semantic.SemanticConfig(eps_to_extract=0.01, batched_cosine_similarity=32)
    found = [r.id for r in semantic.semantic_duplicates(assigned, config, scratch, block=block).collect()]
    want = brute_semantic(list(range(n)), vectors.astype(np.float64), cluster, None, 0.99, lambda i: (sims[i], i))
    assert sorted(found) == sorted(want) and len(want) > 100
    for name, (table, _) in tables.items():
        if "vector" in table.columns:
            assert table.count() <= n, name
    packs, _ = tables["packs"]
    assert packs.agg(F.sum(F.size("ids"))).first()[0] == n and packs.agg(F.max(F.size("ids"))).first()[0] <= block
    assert "CartesianProduct" in tables["compared"][1] and "Exchange" not in tables["compared"][1]


def test_bands_go_with_the_groups_found(spark, scratch, monkeypatch):
    made, save = [], Scratch.save

    def kept(self, df, name, *rest):
        table = save(self, df, name, *rest)
        made.append((name, self._tables[id(table)][1]))
        return table

    monkeypatch.setattr(Scratch, "save", kept)
    df = docs(spark, [(0, "one two three four five six"), (1, "one two three four five six"), (2, "quite another text")])
    groups = fuzzy.duplicate_groups(df, fuzzy.FuzzyConfig(), scratch)
    assert sorted(tuple(r) for r in groups.collect()) == [(0, 0), (1, 0)]
    gone = {name: not exists(spark, path) for name, path in made}
    assert gone["bands"] and gone["buckets"] and gone["linked"]


def exists(spark, path):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)
