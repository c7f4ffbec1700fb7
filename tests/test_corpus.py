from __future__ import annotations

import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import prompts, vectors
from corpusloom.operators import ids, language, ordering, packing, sampling, sft, tokens


def test_ids_are_dense_in_order(spark, scratch):
    df = spark.range(0, 500, numPartitions=7).select((F.col("id") * 37 % 500).alias("k"))
    out = ids.ensure_id(df, scratch, order_by=["k"]).orderBy("k").collect()
    assert [r.id for r in out] == [f"id-{i:010d}" for i in range(500)]


def test_ids_without_an_order_are_dense_and_unique(spark, scratch):
    df = spark.range(0, 300, numPartitions=5).select(F.col("id").alias("k"))
    got = sorted(r.id for r in ids.ensure_id(df, scratch).collect())
    assert got == [f"id-{i:010d}" for i in range(300)]
    assert ids.ensure_id(df.withColumn("id", F.lit("x")), scratch).columns == ["k", "id"]


def test_long_ids_keep_all_digits(spark):
    row = spark.range(1).select(ids.format_id(F.lit(12345678901)).alias("x")).first()
    assert row.x == "id-12345678901"


@pytest.mark.parametrize("partitions", ["1", "6"])
def test_running_sum_with_a_hot_group(spark, scratch, partitions):
    rng = random.Random(1)
    rows = [(rng.choice("aaaaab"), i, rng.randrange(9)) for i in range(400)] + [(None, 1, 5), (None, 2, 6)]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "g string, i int, v int").repartition(5)
        out = ordering.running_sum(df, "v", ["i"], scratch, ["g"])
        got = {(r.g, r.i): r.running for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sums, want = {}, {}
    for g, i, v in sorted(rows, key=lambda r: r[1]):
        sums[g] = want[g, i] = sums.get(g, 0) + v
    assert got == want


def documents(spark):
    texts = ["the cat sat", "the dog", "", None, "the the unseen"]
    rows = [(i, "f" if i < 4 else "g", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "id bigint, file_name string, text string")


def test_vocabulary_and_both_tokenisers(spark, scratch):
    df = documents(spark)
    vocab = tokens.build_vocab(df, 3, scratch)
    assert [(r.token, r.token_id) for r in vocab.orderBy("token_id").collect()] == [
        ("the", 2), ("cat", 3), ("dog", 4),
    ]
    local = tokens.tokenize(df, tokens.vocab_tokenizer(vocab))
    want = {0: [2, 3, 1, 0], 1: [2, 4, 0], 2: [0], 3: [0], 4: [2, 2, 1, 0]}
    assert {r.id: r.token_ids for r in local.collect()} == want
    for rows in (1, 1_000_000):
        joined = tokens.tokenize_by_join(df, vocab, scratch, rows_per_slice=rows)
        assert {r.id: r.token_ids for r in joined.collect()} == want
    bare = tokens.tokenize(df, tokens.vocab_tokenizer(vocab), append_eod=False)
    assert {r.id: r.n_tokens for r in bare.collect()} == {0: 3, 1: 2, 2: 0, 3: 0, 4: 3}


def test_windows_and_samples(spark, scratch):
    rng = random.Random(4)
    streams = {f: [[rng.randrange(100) for _ in range(rng.randrange(1, 40))] for _ in range(12)] for f in "ab"}
    rows = [(i + 100 * (f == "b"), f, d, len(d)) for f, ds in streams.items() for i, d in enumerate(ds)]
    df = spark.createDataFrame(rows, "id bigint, file_name string, token_ids array<int>, n_tokens int")
    windows = tokens.sequence_windows(df, 16, scratch)
    samples = tokens.sequence_samples(df.select("id", "token_ids"), windows, 16).collect()
    for f, ds in streams.items():
        flat = [t for d in ds for t in d]
        got = [r.token_ids for r in sorted((r for r in samples if r.file_name == f), key=lambda r: r.sample)]
        assert got == [flat[i : i + 16] for i in range(0, len(flat), 16)]


def test_epoch_steps_round_up_per_file(spark):
    df = spark.createDataFrame([("a", 10), ("a", 7), ("b", 1)], "file_name string, n_tokens int")
    steps = tokens.epoch_steps(df, seq_length=4, global_batch_size=2)
    assert sorted(map(tuple, steps.collect())) == [("a", 34, 3), ("b", 2, 1)]
    assert tuple(tokens.total_steps(steps).first()) == (2, 4)
    sizes = spark.createDataFrame([("a", 16 * 2), ("b", 16 * 2 + 1)], "file_name string, bytes bigint")
    assert sorted(r.steps for r in tokens.steps_from_files(sizes, 4, 4).collect()) == [1, 2]


def test_vocabulary_cuts_at_the_histogram(spark, scratch):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randrange(1, 4) for _ in range(rng.randrange(30))) for _ in range(60)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string").repartition(3)
    counts = Counter(w for t in texts for w in t.split())
    ranked = sorted(counts, key=lambda w: (-counts[w], w))
    for size in (1, 2, 17, 40, len(ranked), 10_000):
        got = {r.token: (r["count"], r.token_id) for r in tokens.build_vocab(df, size, scratch).collect()}
        assert got == {w: (counts[w], 2 + i) for i, w in enumerate(ranked[:size])}
    assert tokens.build_vocab(df.limit(0), 5, scratch).count() == 0
    vocab = tokens.build_vocab(df, 10, scratch)
    with pytest.raises(ValueError, match="tokenize_by_join"):
        tokens.vocab_tokenizer(vocab, max_tokens=9)


def test_tokens_by_join_over_several_blocks(spark, scratch, monkeypatch):
    monkeypatch.setattr(tokens, "CODED_TOKENS", 20)
    rows = [(i, " ".join(f"t{k % (i + 1)}" for k in range(i % 13))) for i in range(50)] + [(7, "t0 t1"), (None, "t0"), (99, None)]
    df = spark.createDataFrame(rows, "id long, text string").repartition(2)
    vocab = scratch.save(tokens.build_vocab(df, 4, scratch), "vocab")
    local = tokens.tokenize(df, tokens.vocab_tokenizer(vocab)).select("id", "token_ids", "n_tokens")
    joined = tokens.tokenize_by_join(df, vocab, scratch)
    key = lambda r: (r.id is not None, r.id or 0, r.token_ids)
    assert sorted(joined.collect(), key=key) == sorted(local.collect(), key=key)
    assert tokens.tokenize_by_join(df.limit(0), vocab, scratch).count() == 0


def test_splits(spark):
    df = sampling.split_by_weight(spark.range(3000), "8,1,1")
    counts = {r.split: r["count"] for r in df.groupBy("split").count().collect()}
    assert sum(counts.values()) == 3000 and abs(counts["train"] - 2400) < 150
    with pytest.raises(ValueError):
        sampling.parse_weights("0,0,0")


def test_blend(spark):
    df = spark.range(12000).select("id", F.when(F.col("id") < 10000, "a").otherwise("b").alias("file_name"))
    equal = sampling.blend_sources(df, ["a", "b"])
    counts = {r.file_name: r["count"] for r in equal.groupBy("file_name").count().collect()}
    assert counts["b"] == 2000 and abs(counts["a"] - 2000) < 200
    weighted = sampling.blend_sources(df, {"a": 3, "b": 1, "missing": 1})
    counts = {r.file_name: r["count"] for r in weighted.groupBy("file_name").count().collect()}
    assert counts["b"] == 2000 and abs(counts["a"] - 6000) < 250


def test_blend_rate_of_a_very_common_source_is_not_rounded_away(spark):
    df = spark.range(3_000_001).select("id", F.when(F.col("id") > 0, "a").otherwise("b").alias("file_name"))
    rates = {r.file_name: r.rate for r in sampling.blend_rates(df, ["a", "b"], "file_name").collect()}
    assert rates == {"a": 1 / 3_000_000, "b": 1.0}


def test_null_ids_get_a_split(spark):
    df = spark.createDataFrame([(None,), ("x",)], "id string")
    assert {r.split for r in sampling.split_by_weight(df, "1,1,1").collect()} <= set(sampling.SPLITS)


def test_a_turn_without_text_keeps_its_place(spark):
    turns = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", None)], "conv_id int, turn int, role string, text string")
    (row,) = sft.render_conversations(turns).collect()
    assert row.conversation.endswith("<|start_header_id|>assistant<|end_header_id|>\n\n<|eot_id|>")


def test_preview_is_a_growing_subset(spark):
    part = lambda f: {r.id for r in sampling.sample_preview(spark.range(1000), f).collect()}
    assert part(0.1) < part(0.3) < part(1.0) == set(range(1000))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(0, 450), min_size=1, max_size=60))
def test_packing_keeps_to_the_capacity_and_every_token(spark, sizes):
    df = spark.createDataFrame(list(enumerate(sizes)), "id int, n_tokens int")
    out = packing.pack_ffd(df, 100, shard_rows=20).collect()
    bins = {}
    for r in out:
        bins[r.shard, r.bin] = bins.get((r.shard, r.bin), 0) + r.size
        assert r.size == r.to - r["from"]
    assert max(bins.values()) <= 100
    for i, size in enumerate(sizes):
        parts = sorted((r.part, r["from"], r.to) for r in out if r.id == i)
        assert [p for p, _, _ in parts] == list(range(max(1, -(-size // 100))))
        assert [t for p, a, b in parts for t in range(a, b)] == list(range(size))


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 100), max_size=80))
def test_first_fit_is_the_first(sizes):
    free, want = [], []
    for size in sizes:
        b = next((k for k, room in enumerate(free) if room >= size), len(free))
        if b == len(free):
            free.append(100)
        free[b] -= size
        want.append(b)
    assert packing.first_fit(np.array(sizes, dtype=np.int64), 100).tolist() == want


def test_first_fit_of_many_bins_is_quick():
    import time

    start = time.time()
    assert packing.first_fit(np.full(200_000, 60), 100).tolist() == list(range(200_000))
    assert time.time() - start < 10


def test_packed_sequences_give_the_examples_back(spark, scratch):
    rng = random.Random(2)
    rows = [(i, i % 2, [1000 * i + k for k in range(rng.randrange(0, 45))]) for i in range(60)]
    df = spark.createDataFrame([(i, g, t, min(len(t), i % 9), len(t)) for i, g, t in rows], "id long, split int, token_ids array<int>, n_prompt int, n_tokens int")
    out = packing.packed_sequences(df, 20, scratch, group_by=["split"], shard_rows=25).collect()
    back, loss = {}, {}
    for r in out:
        assert len(r.token_ids) == len(r.loss_mask) == sum(p["size"] for p in r.pieces) <= 20
        for p in r.pieces:
            back[p.id, p.part] = (r.split, r.token_ids[p.start : p.start + p["size"]])
            loss[p.id] = loss.get(p.id, 0) + sum(r.loss_mask[p.start : p.start + p["size"]])
    for i, g, t in rows:
        parts = [back[i, k] for k in range(max(1, -(-len(t) // 20)))]
        assert [x for _, part in parts for x in part] == t and {s for s, _ in parts} == {g}
        assert loss[i] == len(t) - min(len(t), i % 9)
    assert packing.packed_sequences(df.limit(0), 20, scratch, group_by=["split"]).count() == 0


def test_an_example_without_size_is_one_empty_part(spark):
    df = spark.createDataFrame([("a", None), ("b", 5000)], "id string, n_tokens int")
    rows = packing.pack_ffd(df, 2048).collect()
    assert sorted((r.id, r.part, r["from"], r.to) for r in rows) == [("a", 0, 0, 0), ("b", 0, 0, 2048), ("b", 1, 2048, 4096), ("b", 2, 4096, 5000)]
    assert packing.pack_ffd(df.limit(0), 2048).count() == 0


def test_pack_by_offset(spark, scratch):
    df = spark.createDataFrame([(i, 30) for i in range(10)], "id int, n_tokens int")
    out = packing.pack_by_offset(df, 100, ["id"], scratch).orderBy("id").collect()
    assert [r.bin for r in out] == [i * 30 // 100 for i in range(10)]


def test_qa_pairs_and_prompt(spark):
    df = spark.createDataFrame([("　 c 100% \n", " q", (" a ",))], "context string, question string, answer struct<text: string>")
    row = sft.render_prompts(
        sft.qa_to_sft(df, F.col("context"), F.col("question"), F.col("answer.text"))
    ).first()
    assert (row.input, row.output) == ("c 100%\n\nq", "a")
    assert row.prompt == prompts.PROMPT_TEMPLATE.format(input=row.input, output=row.output)
    with pytest.raises(ValueError):
        prompts.render_prompt(F.lit("a"), F.lit("b"), "{output} {input}")


def test_conversations(spark):
    turns = spark.createDataFrame(
        [(1, 2, "user", "c"), (1, 0, "system", "a"), (1, 1, "user", "b"), (1, 3, "assistant", "d")],
        "conv_id int, turn int, role string, text string",
    )
    assert [tuple(r) for r in sft.turn_pairs(turns).collect()] == [(1, 2, "c", "d")]
    chat = sft.render_conversations(turns).first().conversation
    assert chat.startswith(prompts.CHAT_START + "<|start_header_id|>system<|end_header_id|>\n\na<|eot_id|>")
    assert [chat.index(f"\n\n{c}<") for c in "abcd"] == sorted(chat.index(f"\n\n{c}<") for c in "abcd")


def test_reward_scoring_and_strict_threshold(spark):
    metrics = sft.METRICS

    def scripted_client():
        calls = {"n": 0}

        def client(messages):
            calls["n"] += 1
            if calls["n"] == 1:
                raise ConnectionError("first call fails")
            size = float(len(messages[1]["content"]))
            return {m: size for m in metrics}

        return client

    rows = [("q", "x" * n) for n in (3, 4, 5)]
    df = spark.createDataFrame(rows, "input string, output string").coalesce(1)
    scored = sft.with_overall(sft.score_pairs(df, scripted_client, backoff=0.01))
    kept = sft.reward_filter(scored, "overall", 4.0)
    assert kept.columns == ["input", "output"] and [r.output for r in kept.collect()] == ["xxxxx"]
    assert sft.reward_filter(scored, "verbosity", 2.5).count() == 3
    with pytest.raises(ValueError):
        sft.reward_filter(scored, "charm")


def test_language_profiles_and_ties(spark):
    rows = [("the cat and the dog and the bird", "en"), ("der hund und die katze und der vogel", "de"), (None, "de"), ("x", None)]
    df = spark.createDataFrame(rows, "text string, lang string")
    profiles = language.ngram_profiles(df, top=50)
    assert profiles.groupBy("lang").agg(F.max("rank").alias("r")).where("r > 50").count() == 0
    scorer = language.profile_scorer(profiles, top=50)
    got = language.identify(df, scorer).select("text", "language.*").collect()
    assert [r.lang for r in got[:2]] == ["EN", "DE"] and got[0].score > 0.3
    # No text is as far from one language as from the other: the first code wins.
    assert (got[2].lang, got[2].score, got[2].distance) == ("DE", 0.0, 0)


def test_profile_counts_combine(spark):
    df = spark.createDataFrame([("aab", "x")] * 7, "text string, lang string").repartition(3)
    got = {r.gram: r.rank for r in language.ngram_profiles(df, top=3).collect()}
    assert got == {"a": 1, "aa": 2, "aab": 3}


def _peak(work):
    tracemalloc.start()
    try:
        found = work()
        return found, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_tokens_do_not_become_objects_each():
    lists = pa.array([[f"w{i % 100}" for i in range(200_000)], None, [], ["w1", "x"]])
    found, peak = _peak(lambda: tokens._numbered(lists, {f"w{i}": i + 2 for i in range(100)}))
    assert found.type == pa.list_(pa.int32())
    assert found.to_pylist() == [[i % 100 + 2 for i in range(200_000)], None, [], [3, tokens.UNKNOWN_ID]]
    # An object each would be 50 bytes and a reference.
    assert peak < 200_000 * 24


def test_texts_to_embed_become_objects_a_batch_at_a_time():
    texts = pa.array([None, *("word " * 2000 + str(i) for i in range(200)), None])
    encode = vectors.hashed_tokens(4, "mean_pooling")
    found, peak = _peak(lambda: vectors._encoded(texts, lambda part: [encode(t) for t in part], 8))
    assert found.is_null().to_pylist() == [True, *[False] * 200, True]
    assert found[5].as_py() == encode(texts[5].as_py()).astype("float32").tolist()
    assert peak < texts.nbytes / 2
