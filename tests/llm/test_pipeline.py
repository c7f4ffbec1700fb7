"""Every stage of the pipeline on its own input, against SQL or brute force."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
import duckdb
import pytest

from corpusloom.llm import oracle, tokens_out

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def sql(name, documents):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SF}/benchmark.parquet'")
    duck.register("documents", documents)
    return duck.execute(oracle.SQL[name]).df()


def shingles(text, width=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def first_of_groups(rows):
    """Ids that are the smallest of all that links lead to."""
    sets = {r["doc_id"]: shingles(r["text"]) for r in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            shared = len(sets[a] & sets[b])
            if sets[a] and 100 * shared >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i for i in ids if find(i) == i}


def test_each_stage_and_the_run(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.toPandas()
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        after = docs.toPandas()
        if name != "token_shards":
            assert list(after.columns) == COLUMNS
            texts = dict(zip(before["doc_id"], before["text"], strict=True))
            assert all(texts[i] == t for i, t in zip(after["doc_id"], after["text"], strict=True))
        got = Counter(after["doc_id"]) if "doc_id" in after else None
        if name == "quality_rules":
            marked = sql("op2_quality_rules", before)
            assert got == Counter(marked[marked["kept"]]["doc_id"])
        elif name == "near_duplicates":
            assert got == Counter(first_of_groups(before.to_dict("records")))
        elif name == "benchmark_decontamination":
            marked = sql("op3_decontaminate", before)
            assert got == Counter(marked[~marked["contaminated"]]["doc_id"])
        elif name == "source_mixing":
            assert got == Counter(sql("op7_mixing", before)["doc_id"])
        else:
            config = tokens_out.TokenConfig()
            known = tokens_out.encoder(config)
            total = sum(len(known.encode_ordinary(t)) + 1 for t in before["text"] if t)
            assert after["n_tokens"].sum() == total
            assert sorted(after["slot"]) == sorted(after["sequence"]) == list(range(-(-total // config.length)))
        assert 0 < len(after) < len(before) or name in ("source_mixing", "token_shards")
    run = corpus_pipeline.run(spark, SF).toPandas()
    assert run["n_tokens"].sum() == after["n_tokens"].sum() and len(run) == len(after)


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None), (1, "", None, "", 0), (1, "", None, "", 0)]])
def test_stages_take_empty_tables_and_empty_texts(spark, tmp_path, rows):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    docs = spark.createDataFrame(rows, schema)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert docs.count() == 0  # the quality rules let no empty text pass
