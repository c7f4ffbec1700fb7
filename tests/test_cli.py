from __future__ import annotations

import json

import pytest

from corpusloom import cli


def lines(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))


def test_curate_job(spark, tmp_path):
    text = " ".join(f"word{i}" for i in range(60))
    lines(tmp_path / "in" / "a.jsonl", [{"text": text + " a@b.org", "url": "u"}, {"text": "short"}])
    lines(tmp_path / "in" / "b.jsonl", [{"text": text + " c@d.org", "url": "v", "deep": {"a": [1, 2]}}])
    with (tmp_path / "in" / "b.jsonl").open("a") as file:
        file.write("{cut\n")
    (tmp_path / "fuzzy.yaml").write_text("seed: 42\nchar_ngrams: 5\nbuckets_per_shuffle: 1\n")
    cli.main([
        "curate", "--input-dir", str(tmp_path / "in"), "--output-dir", str(tmp_path / "out"),
        "--cleaning", "--heuristic", "--pii", "--exact", "--fuzzy", "--pii-pattern", r"NINE=\bword9\b",
        "--fuzzy-config", str(tmp_path / "fuzzy.yaml"),
    ])
    text = text.replace("word9 ", "<NINE> ")
    rows = spark.read.json(str(tmp_path / "out" / "fuzzy_dedup")).collect()
    assert [(r.id, r.text, r.file_name) for r in rows] in (
        [("id-0000000000", text + " <EMAIL_ADDRESS>", "a.jsonl")],
        [("id-0000000000", text + " <EMAIL_ADDRESS>", "b.jsonl")],
    )
    assert rows[0].word_count == 61 and rows[0].url in "uv"
    by_url = {r.url: r for r in spark.read.json(str(tmp_path / "out" / "cleaning")).collect()}
    assert by_url["v"].deep.a == [1, 2] and by_url["u"].deep is None
    assert (tmp_path / "out" / "rejected" / "file_name=b.jsonl").is_dir()
    assert not (tmp_path / "out" / "rejected" / "file_name=a.jsonl").exists()


def test_curate_job_with_an_encoder(spark, tmp_path, monkeypatch):
    (tmp_path / "letters.py").write_text("def two(texts):\n    return [[float(t.count('a')), float(t.count('b'))] for t in texts]\n")
    monkeypatch.syspath_prepend(str(tmp_path))
    spark.sparkContext.addPyFile(str(tmp_path / "letters.py"))
    texts = ["a a a a b", "b b b a", "a a a a b ", "x"]
    lines(tmp_path / "in" / "a.jsonl", [{"text": t} for t in texts])
    (tmp_path / "semantic.yaml").write_text("n_clusters: 2\nembedding_model_name_or_path: some/model\n")
    job = [
        "curate", "--input-dir", str(tmp_path / "in"), "--output-dir", str(tmp_path / "out"), "--semantic",
        "--semantic-config", str(tmp_path / "semantic.yaml"),
    ]
    with pytest.raises(ValueError, match="some/model"):
        cli.main(job)
    cli.main([*job, "--encoder", "letters:two"])
    assert sorted(r.text for r in spark.read.json(str(tmp_path / "out" / "semantic")).collect()) == ["a a a a b", "b b b a", "x"]


def test_qa_job(spark, tmp_path):
    for split in ("train", "validation", "test"):
        row = {"context": " c ", "question": "q", "answer": {"text": split}}
        lines(tmp_path / "in" / f"{split}.jsonl", [row])
    with (tmp_path / "in" / "test.jsonl").open("a") as file:
        file.write("[not a record]\n")
    cli.main(["qa", "--input-dir", str(tmp_path / "in"), "--output-dir", str(tmp_path / "out")])
    (row,) = spark.read.json(str(tmp_path / "out" / "test.jsonl")).collect()
    assert (row.input, row.output) == ("c\n\nq", "test")
    assert spark.read.text(str(tmp_path / "out" / "rejected_test")).first().value == "[not a record]"


def test_tokenize_job(spark, tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    tokenizer = Tokenizer(models.WordLevel({"[UNK]": 0, "a": 5, "b": 6}, unk_token="[UNK]"))
    tokenizer.pre_tokenizer = pre_tokenizers.Whitespace()
    tokenizer.save(str(tmp_path / "tokenizer.json"))
    lines(tmp_path / "in" / "x.jsonl", [{"id": "1", "text": "a b a"}, {"id": "2", "text": "c"}, {"id": "3"}])
    cli.main([
        "tokenize", "--input-dir", str(tmp_path / "in"), "--output-dir", str(tmp_path / "out"),
        "--tokenizer", str(tmp_path / "tokenizer.json"), "--eod-id", "9",
    ])
    got = {r.id: (r.token_ids, r.n_tokens, r.file_name) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"1": ([5, 6, 5, 9], 4, "x.jsonl"), "2": ([0, 9], 2, "x.jsonl"), "3": ([9], 1, "x.jsonl")}


def test_prepare_sft_job(spark, tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    tokenizer = Tokenizer(models.WordLevel({"[UNK]": 0, "Q": 1, "A": 2, "yes": 3, "no": 4}, unk_token="[UNK]"))
    tokenizer.pre_tokenizer = pre_tokenizers.Whitespace()
    tokenizer.save(str(tmp_path / "tokenizer.json"))
    (tmp_path / "template").write_text("Q {input}\nA {output}")
    lines(tmp_path / "in" / "training.jsonl", [{"input": "no", "output": "yes"}, {"input": "yes yes", "output": "no", "more": 1}])
    lines(tmp_path / "in" / "test.jsonl", [{"input": None, "output": "yes"}])
    cli.main([
        "prepare-sft", "--dataset-dir", str(tmp_path / "in"), "--output-dir", str(tmp_path / "out"), "--eod-id", "9",
        "--tokenizer", str(tmp_path / "tokenizer.json"), "--prompt-template-file", str(tmp_path / "template"), "--seq-length", "32",
    ])
    got = {r.split: (r.token_ids, r.loss_mask, len(r.pieces)) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {
        "train": ([1, 3, 3, 2, 4, 9, 1, 4, 2, 3, 9], [0, 0, 0, 0, 1, 1, 0, 0, 0, 1, 1], 2),
        "test": ([1, 2, 3, 9], [0, 0, 1, 1], 1),
    }


def test_wiki_and_score_arguments_parse():
    args = cli.parser().parse_args(["wiki", "--dumps", "d", "--output-dir", "o", "--language", "xx", "--url-limit", "3"])
    assert args.url_limit == 3
    args = cli.parser().parse_args([
        "score-sft", "--endpoint", "e", "--model", "m", "--input-path", "i", "--output-dir", "o",
    ])
    assert (args.filter_field, args.threshold) == ("overall", 3.5)
