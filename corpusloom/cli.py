"""Command line: ``spark-submit -m corpusloom.cli JOB ...`` or ``python -m corpusloom.cli JOB ...``."""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.pii import ACTIONS
from corpusloom.functions.prompts import PROMPT_TEMPLATE
from corpusloom.operators import packing, sft, tokens
from corpusloom.operators.fuzzy import FuzzyConfig
from corpusloom.operators.ids import ensure_id
from corpusloom.operators.language import ngram_profiles, profile_scorer
from corpusloom.operators.sampling import split_by_weight
from corpusloom.operators.semantic import SemanticConfig
from corpusloom.plans.config import CurationConfig, from_yaml
from corpusloom.plans.curate import Models, curate, pii_key
from corpusloom.scratch import Scratch
from corpusloom.sources import documents, wiki

REWARD_KEY_VARIABLE = "REWARD_API_KEY"


def accepted_records(
    spark: SparkSession, scratch: Scratch, paths: str, schema: str, reject_dir: str, with_id: bool = True
) -> DataFrame:
    """Whole records, with ids if asked for; lines that are none go to ``reject_dir`` and are counted."""
    df = documents.read_records(spark, paths, schema)
    df = ensure_id(df, scratch, fill=True) if with_id else scratch.save(df, "records")
    for row in documents.write_rejected(df, reject_dir).sort("file_name").toLocalIterator():
        print(f"{row['file_name']}: {row['lines']} lines are no records, see {reject_dir}")
    return documents.accepted(df)


def load_encoder(name: str) -> Callable:
    """``MODULE:FUNCTION``, a function from a list of texts to one vector each."""
    module, _, attribute = name.partition(":")
    if not attribute:
        raise ValueError(f"{name!r} is not MODULE:FUNCTION")
    return getattr(importlib.import_module(module), attribute)


def run_curate(spark: SparkSession, args: argparse.Namespace) -> None:
    schema = documents.document_schema(args.text_field, "id", args.extra_fields)
    scratch = Scratch(spark)
    df = accepted_records(spark, scratch, args.input_dir, schema, args.reject_dir or f"{args.output_dir}/rejected")
    config = CurationConfig(
        **{
            name: getattr(args, name)
            for name in (
                "text_field", "language", "cleaning", "lid", "heuristic", "heuristic_min_words",
                "pii", "pii_anonymize_action", "exact", "fuzzy", "semantic",
            )
        },
        pii_entities=tuple(args.pii_entities),
        pii_patterns=tuple(tuple(p.split("=", 1)) for p in args.pii_pattern),
    )
    if args.fuzzy_config:
        config = replace(config, fuzzy_config=from_yaml(FuzzyConfig, args.fuzzy_config))
    if args.semantic_config:
        config = replace(config, semantic_config=from_yaml(SemanticConfig, args.semantic_config))
    scorer = None
    if args.lid:
        labelled = spark.read.schema("text string, lang string").json(args.lid_samples)
        scorer = profile_scorer(ngram_profiles(labelled))
    key = pii_key(spark, args.pii_key_file) if args.pii_key_file else None
    encoder = load_encoder(args.encoder) if args.encoder else None
    curate(df, config, scratch, Models(scorer, encoder, key), args.output_dir)
    scratch.close()


def run_score_sft(spark: SparkSession, args: argparse.Namespace) -> None:
    schema = f"`{args.context_field}` string, `{args.response_field}` string"
    scratch = Scratch(spark)
    pairs = accepted_records(
        spark, scratch, args.input_path, schema, args.reject_dir or f"{args.output_dir}/rejected", with_id=False
    ).drop("file_name")
    client = sft.openai_reward_client(args.endpoint, args.model, REWARD_KEY_VARIABLE)
    scored = sft.score_pairs(pairs, client, args.context_field, args.response_field)
    documents.dual_sink(sft.with_overall(scored), args.output_dir, scratch, args.filter_field, args.threshold)
    scratch.close()


def run_wiki(spark: SparkSession, args: argparse.Namespace) -> None:
    articles = wiki.read_dump(spark, args.dumps, args.language, args.url_limit)
    documents.write_by_source(articles, args.output_dir)


def run_qa(spark: SparkSession, args: argparse.Namespace) -> None:
    for split in ("train", "validation", "test"):
        scratch = Scratch(spark)
        reject_dir = f"{args.output_dir}/rejected_{split}"
        path = f"{args.input_dir}/{split}.jsonl"
        rows = accepted_records(spark, scratch, path, documents.QA_SCHEMA, reject_dir, with_id=False)
        pairs = sft.qa_to_sft(rows, F.col("context"), F.col("question"), F.col("answer.text"))
        pairs.write.mode("overwrite").json(f"{args.output_dir}/{split}.jsonl")
        scratch.close()


def run_tokenize(spark: SparkSession, args: argparse.Namespace) -> None:
    schema = documents.document_schema(args.text_field, "id")
    scratch = Scratch(spark)
    df = accepted_records(spark, scratch, args.input_dir, schema, args.reject_dir or f"{args.output_dir}_rejected")
    df = df.drop(documents.RECORD)
    tokenizer = tokens.pretrained_tokenizer(spark, args.tokenizer)
    out = tokens.tokenize(df, tokenizer, args.text_field, eod_id=args.eod_id).drop(args.text_field)
    documents.write_tokens(split_by_weight(out, args.split), args.output_dir)
    written = spark.read.parquet(args.output_dir)
    steps = tokens.epoch_steps(written, args.seq_length, args.global_batch_size)
    tokens.total_steps(steps).show()
    scratch.close()


def run_prepare_sft(spark: SparkSession, args: argparse.Namespace) -> None:
    scratch = Scratch(spark)
    pairs = ensure_id(documents.read_splits(spark, args.dataset_dir), scratch)
    template = PROMPT_TEMPLATE
    if args.prompt_template_file:
        template = "\n".join(r[0] for r in spark.read.text(args.prompt_template_file).collect())
    tokenizer = tokens.pretrained_tokenizer(spark, args.tokenizer)
    examples = sft.tokenize_pairs(pairs, tokenizer, template, args.eod_id)
    packed = packing.packed_sequences(examples, args.seq_length, scratch, group_by=["split"])
    packed.write.partitionBy("split").mode("overwrite").parquet(args.output_dir)
    scratch.close()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(formatter_class=argparse.ArgumentDefaultsHelpFormatter)
    jobs = top.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("curate", help="clean, filter, anonymise and deduplicate documents")
    job.set_defaults(run=run_curate)
    job.add_argument("--input-dir", required=True)
    job.add_argument("--output-dir", required=True)
    job.add_argument("--text-field", default="text")
    job.add_argument("--extra-fields", default="", help="other fields as columns, as DDL; all fields are kept")
    job.add_argument("--reject-dir", help="for lines that are no records; OUTPUT_DIR/rejected if not given")
    job.add_argument("--language", default="")
    for switch in ("cleaning", "lid", "heuristic", "pii", "exact", "fuzzy", "semantic"):
        job.add_argument(f"--{switch}", action="store_true")
    job.add_argument("--lid-samples", help="JSON lines with text and lang, to learn languages from")
    job.add_argument("--heuristic-min-words", type=int, default=50)
    job.add_argument("--pii-entities", nargs="+", default=list(CurationConfig.pii_entities))
    job.add_argument("--pii-anonymize-action", choices=ACTIONS, default="replace")
    job.add_argument("--pii-pattern", action="append", default=[], metavar="ENTITY=REGEX", help="a further entity")
    job.add_argument("--pii-key-file", help="file with the AES key in hex, for encrypt")
    job.add_argument("--fuzzy-config")
    job.add_argument("--semantic-config")
    job.add_argument("--encoder", metavar="MODULE:FUNCTION", help="texts to vectors, for the configured model")

    job = jobs.add_parser("score-sft", help="score instruction pairs and keep the good ones")
    job.set_defaults(run=run_score_sft)
    job.add_argument("--endpoint", required=True)
    job.add_argument("--model", required=True)
    job.add_argument("--input-path", required=True)
    job.add_argument("--output-dir", required=True)
    job.add_argument("--context-field", default="input")
    job.add_argument("--response-field", default="output")
    job.add_argument("--reject-dir", help="for lines that are no records; OUTPUT_DIR/rejected if not given")
    job.add_argument("--filter-field", choices=(*sft.METRICS, "overall"), default="overall")
    job.add_argument("--threshold", type=float, default=3.5)

    job = jobs.add_parser("wiki", help="articles of wiki XML dumps as JSON lines")
    job.set_defaults(run=run_wiki)
    job.add_argument("--dumps", required=True, help="glob of dump files")
    job.add_argument("--output-dir", required=True)
    job.add_argument("--language", default="zh-classical")
    job.add_argument("--url-limit", type=int, default=None, help="number of dump files to read")

    job = jobs.add_parser("qa", help="question-answer rows as instruction pairs")
    job.set_defaults(run=run_qa)
    job.add_argument("--input-dir", required=True)
    job.add_argument("--output-dir", required=True)

    job = jobs.add_parser("tokenize", help="token ids with end marks, splits and epoch steps")
    job.set_defaults(run=run_tokenize)
    job.add_argument("--input-dir", required=True)
    job.add_argument("--output-dir", required=True)
    job.add_argument("--text-field", default="text")
    job.add_argument("--reject-dir", help="for lines that are no records; OUTPUT_DIR_rejected if not given")
    job.add_argument("--tokenizer", required=True, help="tokenizer.json")
    job.add_argument("--eod-id", type=int, default=tokens.EOD_ID)
    job.add_argument("--split", default="998,1,1")
    job.add_argument("--seq-length", type=int, default=8192)
    job.add_argument("--global-batch-size", type=int, default=2048)

    job = jobs.add_parser("prepare-sft", help="instruction pairs as packed training sequences, by split")
    job.set_defaults(run=run_prepare_sft)
    job.add_argument("--dataset-dir", required=True, help="with training.jsonl, validation.jsonl, test.jsonl")
    job.add_argument("--output-dir", required=True)
    job.add_argument("--tokenizer", required=True, help="tokenizer.json")
    job.add_argument("--prompt-template-file", help="text with {input} and {output}; a chat template if not given")
    job.add_argument("--eod-id", type=int, default=None)
    job.add_argument("--seq-length", type=int, default=8192)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"corpusloom-{args.job}").getOrCreate()
    args.run(spark, args)


if __name__ == "__main__":
    main()
