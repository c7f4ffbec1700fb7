"""One query per operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import (
    decontaminate,
    extract,
    licences,
    lines,
    merkle,
    mixing,
    near_dedup,
    prefix_trie,
    quality,
    secrets,
    substrings,
    tokens_out,
    warc,
)
from corpusloom.llm.common import ascii_lower
from corpusloom.scratch import Scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract.extract(table(spark, sf_dir, "pages"), Scratch(spark))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    bits = F.col("ledger.fail_bits")
    return quality.ledger(docs).select(
        "doc_id",
        "ledger.n_words",
        "ledger.word_chars",
        "ledger.n_symbols",
        "ledger.n_dup_lines",
        "ledger.n_repeat_words",
        (~quality.passes(bits, "base-1")).alias("base_failed"),
        quality.passes(bits, "web-1").alias("kept"),
        bits.alias("fail_bits"),
    )


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Scratch(spark)
    )
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    path = f"{scratch.root}/warc"
    warc.write_archive(warc.records(table(spark, sf_dir, "pages"), scratch), path, compression="gzip")
    read = warc.read_archive(spark, path).where(F.col("record_type").isin("response", "revisit"))
    response = F.col("record_type") == "response"
    return read.select(
        warc.page_of(F.col("record_id")).cast("bigint").alias("page_id"),
        F.when(response, F.octet_length("payload").cast("bigint")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(response, F.sha2("payload", 256)).otherwise(F.substring_index("payload_digest", ":", -1)).alias("payload_digest"),
        "record_type",
        warc.page_of(F.col("refers_to")).cast("bigint").alias("refers_to"),
    )


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return lines.drop_site_lines(docs, Scratch(spark)).select("doc_id", "n_lines", "n_dropped", "text")


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licences.scan(docs, licences.known_digests(spark), Scratch(spark))
    return found.select(
        "doc_id",
        F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda x: x["license"]))), ",").alias("licenses"),
        F.size(F.filter("found", lambda x: x["line"] > 0)).cast("bigint").alias("n_notices"),
        F.get(F.transform(F.filter("found", lambda x: x["line"] == 0), lambda x: x["license"]), F.lit(0)).alias("whole_text"),
    )


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    drawn = mixing.mix(docs, Scratch(spark), epoch="epoch", key="order_key")
    return drawn.select("doc_id", "source", "epoch", "order_key")


@query
def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    return tokens_out.materialise(table(spark, sf_dir, "documents"), scratch, f"{scratch.root}/shards")


@query
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = near_dedup.NearConfig(width=3, percent=85, least_agreement=0.65)
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"), Scratch(spark), config)
    return found.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


@query
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", secrets.secret_spans(F.col("text")).alias("s"))
    base = F.filter("s", lambda s: ~s["linked"])
    of = lambda kind: F.size(F.filter("s", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        of("assign").alias("n_assign"),
        of("access").alias("n_access"),
        of("hex").alias("n_hex"),
        F.sha2(secrets.span_list(base), 256).alias("base_sha256"),
        secrets.span_list(F.col("s")).alias("spans"),
    )


@query
def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.drop_repeated_passages(table(spark, sf_dir, "documents"), Scratch(spark))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars"]
    leaf = merkle.leaf_digest(*[F.col(c) for c in fields], F.col("text"))
    tampered = merkle.leaf_digest(*[F.col(c) for c in fields], ascii_lower(F.col("text")))
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = merkle.manifest(docs, Scratch(spark), leaf, F.when(chosen, tampered))
    return found.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    turns = prefix_trie.read_turns(table(spark, sf_dir, "conversations"), scratch)
    opening = F.crc32(F.col("conv").cast("string").cast("binary")) % 4
    return prefix_trie.trie(*prefix_trie.with_shared_openings(turns, scratch, opening), scratch)
