"""Vocabulary, tokenisation and cutting of token streams into training samples."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import words
from corpusloom.operators.ordering import ordinals, running_sum
from corpusloom.operators.skew import ROWS_PER_SLICE, salted_join
from corpusloom.scratch import Scratch

# Ids below the first vocabulary entry.
EOD_ID = 0
UNKNOWN_ID = 1
FIRST_TOKEN_ID = 2

#: What ``vocab_tokenizer`` hands to each executor unless told otherwise.
MAX_LOCAL_VOCABULARY = 1_000_000
#: Texts that ``pretrained_tokenizer`` encodes at a time; an encoding takes far more room than its ids.
ENCODED_TEXTS = 128
#: Tokens of the documents that share a block in ``tokenize_by_join``.
CODED_TOKENS = 500_000


def build_vocab(df: DataFrame, size: int, scratch: Scratch, text_field: str = "text") -> DataFrame:
    """``(token, count, token_id)`` of the ``size`` commonest tokens, ties by token.

    Counts combine before the shuffle and are written once. A histogram (how many
    tokens have which count) gives the count that the last token of the vocabulary
    has; only tokens of at least that count are put in order, by ranges, and numbered. No
    task holds more than its range, however large the vocabulary.
    """
    counts = (
        df.select(F.explode(words(F.col(text_field))).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    counts = scratch.save(counts, "token_counts")
    histogram = counts.groupBy((-F.col("count")).alias("less")).agg(F.count(F.lit(1)).alias("tokens"))
    reached = running_sum(histogram, "tokens", ["less"], scratch, name="so_far").where(F.col("so_far") >= size)
    least = reached.agg(F.coalesce(-F.min("less"), F.lit(1)).alias("least")).scalar()
    common = counts.where(F.col("count") >= least).withColumn("less", -F.col("count"))
    numbered = ordinals(common, scratch, ["less", "token"], "ordinal").where(F.col("ordinal") < size)
    return numbered.select("token", "count", (F.col("ordinal") + FIRST_TOKEN_ID).cast("int").alias("token_id"))


def _numbered(tokens: pa.ListArray, table: dict[str, int]) -> pa.ListArray:
    """Ids of lists of tokens; only distinct tokens become Python objects."""
    coded = tokens.flatten().dictionary_encode()
    own = np.array([table.get(t, UNKNOWN_ID) for t in coded.dictionary.to_pylist()], np.int32)
    offsets = np.concatenate([[0], np.cumsum(tokens.value_lengths().fill_null(0).to_numpy())])
    ids = pa.array(own[coded.indices.to_numpy()], pa.int32())
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), ids, mask=tokens.is_null())


def vocab_tokenizer(vocab: DataFrame, max_tokens: int = MAX_LOCAL_VOCABULARY) -> Callable[[Column], Column]:
    """A column function that hands the whole vocabulary to each executor.

    More than ``max_tokens`` tokens are an error: such a vocabulary is for ``tokenize_by_join``.
    """
    rows = vocab.select("token", "token_id").limit(max_tokens + 1).toPandas()
    if len(rows) > max_tokens:
        raise ValueError(f"the vocabulary has more than {max_tokens} tokens; use tokenize_by_join, or raise max_tokens")
    table = dict(zip(rows["token"], rows["token_id"].astype(int), strict=True))
    shared = vocab.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf("array<int>")
    def compute(tokens: pa.Array) -> pa.Array:
        return _numbered(tokens, shared.value)

    # Not deterministic, so that a filter on the ids does not tokenise twice.
    once = compute.asNondeterministic()
    return lambda text: once(words(text))


def pretrained_tokenizer(spark: SparkSession, path: str) -> Callable[[Column], Column]:
    """A column function from a ``tokenizer.json`` file of the ``tokenizers`` package.

    The file's content, a few megabytes, is broadcast; each task builds one tokenizer.
    """
    content = "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    shared = spark.sparkContext.broadcast(content)

    @F.pandas_udf("array<int>")
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(shared.value)
        for texts in batches:
            ids = []
            for i in range(0, len(texts), ENCODED_TEXTS):
                part = texts.iloc[i : i + ENCODED_TEXTS].fillna("").tolist()
                ids.extend(np.array(e.ids, np.int32) for e in tokenizer.encode_batch(part, add_special_tokens=False))
            yield pd.Series(ids, dtype=object)

    return compute.asNondeterministic()


def tokenize(
    df: DataFrame,
    tokenizer: Callable[[Column], Column],
    text_field: str = "text",
    append_eod: bool = True,
    eod_id: int = EOD_ID,
) -> DataFrame:
    """Add ``token_ids`` and ``n_tokens``. Row-local: the documents are not shuffled.

    ``tokenizer`` maps a text column to an ``array<int>`` column: the one of
    ``vocab_tokenizer`` or ``pretrained_tokenizer``, or a pandas UDF around any other.
    """
    ids = F.coalesce(tokenizer(F.col(text_field)), F.array().cast("array<int>"))
    if append_eod:
        ids = F.concat(ids, F.array(F.lit(eod_id)))
    return df.withColumn("token_ids", ids).withColumn("n_tokens", F.size("token_ids"))


def _coded(df: DataFrame, id_col: str, text_field: str) -> DataFrame:
    """``(block, ids, codes, tokens)``: texts as numbers of the distinct tokens of their block."""
    separate = re.compile("[^ \t\n\r\f]+")
    schema = T.StructType(
        [
            T.StructField("ids", T.ArrayType(df.schema[id_col].dataType)),
            T.StructField("codes", T.ArrayType(T.ArrayType(T.IntegerType()))),
            T.StructField("tokens", T.ArrayType(T.StringType())),
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[pa.Array] = []
        codes: list[list[int]] = []
        known: dict[str, int] = {}

        def put() -> pa.RecordBatch:
            column = pa.concat_arrays(ids)
            out = [
                pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column),
                pa.array([codes], pa.list_(pa.list_(pa.int32()))),
                pa.array([list(known)], pa.list_(pa.string())),
            ]
            for x in (ids, codes, known):
                x.clear()
            return pa.RecordBatch.from_arrays(out, names=["ids", "codes", "tokens"])

        room = CODED_TOKENS
        for batch in batches:
            begin = 0
            for i, text in enumerate(batch.column(1)):
                row = [known.setdefault(token, len(known)) for token in separate.findall(text.as_py() or "")]
                codes.append(row)
                room -= len(row) + 1
                if room < 0:
                    ids.append(batch.column(0).slice(begin, i + 1 - begin))
                    begin = i + 1
                    yield put()
                    room = CODED_TOKENS
            if begin < len(batch):
                ids.append(batch.column(0).slice(begin))
        if codes:
            yield put()

    return df.select(id_col, text_field).mapInArrow(encode, schema).withColumn("block", F.monotonically_increasing_id())


def tokenize_by_join(
    df: DataFrame,
    vocab: DataFrame,
    scratch: Scratch,
    id_col: str = "id",
    text_field: str = "text",
    append_eod: bool = True,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """``(id, token_ids, n_tokens)`` for a vocabulary too large to hand to each executor.

    Texts become numbers of the distinct tokens of their block of documents, so that
    only these tokens meet the vocabulary, once for each block. A token of very many
    blocks is split by its count in the vocabulary.
    """
    blocks = scratch.save(_coded(df, id_col, text_field), "coded")
    placed = blocks.select("block", F.posexplode("tokens").alias("code", "token"))
    sizes = vocab.select("token", F.col("count").alias("n"))
    found = salted_join(placed, vocab.select("token", "token_id"), ["token"], sizes, F.col("block"), rows_per_slice, "left")
    in_order = F.array_sort(F.collect_list(F.struct("code", F.coalesce("token_id", F.lit(UNKNOWN_ID)).cast("int").alias("id"))))
    tables = found.groupBy("block").agg(F.transform(in_order, lambda x: x["id"]).alias("table"))
    end = F.array(F.lit(EOD_ID)) if append_eod else F.array().cast("array<int>")
    numbered = F.transform(
        "codes", lambda row: F.concat(F.transform(row, lambda code: F.element_at("table", code + 1)), end)
    )
    met = blocks.select("block", "ids", "codes").join(tables, "block", "left")
    rows = met.select(F.explode(F.arrays_zip(F.col("ids").alias("id"), numbered.alias("token_ids"))).alias("r"))
    return rows.select(F.col("r.id").alias(id_col), "r.token_ids", F.size("r.token_ids").alias("n_tokens"))


def sequence_windows(
    tokens: DataFrame,
    seq_length: int,
    scratch: Scratch,
    id_col: str = "id",
    file_col: str = "file_name",
) -> DataFrame:
    """Where each document lies in the token stream of its file.

    ``start`` is its first position; ``first_sample`` and ``last_sample`` are
    the samples of ``seq_length`` tokens it touches.
    """
    summed = running_sum(
        tokens.select(file_col, id_col, "n_tokens"), "n_tokens", [id_col], scratch, [file_col], "end"
    )
    start = F.col("end") - F.col("n_tokens")
    return summed.select(
        file_col,
        id_col,
        "n_tokens",
        start.alias("start"),
        F.expr(f"(end - n_tokens) div {seq_length}").alias("first_sample"),
        F.expr(f"greatest(end - 1, end - n_tokens) div {seq_length}").alias("last_sample"),
    )


def sequence_samples(
    tokens: DataFrame,
    windows: DataFrame,
    seq_length: int,
    id_col: str = "id",
    file_col: str = "file_name",
) -> DataFrame:
    """``(file, sample, token_ids)``: the samples themselves, the last one of a file shorter.

    A sample gathers at most ``seq_length`` tokens, so groups are bounded.
    """
    pieces = (
        tokens.select(id_col, "token_ids")
        .join(windows.where(F.col("n_tokens") > 0), id_col)
        .withColumn("sample", F.explode(F.sequence("first_sample", "last_sample")))
        .withColumn("_from", F.greatest(F.col("sample") * seq_length - F.col("start"), F.lit(0)))
        .withColumn(
            "_to",
            F.least((F.col("sample") + 1) * seq_length - F.col("start"), F.col("n_tokens")),
        )
        .select(
            file_col,
            "sample",
            F.struct(
                "start",
                F.slice("token_ids", (F.col("_from") + 1).cast("int"), (F.col("_to") - F.col("_from")).cast("int")).alias("ids"),
            ).alias("piece"),
        )
    )
    ordered = F.array_sort(F.collect_list("piece"))
    return pieces.groupBy(file_col, "sample").agg(
        F.flatten(F.transform(ordered, lambda p: p["ids"])).alias("token_ids")
    )


def epoch_steps(
    tokens: DataFrame,
    seq_length: int = 8192,
    global_batch_size: int = 2048,
    file_col: str = "file_name",
    bytes_per_token: int = 2,
) -> DataFrame:
    """``(file, bytes, steps)``: training steps of one epoch, rounded up per file."""
    per_step = bytes_per_token * seq_length * global_batch_size
    return (
        tokens.groupBy(file_col)
        .agg((F.sum("n_tokens") * bytes_per_token).alias("bytes"))
        .withColumn("steps", F.expr(f"(bytes + {per_step - 1}) div {per_step}"))
    )


def total_steps(steps: DataFrame) -> DataFrame:
    """One row ``(files, steps)``; the ceiling was taken per file before this sum."""
    return steps.agg(F.count(F.lit(1)).alias("files"), F.sum("steps").alias("steps"))


def steps_from_files(sizes: DataFrame, seq_length: int = 8192, global_batch_size: int = 2048) -> DataFrame:
    """As ``epoch_steps``, from ``(file_name, bytes)`` of files already written."""
    per_step = 2 * seq_length * global_batch_size
    return sizes.withColumn("steps", F.expr(f"(bytes + {per_step - 1}) div {per_step}"))
