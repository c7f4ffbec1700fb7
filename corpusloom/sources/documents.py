"""Document scans and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators.language import language_stats
from corpusloom.scratch import Scratch

SPLIT_FILES = {
    "train": "train",
    "training": "train",
    "validation": "validation",
    "valid": "validation",
    "test": "test",
}
SFT_SCHEMA = "input string, output string"
QA_SCHEMA = "context string, question string, answer struct<text: string>"
CORRUPT = "_corrupt_record"
#: Columns of ``read_records``: the whole line as a VARIANT, and the line itself where it is no record.
RECORD = "_record"
REJECTED = "_rejected"


def read_jsonl(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: str | T.StructType,
    file_name: bool = True,
) -> DataFrame:
    """Scan JSON lines under a declared schema, with the name of the source file.

    Lines that are not JSON are kept apart in ``_corrupt_record``; drop them
    with ``well_formed``, count them with ``malformed``.
    """
    df = spark.read.schema(_declared(schema)).option("columnNameOfCorruptRecord", CORRUPT).json(paths)
    return df.select("*", F.col("_metadata.file_name").alias("file_name")) if file_name else df


def well_formed(df: DataFrame) -> DataFrame:
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def malformed(
    spark: SparkSession, paths: str | Sequence[str], schema: str | T.StructType
) -> DataFrame:
    """``(file_name, lines)``: unreadable lines per file.

    From a text scan, as Spark refuses a JSON scan of the corrupt column alone.
    """
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_name").alias("file_name"))
    parsed = F.from_json("value", _declared(schema), {"columnNameOfCorruptRecord": CORRUPT})
    return (
        lines.where((F.trim("value") != "") & parsed[CORRUPT].isNotNull())
        .groupBy("file_name")
        .agg(F.count(F.lit(1)).alias("lines"))
    )


def _declared(schema: str | T.StructType) -> T.StructType:
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])


def read_records(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: str | T.StructType,
    file_name: bool = True,
    file_path: bool = False,
    folders: bool = False,
) -> DataFrame:
    """Scan JSON lines: the declared fields as columns, and every field in ``_record``.

    The record travels with its row as one VARIANT, so fields that nobody declared
    reach the sinks as they came, nested ones too (a number of more than 38
    digits as the nearest double). A line that is no JSON object, or that has a field
    twice, is kept in ``_rejected``, with nulls in all other columns; empty lines are none.
    ``accepted`` has the rest, ``write_rejected`` sets these lines aside and counts them.
    With ``folders``, files at any depth below the paths are read.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = [F.col(f"_metadata.{c}").alias(c) for c in ("file_name", "file_path")]
    lines = spark.read.option("recursiveFileLookup", folders).text(paths).select("value", *names)
    lines = lines.where(F.regexp_replace("value", r"[ \t\r]+", "") != "")
    parsed = lines.withColumn("_parsed", F.try_parse_json("value"))
    parsed = parsed.withColumn("_fields", F.expr("try_cast(_parsed AS MAP<STRING, VARIANT>)"))
    bad = F.col("_fields").isNull()
    return parsed.select(
        *[
            F.try_variant_get(F.try_element_at("_fields", F.lit(f.name)), "$", f.dataType.simpleString()).alias(f.name)
            for f in fields
        ],
        F.when(~bad, F.col("_parsed")).alias(RECORD),
        F.when(bad, F.col("value")).alias(REJECTED),
        *(["file_name"] if file_name else []),
        *(["file_path"] if file_path else []),
    )


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.col(REJECTED).isNull()).drop(REJECTED)


def write_rejected(df: DataFrame, path: str) -> DataFrame:
    """The rejected lines as they were, in a folder per source file; returns ``(file_name, lines)``."""
    bad = df.where(F.col(REJECTED).isNotNull()).select(F.col(REJECTED).alias("value"), "file_name")
    bad.write.partitionBy("file_name").mode("overwrite").text(path)
    written = df.sparkSession.read.schema("value string, file_name string").text(path)
    return written.groupBy("file_name").agg(F.count(F.lit(1)).alias("lines"))


def record_json(df: DataFrame, without: Sequence[str] = ()) -> Column:
    """Each row as a JSON object: its record, with the row's columns in place of fields of their names.

    A null column says null where the record has that field, and nothing where it hasn't.
    Rows without a record, as those of a table that wasn't read by ``read_records``,
    are their columns.
    """
    names = [c for c in df.columns if c not in (RECORD, REJECTED, *without)]
    if RECORD not in df.columns:
        return F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    given = F.coalesce(F.expr(f"try_cast({RECORD} AS MAP<STRING, VARIANT>)"), F.expr("cast(map() AS MAP<STRING, VARIANT>)"))
    columns = F.to_variant_object(F.struct(*names)).try_cast("map<string,variant>")
    known = F.array(*[F.lit(c) for c in names])
    kept = F.map_filter(given, lambda k, v: ~F.array_contains(known, k))
    ours = F.map_filter(columns, lambda k, v: ~F.is_variant_null(v) | F.map_contains_key(given, k))
    return F.to_json(F.to_variant_object(F.map_concat(kept, ours)))


def document_schema(
    text_field: str = "text", id_field: str | None = None, extra: str = ""
) -> T.StructType:
    parts = [f"{id_field} string"] if id_field else []
    return T.StructType.fromDDL(", ".join([*parts, f"{text_field} string", *([extra] if extra else [])]))


def read_splits(spark: SparkSession, root: str, schema: str | T.StructType = SFT_SCHEMA) -> DataFrame:
    """Files named by split (``train``/``training``, ``validation``, ``test``) as one dataset.

    The name may also be that of a folder with part files, as Spark writes one. Another name
    is in no split, and an error rather than rows without one.
    """
    df = accepted(read_records(spark, root, schema, file_path=True, folders=True))
    stem = F.regexp_extract("file_path", r"/([A-Za-z]+)[^/]*(?:/part-[^/]*)?$", 1)
    split: Column | None = None
    for name, label in SPLIT_FILES.items():
        match = stem == name
        split = F.when(match, label) if split is None else split.when(match, label)
    unknown = F.raise_error(F.concat(F.lit("no split is named by the file "), "file_path"))
    return df.withColumn("split", split.otherwise(unknown.cast("string"))).drop("file_path")


def write_by_source(df: DataFrame, path: str, file_col: str = "file_name", gather: bool = False) -> None:
    """JSON lines in one directory per source file, whole records where there are any.

    Texts aren't shuffled: a scan's tasks hold a stretch of one or a few files, so there are
    about as many files as tasks and sources. Where a join has mixed the rows,
    ``gather`` rebalances them by source first, and AQE cuts a very large one over many tasks.
    """
    rows = df.hint("rebalance", file_col) if gather else df
    lines = rows.select(record_json(df, [file_col]).alias("value"), file_col)
    lines.write.partitionBy(file_col).mode("overwrite").text(path)


def write_by_language(
    df: DataFrame, path: str, field: str = "language", storage: str = "json"
) -> DataFrame:
    """One directory per upper-cased language, the column kept; returns rows per language.

    Rows are rebalanced by language, so that small languages end in one file each and not in one
    per task. The statistics read the written table, so the identification runs once.
    """
    part = F.upper(F.coalesce(F.col(field), F.lit("unknown")))
    rows = df.withColumn("_part", part).hint("rebalance", "_part")
    if storage == "json":
        rows.select(record_json(df).alias("value"), "_part").write.partitionBy("_part").mode("overwrite").text(path)
    else:
        rows.write.partitionBy("_part").format(storage).mode("overwrite").save(path)
    return language_stats(read_language(df.sparkSession, path, df.schema, storage=storage), field)


def read_language(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    language: str | None = None,
    storage: str = "json",
) -> DataFrame:
    """Read back one language (only its directory is listed in the scan) or all of them."""
    if RECORD in schema.names and storage == "json":
        table = spark.read.schema("value string, _part string").text(path)
        if language:
            table = table.where(F.col("_part") == language.upper())
        parsed = table.withColumn(RECORD, F.try_parse_json("value"))
        parsed = parsed.withColumn("_fields", F.expr(f"try_cast({RECORD} AS MAP<STRING, VARIANT>)"))
        return parsed.select(
            *[
                F.col(RECORD)
                if f.name == RECORD
                else F.try_variant_get(F.try_element_at("_fields", F.lit(f.name)), "$", f.dataType.simpleString()).alias(f.name)
                for f in schema
            ]
        )
    with_part = T.StructType([*schema.fields, T.StructField("_part", T.StringType())])
    df = spark.read.format(storage).schema(with_part).load(path)
    if language:
        df = df.where(F.col("_part") == language.upper())
    return df.drop("_part")


def write_scored(df: DataFrame, path: str, scratch: Scratch) -> DataFrame:
    """Write scored rows as JSON lines, and return them as they were scored.

    Scored rows are settled first, so that a remote scorer is called once per
    row even when executors are lost, and both sinks work from that table.
    """
    settled = scratch.save(df, "scored")
    settled.select(record_json(settled).alias("value")).write.mode("overwrite").text(path)
    return settled


def dual_sink(
    scored: DataFrame, output_dir: str, scratch: Scratch, field: str = "overall", threshold: float = 3.5
) -> None:
    """All scored rows to ``sft_data_score.jsonl``, passing ones, as they came, to ``filtered_data.jsonl``."""
    from corpusloom.operators.sft import reward_filter

    written = write_scored(scored, f"{output_dir}/sft_data_score.jsonl", scratch)
    passing = reward_filter(written, field, threshold)
    passing.select(record_json(passing).alias("value")).write.mode("overwrite").text(f"{output_dir}/filtered_data.jsonl")


def write_tokens(tokens: DataFrame, path: str) -> None:
    """Token arrays as Parquet, one row per document."""
    tokens.write.mode("overwrite").parquet(path)
