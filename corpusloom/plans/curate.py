"""The curation run: clean, identify language, filter, anonymise, deduplicate."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import stages
from corpusloom.operators.exact import exact_duplicates
from corpusloom.operators.fuzzy import duplicate_groups
from corpusloom.operators.ids import ensure_id
from corpusloom.operators.language import identify, language_code
from corpusloom.operators.semantic import semantic_duplicate_ids
from corpusloom.plans.config import CurationConfig
from corpusloom.scratch import Scratch
from corpusloom.sources.documents import read_language, write_by_language, write_by_source


@dataclass(frozen=True)
class Models:
    """What a run needs from outside: a language scorer, an encoder, an AES key."""

    language_scorer: Callable[[Column], Column] | None = None
    encoder: Callable[[list[str]], np.ndarray] | None = None
    pii_key: Column | None = None


#: Finds ids to delete among documents, none of which are already deleted: ``(documents, deleted)``.
Finder = Callable[[DataFrame, DataFrame | None], DataFrame]


@dataclass(frozen=True)
class NamedStage:
    """``row_local`` stages read each row once, so they can share one pass.

    A stage with a ``finder`` deletes what it lists. One with its own ``table`` writes there what
    comes in, so nothing need be written before or after it, and the table goes once the next one is there.
    """

    name: str
    run: stages.Stage | None = None
    row_local: bool = False
    finder: Finder | None = None
    table: Scratch | None = None


@dataclass(frozen=True)
class Run:
    """The documents left, and how many were left after each stage."""

    documents: DataFrame
    counts: list[tuple[str, int]]


def _without(df: DataFrame, deleted: DataFrame | None, key: str) -> DataFrame:
    return df if deleted is None else df.join(deleted, key, "left_anti")


def stage_list(
    config: CurationConfig, scratch: Scratch, models: Models, output_dir: str | None = None
) -> list[NamedStage]:
    """The enabled stages in order; those that delete copies come last."""
    text, key = config.text_field, config.id_field
    chosen: list[NamedStage] = []
    if config.cleaning:
        chosen.append(NamedStage("cleaning", stages.unicode_stage(text), row_local=True))
    if config.lid:
        if models.language_scorer is None:
            raise ValueError("language identification needs models.language_scorer")
        own = Scratch(scratch.spark) if config.language and not output_dir else None

        def by_language(df: DataFrame) -> DataFrame:
            coded = language_code(identify(df, models.language_scorer, text))
            if output_dir:
                # One folder per language, and their sizes; later stages read the chosen ones back.
                folder = f"{output_dir}/language"
                stats = write_by_language(coded, folder)
                stats.coalesce(1).write.mode("overwrite").json(f"{output_dir}/language_stats")
                return read_language(df.sparkSession, folder, coded.schema, config.language or None)
            if not config.language:
                return coded
            # Written by language first, so that only one directory is read back.
            part = F.upper(F.coalesce(F.col("language"), F.lit("unknown")))
            table = own.save(coded.withColumn("_part", part), "language", ["_part"])
            return table.where(F.col("_part") == config.language.upper()).drop("_part")

        row_local = not (config.language or output_dir)
        chosen.append(NamedStage("language", by_language, row_local=row_local, table=own))
    if config.heuristic:
        heuristic = stages.heuristic_stage(
            text, config.language or "en", config.heuristic_min_words
        )
        chosen.append(NamedStage("heuristic", heuristic, row_local=True))
    if config.pii:
        anonymize = stages.pii_stage(
            text,
            key=models.pii_key,
            action=config.pii_anonymize_action,
            entities=tuple(dict.fromkeys([*config.pii_entities, *[name for name, _ in config.pii_patterns]])),
            patterns=dict(config.pii_patterns),
        )
        chosen.append(NamedStage("pii", anonymize, row_local=True))
    if config.exact:

        def copies(df: DataFrame, deleted: DataFrame | None) -> DataFrame:
            return exact_duplicates(_without(df, deleted, key), scratch, key, text)

        chosen.append(NamedStage("exact_duplicates", finder=copies))
    if config.fuzzy:

        def near_copies(df: DataFrame, deleted: DataFrame | None) -> DataFrame:
            groups = duplicate_groups(df, config.fuzzy_config, scratch, key, text, deleted)
            return groups.where(F.col(key) != F.col("group_id"))

        chosen.append(NamedStage("fuzzy_dedup", finder=near_copies))
    if config.semantic:

        def same_meaning(df: DataFrame, deleted: DataFrame | None) -> DataFrame:
            path = f"{output_dir}/semantic_embeddings" if output_dir else None
            left = _without(df, deleted, key)
            return semantic_duplicate_ids(left, config.semantic_config, scratch, key, text, models.encoder, path)

        chosen.append(NamedStage("semantic", finder=same_meaning))
    return chosen


def run_stages(
    df: DataFrame,
    config: CurationConfig,
    scratch: Scratch,
    models: Models | None = None,
    output_dir: str | None = None,
) -> Run:
    """Run the enabled stages.

    Row-local stages that follow each other are one pass over the corpus, counted on
    the way, and written once as Parquet. The stages that delete copies then only
    list ids: digests, bands and vectors of the texts are read from that table, ids
    already listed leave these narrow rows, and one anti-join with all lists makes the
    result. Nothing runs twice, and a lost executor costs at most one pass. A table of texts
    goes as soon as the next one is written, so two of them are there at most. With
    ``output_dir``, what is left after every stage is also written there as JSON lines by source file.
    """
    key = config.id_field
    current = ensure_id(df, scratch, key)
    counts: list[tuple[str, int]] = []
    passing: list[tuple[str, Observation]] = []
    over: list[Callable[[], None]] = []
    deleted: DataFrame | None = None

    def watch(name: str) -> None:
        nonlocal current
        seen = Observation()
        current = current.observe(seen, F.count(F.lit(1)).alias("n"))
        passing.append((name, seen))

    def settle(name: str) -> None:
        nonlocal current
        current = table = scratch.save(current, name)
        counts.extend((stage, seen.get["n"]) for stage, seen in passing)
        passing.clear()
        for drop in over:
            drop()
        over[:] = [lambda: scratch.drop(table)]

    watch("input")
    for stage in stage_list(config, scratch, models or Models(), output_dir):
        if passing and not (stage.row_local or stage.table):
            settle("rows")
        if stage.finder is None:
            current = current.transform(stage.run)
            watch(stage.name)
            if stage.table:
                over.append(stage.table.close)
            elif output_dir or not stage.row_local:
                settle(stage.name)
        else:
            found = scratch.save(stage.finder(current, deleted).select(key), "deleted")
            deleted = found if deleted is None else scratch.save(deleted.unionByName(found).distinct(), "deleted")
            left = current.select(key).join(deleted, key, "left_anti").count()
            counts.append((stage.name, left))
        if output_dir and stage.name != "language":
            write_by_source(_without(current, deleted, key), f"{output_dir}/{stage.name}", gather=deleted is not None)
    if passing:
        settle("rows")
    return Run(_without(current, deleted, key), counts)


def funnel(spark: SparkSession, run: Run) -> DataFrame:
    """``(stage, position, documents)``: what was left after each stage."""
    rows = [(stage, i, n) for i, (stage, n) in enumerate(run.counts)]
    table = pd.DataFrame(rows, columns=["stage", "position", "documents"])
    return spark.createDataFrame(table, "stage string, position bigint, documents bigint")


def curate(
    df: DataFrame,
    config: CurationConfig,
    scratch: Scratch,
    models: Models | None = None,
    output_dir: str | None = None,
) -> DataFrame:
    """The documents left after all enabled stages."""
    return run_stages(df, config, scratch, models, output_dir).documents


def pii_key(spark: SparkSession, path: str) -> Column:
    """The AES key in a one-line text file, as a scalar subquery.

    The plan shows a subquery, not the key.
    """
    return spark.read.text(path).select(F.unhex("value")).scalar()
