"""Pluggable scorers and modifiers, and their composition into stages."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import pii, repetition, text, unicode

Stage = Callable[[DataFrame], DataFrame]
Modifier = Callable[[Column], Column]


class Scorer(Protocol):
    """Scores a text and decides from the score whether the document stays.

    Spark may move the filter below the score column and put the score's
    expression wherever ``keep`` mentions it. A costly score is therefore marked
    as not deterministic, which keeps it in one place.
    """

    def score(self, text: Column) -> Column: ...

    def keep(self, score: Column) -> Column: ...


@dataclass(frozen=True)
class WordCount:
    """Keep documents of at least ``min_words`` words."""

    min_words: int = 50

    def score(self, value: Column) -> Column:
        return text.word_count(value)

    def keep(self, score: Column) -> Column:
        return score >= self.min_words


@dataclass(frozen=True)
class RepeatingNgrams:
    """Drop documents in which, for any ``(n, percent)``, the commonest n-gram
    takes more than ``percent`` % of the characters.

    All limits share one pass over the text. The score holds whole numbers, so
    that a document exactly at a limit is kept.
    """

    limits: tuple[tuple[int, int], ...]
    language: str = "en"

    def score(self, value: Column) -> Column:
        tops = repetition.top_ngrams(value, [n for n, _ in self.limits], self.language)
        return F.struct(tops.alias("tops"), F.coalesce(F.length(value), F.lit(0)).alias("chars"))

    def keep(self, score: Column) -> Column:
        within = [
            score["tops"][i]["count"] * score["tops"][i]["length"] * 100
            <= score["chars"].cast("bigint") * percent
            for i, (_, percent) in enumerate(self.limits)
        ]
        return reduce(lambda a, b: a & b, within)


@dataclass(frozen=True)
class PythonScorer:
    """Wraps ``f(Series[str]) -> Series[float]``; keeps scores of ``minimum`` or more."""

    function: Callable[[pd.Series], pd.Series]
    minimum: float

    def score(self, value: Column) -> Column:
        function = self.function

        @F.pandas_udf("double")
        def compute(texts: pd.Series) -> pd.Series:
            return function(texts)

        return compute.asNondeterministic()(value)

    def keep(self, score: Column) -> Column:
        return score >= self.minimum


def score_filter(scorer: Scorer, text_field: str = "text", score_field: str | None = None) -> Stage:
    """Score, filter, and keep the score column only when it is given a name."""
    name = score_field or "_score"

    def stage(df: DataFrame) -> DataFrame:
        kept = df.withColumn(name, scorer.score(F.col(text_field))).where(
            scorer.keep(F.col(name))
        )
        return kept if score_field else kept.drop(name)

    return stage


def modify(modifier: Modifier, text_field: str = "text") -> Stage:
    return lambda df: df.withColumn(text_field, modifier(F.col(text_field)))


def batch_modifier(
    function: Callable[[pd.Series], pd.Series], batch_size: int = 1000
) -> Modifier:
    """A modifier from a Python function over batches of at most ``batch_size`` texts."""

    @F.pandas_udf("string")
    def compute(texts: pd.Series) -> pd.Series:
        parts = [function(texts[i : i + batch_size]) for i in range(0, len(texts), batch_size)]
        return pd.concat(parts) if parts else texts

    return compute.asNondeterministic()


def sequential(*stages: Stage) -> Stage:
    return lambda df: reduce(lambda d, stage: d.transform(stage), stages, df)


def unicode_stage(text_field: str = "text") -> Stage:
    return lambda df: unicode.repair(df, text_field)


def heuristic_stage(
    text_field: str = "text",
    language: str = "en",
    min_words: int = 50,
    limits: tuple[tuple[int, int], ...] = ((2, 20), (3, 18), (4, 16)),
) -> Stage:
    """Word count (stored), then the n-gram limits ``(n, percent)``."""
    return sequential(
        score_filter(WordCount(min_words), text_field, "word_count"),
        score_filter(RepeatingNgrams(limits, language), text_field),
    )


def pii_stage(text_field: str = "text", key: Column | None = None, **options) -> Stage:
    """Options as in ``corpusloom.functions.pii.anonymize``; ``key`` may be a scalar subquery."""
    if key is None:
        return modify(lambda value: pii.anonymize(value, **options), text_field)

    def stage(df: DataFrame) -> DataFrame:
        # A column first: Spark takes no subquery inside a higher-order function.
        keyed = df.withColumn("_key", key)
        return keyed.withColumn(
            text_field, pii.anonymize(F.col(text_field), key=F.col("_key"), **options)
        ).drop("_key")

    return stage
