"""Language identification by character n-gram ranks (Cavnar & Trenkle 1994)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOP = 300
MAX_PROFILE_ROWS = 1_000_000
_FLUSH = 4_000_000


def ngram_profiles(
    labelled: DataFrame, text_field: str = "text", lang_field: str = "lang", top: int = TOP
) -> DataFrame:
    """``(lang, gram, rank)``: the commonest n-grams of each language, rank 1 first.

    Each task combines its counts before the shuffle, so a language with most
    of the rows costs no more than any other; the rank limit is applied before
    the sort by language as well as after it.
    """
    counts = (
        labelled.where(F.col(lang_field).isNotNull() & (F.col(text_field) != ""))
        .select(F.col(lang_field).alias("lang"), F.lower(F.col(text_field)).alias("text"))
        .mapInPandas(_combined_counts, "lang string, gram string, n bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return (
        counts.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top)
        .select("lang", "gram", "rank")
    )


def _packed_ngrams(text: str) -> np.ndarray:
    """All 1-, 2- and 3-grams, three code points to an integer that sorts as the string does."""
    c = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    return np.concatenate(
        [c << 42, (c[:-1] << 42) | (c[1:] << 21), (c[:-2] << 42) | (c[1:-1] << 21) | c[2:]]
    )


def _packed(gram: str) -> int:
    a, b, c = [ord(ch) for ch in gram] + [0] * (3 - len(gram))
    return (a << 42) | (b << 21) | c


def _unpacked(code: int) -> str:
    return "".join(chr(p) for p in (code >> 42, (code >> 21) & 0x1FFFFF, code & 0x1FFFFF) if p)


def _combined_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Gram counts per language, combined over about ``_FLUSH`` grams at a time."""
    held: dict[str, list[np.ndarray]] = {}
    sizes: dict[str, int] = {}

    def flush(lang: str) -> pd.DataFrame:
        codes, counts = np.unique(np.concatenate(held.pop(lang)), return_counts=True)
        sizes.pop(lang)
        return pd.DataFrame(
            {
                "lang": [lang] * len(codes),
                "gram": [_unpacked(c) for c in codes.tolist()],
                "n": counts,
            }
        )

    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            grams = _packed_ngrams(text)
            held.setdefault(lang, []).append(grams)
            sizes[lang] = sizes.get(lang, 0) + len(grams)
            if sizes[lang] >= _FLUSH:
                yield flush(lang)
    for lang in list(held):
        yield flush(lang)


def profile_scorer(profiles: DataFrame, top: int = TOP) -> Callable[[Column], Column]:
    """A column function ``text -> struct(score, lang, distance)`` from n-gram profiles.

    The profiles (``top`` rows per language, size checked) go to the executors
    once; the documents stay where they are. ``score`` is 1 - best/worst
    distance, ``lang`` the upper-cased code, the smaller code winning a tie.
    """
    rows = profiles.limit(MAX_PROFILE_ROWS + 1).toPandas()
    if len(rows) > MAX_PROFILE_ROWS:
        raise ValueError(f"more than {MAX_PROFILE_ROWS} profile rows; lower `top`")
    langs = sorted(rows["lang"].unique())
    packed = np.array([_packed(gram) for gram in rows["gram"]], dtype=np.int64)
    grams = np.unique(packed)
    ranks = np.zeros((len(grams), len(langs)), dtype=np.int64)
    ranks[np.searchsorted(grams, packed), rows["lang"].map(langs.index)] = rows["rank"]
    shared = profiles.sparkSession.sparkContext.broadcast((langs, grams, ranks))

    @F.pandas_udf("score double, lang string, distance bigint")
    def compute(texts: pd.Series) -> pd.DataFrame:
        names, known, rank_of = shared.value
        found = [_distances(t or "", known, rank_of, top) for t in texts]
        best = [int(d.argmin()) for d in found]
        return pd.DataFrame(
            {
                "score": [1.0 - d.min() / d.max() if d.max() else 0.0 for d in found],
                "lang": [names[i].upper() for i in best],
                "distance": [int(d[i]) for d, i in zip(found, best, strict=True)],
            }
        )

    # Not deterministic, so that a filter on the language does not score twice.
    once = compute.asNondeterministic()
    return lambda text: once(F.lower(text))


def _distances(text: str, known: np.ndarray, rank_of: np.ndarray, top: int) -> np.ndarray:
    """Out-of-place distance of a text to each language; a missing gram costs ``top``."""
    values, counts = np.unique(_packed_ngrams(text), return_counts=True)
    first = np.argsort(-counts, kind="stable")[:top]
    values = values[first]
    if not len(values) or not len(known):
        return np.zeros(rank_of.shape[1], dtype=np.int64)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    other = np.where((known[at] == values)[:, None], rank_of[at], 0)
    own = np.arange(1, len(values) + 1)[:, None]
    return np.where(other > 0, np.abs(own - other), top).sum(axis=0)


def identify(
    df: DataFrame,
    scorer: Callable[[Column], Column],
    text_field: str = "text",
    score_field: str = "language",
) -> DataFrame:
    """Add the (score, language) struct of any scorer as a column."""
    return df.withColumn(score_field, scorer(F.col(text_field)))


def language_code(df: DataFrame, score_field: str = "language") -> DataFrame:
    """Replace the score struct by its language code."""
    return df.withColumn(score_field, F.col(score_field)["lang"])


def language_stats(df: DataFrame, field: str = "language") -> DataFrame:
    return df.groupBy(field).agg(F.count(F.lit(1)).alias("documents"))
