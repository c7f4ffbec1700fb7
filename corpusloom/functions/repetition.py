"""Share of a document taken by its commonest n-gram (Rae et al. 2021).

The counting is local to a row, so the filter is one map stage at any corpus
size: nothing is exploded or shuffled. It is a pandas UDF because the same in
Spark's array functions (build, sort, run lengths) took several times the CPU, and
exploding the n-grams to group them shuffles several times the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import CHARACTER_LANGUAGES


def _tops(tokens: list[str], ns: Sequence[int], separator: int) -> list[tuple[int, int, int]]:
    """``(n, count, length)`` of the commonest n-gram for each of ``ns``; the longer one wins a tie.

    Tokens become numbers, and an n-gram the number made of its tokens'; equal ones are counted by sorting.
    """
    known: dict[str, int] = {}
    codes = np.array([known.setdefault(t, len(known)) for t in tokens], np.int64)
    ends = np.concatenate([[0], np.cumsum(np.array([len(t) for t in known], np.int64)[codes])])
    grams, span, found = codes, len(known), {}
    for n in range(1, min(max(ns), len(tokens)) + 1):
        if n > 1:
            if span * len(known) >= 1 << 63:
                distinct, grams = np.unique(grams, return_inverse=True)
                span = len(distinct)
            grams = grams[:-1] * len(known) + codes[n - 1 :]
            span *= len(known)
        if n in ns:
            order = np.argsort(grams)
            ordered = grams[order]
            starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            counts = np.diff(np.append(starts, len(ordered)))
            most = counts.max()
            at = order[starts[counts == most]]
            found[n] = (n, int(most), int((ends[at + n] - ends[at]).max()) + separator * (n - 1))
    return [found.get(n, (n, 0, 0)) for n in ns]


def top_ngrams(text: Column, ns: Sequence[int], language: str = "en") -> Column:
    """``array<struct(n, count, length)>``, one for each of ``ns``.

    N-grams are of words joined by one blank, or of non-blank characters in
    languages written without blanks. Count and length are 0 for a document
    with fewer than ``n`` units.
    """
    by_character = language.lower() in CHARACTER_LANGUAGES
    unit = re.compile("[^ \t\n\r\f]" if by_character else "[^ \t\n\r\f]+")
    separator = 0 if by_character else 1

    @F.pandas_udf("array<struct<n: int, count: bigint, length: bigint>>")
    def compute(texts: pd.Series) -> pd.Series:
        return texts.map(lambda value: _tops(unit.findall(value or ""), ns, separator))

    # Not deterministic, so that a filter on the result does not count twice.
    return compute.asNondeterministic()(text)


def repetition_ratio(text: Column, n: int, language: str = "en") -> Column:
    top = top_ngrams(text, [n], language)[0]
    length = F.length(text)
    return F.when(length > 0, top["count"] * top["length"] / length).otherwise(F.lit(0.0))
