"""Vector functions on ``array<float>`` columns, in Arrow batches."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.minhash import lists

SIGN_BITS = 32
POOLING = ("mean_pooling", "last_token")


def matrix(vectors: Sequence) -> np.ndarray:
    return np.array(list(vectors), dtype=np.float64)


def unit_rows(m: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)


@F.pandas_udf(T.DoubleType())
def cosine(a: pd.Series, b: pd.Series) -> pd.Series:
    """Row-wise cosine; 0 for a zero vector."""
    if not len(a):
        return pd.Series([], dtype="float64")
    return pd.Series(np.einsum("ij,ij->i", unit_rows(matrix(a)), unit_rows(matrix(b))))


@F.pandas_udf(T.LongType())
def sign_hash(column: pd.Series) -> pd.Series:
    """Side of each of 32 fixed random hyperplanes; close vectors mostly share it."""
    if not len(column):
        return pd.Series([], dtype="int64")
    m = matrix(column)
    planes = np.random.default_rng(0).standard_normal((m.shape[1], SIGN_BITS))
    return pd.Series((m @ planes > 0) @ (1 << np.arange(SIGN_BITS)))


def hashed_tokens(dimensions: int, pooling: str) -> Callable[[str], np.ndarray]:
    """The built-in encoder: a token's vector is one hashed axis, and the text's
    is the mean of its tokens' vectors or the last of them."""

    @lru_cache(maxsize=100_000)
    def axis(token: str) -> int:
        return int(hashlib.md5(token.encode()).hexdigest()[:7], 16) % dimensions

    def encode(text: str) -> np.ndarray:
        axes = [axis(t) for t in re.split("[ \t\n\r\f]+", text) if t]
        if pooling == "last_token":
            axes = axes[-1:]
        return np.bincount(axes, minlength=dimensions) / max(len(axes), 1)

    return encode


def _encoded(texts: pa.Array, batch: Callable[[list[str]], np.ndarray], batch_size: int) -> pa.ListArray:
    """Vectors of the texts; ``batch_size`` texts at a time become Python objects."""
    present = texts.drop_null()
    vectors = (
        np.asarray(vector, dtype=np.float32)
        for i in range(0, len(present), batch_size)
        for vector in batch(present.slice(i, batch_size).to_pylist())
    )
    return lists([next(vectors) if there else None for there in texts.is_valid().to_pylist()], np.float32)


def embed(
    text: Column,
    encoder: Callable[[list[str]], np.ndarray] | None = None,
    dimensions: int = 64,
    pooling: str = "mean_pooling",
    batch_size: int = 128,
) -> Column:
    """``array<float>`` embedding of each text, null for a null text.

    ``encoder`` maps a batch of texts to one vector each. Without one, the
    hashed token vectors of the text are pooled: their mean, or the last one.
    """
    if pooling not in POOLING:
        raise ValueError(f"pooling must be one of {POOLING}")

    @F.arrow_udf("array<float>")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if encoder is None:
            encode = hashed_tokens(dimensions, pooling)

            def batch(part: list[str]) -> list[np.ndarray]:
                return [encode(t) for t in part]
        else:
            batch = encoder
        for texts in batches:
            yield _encoded(texts, batch, batch_size)

    # Not deterministic, so that a filter on the vector does not compute it twice.
    return compute.asNondeterministic()(text)
