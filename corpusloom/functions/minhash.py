"""Character shingles and MinHash signatures (Broder 1997) in Arrow batches.

Expressing 260 seeded minima over exploded shingles in SQL is an order of
magnitude slower than NumPy on the code points, so this is an Arrow UDF. It is
row-local: Spark decides where rows live, and no shuffle is involved. The UDFs
are marked as not deterministic, although they are, because Spark otherwise copies
them into every filter it derives from their result and computes them twice.
"""

from __future__ import annotations

import random
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The Mersenne prime of the hash family and the shingle radix.
PRIME = (1 << 31) - 1
RADIX = 1_000_003

# Shingles hashed at a time by 62-bit hashes, and by 31-bit ones: the work arrays stay in the CPU's caches.
_BLOCK = 256
_CHUNK = 1 << 16
# Shingles that are put out as one batch: about 4 MB.
_BATCH = 1 << 19


def coefficients(seed: int, count: int) -> list[tuple[int, int]]:
    """``(a, b)`` pairs of the hash family ``(a*x + b) mod PRIME``."""
    rng = random.Random(seed)
    return [(rng.randrange(1, PRIME), rng.randrange(0, PRIME)) for _ in range(count)]


def shingle_set(text: str, width: int) -> np.ndarray:
    """Distinct polynomial hashes of the ``width``-character shingles, sorted."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    n = len(points) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    hashes = points[:n]
    for j in range(1, width):
        hashes = hashes * RADIX + points[j : j + n]
        # 2**31 = 1 (mod PRIME): adding the high part to the low part keeps the
        # residue and leaves at most 32 bits, which the next step can multiply.
        hashes = (hashes & PRIME) + (hashes >> 31)
    # Values have 31 bits; half as many bytes sort faster.
    ordered = np.sort((hashes % PRIME).astype(np.int32))
    first = np.ones(n, dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=first[1:])
    return ordered[first].astype(np.int64)


class _Minima:
    """``min((a*x + b) mod PRIME)`` over sets of values, for many ``(a, b)``.

    A value ``h`` of a hash is computed as ``h * 2**64 / PRIME``, modulo 2**64, as the
    product wraps by itself: with ``a`` and ``b`` scaled and rounded down, the sum is too
    small by less than 2**31 + 1. Neighbouring ``h`` are 2**33 apart, so after 2**32
    is added the order is that of ``h``, nothing wraps below zero, and ``h``
    can be told exactly from the smallest sum. Sums are shifted by 2**63 to be compared as signed.
    """

    def __init__(self, pairs: list[tuple[int, int]]):
        self.a = np.array([(a << 64) // PRIME for a, _ in pairs], np.uint64)
        self.b = np.array([((b << 64) // PRIME + (1 << 32) + (1 << 63)) % (1 << 64) for _, b in pairs], np.uint64)
        self.sums = np.empty(_CHUNK, np.uint64)

    def __call__(self, sets: Iterable[np.ndarray]) -> np.ndarray:
        """One row of minima per set; no set is empty."""
        sets = list(sets)
        best = np.full((len(sets), len(self.a)), np.iinfo(np.int64).max)
        waiting: list[tuple[int, np.ndarray]] = []
        room = _CHUNK
        for row, values in enumerate(sets):
            at = 0
            while at < len(values):
                piece = values[at : at + room]
                waiting.append((row, piece))
                at, room = at + len(piece), room - len(piece)
                if not room:
                    self._lower(best, waiting)
                    room = _CHUNK
        self._lower(best, waiting)
        scaled = best.view(np.uint64) ^ np.uint64(1 << 63)
        # 2**64 / PRIME is a little more than 2**33 + 4.
        found = scaled >> np.uint64(33)
        return (found - (found * np.uint64((1 << 33) + 4) > scaled)).astype(np.int64)

    def _lower(self, best: np.ndarray, waiting: list[tuple[int, np.ndarray]]) -> None:
        if not waiting:
            return
        values = np.concatenate([piece for _, piece in waiting]).astype(np.uint64)
        starts = np.cumsum([0] + [len(piece) for _, piece in waiting[:-1]])
        sums = self.sums[: len(values)]
        low = np.empty((len(self.a), len(waiting)), np.int64)
        for k in range(len(self.a)):
            np.multiply(values, self.a[k], out=sums)
            np.add(sums, self.b[k], out=sums)
            np.minimum.reduceat(sums.view(np.int64), starts, out=low[k])
        # A set has one piece here; the next ones come in later calls.
        rows = [row for row, _ in waiting]
        best[rows] = np.minimum(best[rows], low.T)
        waiting.clear()


def _wide_minima(
    values: np.ndarray, first: list[tuple[int, int]], second: list[tuple[int, int]]
) -> np.ndarray:
    """As ``_Minima``, over 62-bit values made of two independent 31-bit ones."""
    (a, b), (c, d) = (np.array(pairs, dtype=np.uint64).T[:, :, None] for pairs in (first, second))
    best = np.full(len(first), np.iinfo(np.int64).max, dtype=np.int64)
    for at in range(0, len(values), _BLOCK):
        x = values[at : at + _BLOCK].astype(np.uint64)
        high, low = (a * x + b) % np.uint64(PRIME), (c * x + d) % np.uint64(PRIME)
        both = ((high << np.uint64(31)) | low).astype(np.int64)
        np.minimum(best, both.min(axis=1), out=best)
    return best


def lists(found: Sequence[np.ndarray | None], dtype: type = np.int64) -> pa.ListArray:
    """One list per array, null for none, without an object per value."""
    offsets = np.cumsum([0] + [0 if x is None else len(x) for x in found])
    values = np.concatenate([np.empty(0, dtype), *(x for x in found if x is not None)])
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), pa.array(values), mask=pa.array([x is None for x in found], pa.bool_())
    )


def shingle_sets(df: DataFrame, id_col: str, text_field: str = "text", width: int = 5) -> DataFrame:
    """``(id, set)``: ``array<int>`` of distinct shingle hashes, null for a null text.

    Sets take several times the room of their texts, so they leave a task in batches
    of their own, of about ``_BATCH`` values, whatever number of texts comes in at a time.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.columns
            begin, found, room = 0, [], _BATCH
            for i, text in enumerate(texts):
                found.append(shingle_set(text.as_py(), width).astype(np.int32) if text.is_valid else None)
                room -= 0 if found[-1] is None else len(found[-1])
                if room < 0 or i + 1 == len(batch):
                    put = [ids.slice(begin, len(found)), lists(found, np.int32)]
                    yield pa.RecordBatch.from_arrays(put, names=[id_col, "set"])
                    begin, found, room = i + 1, [], _BATCH

    schema = T.StructType([df.schema[id_col], T.StructField("set", T.ArrayType(T.IntegerType()))])
    return df.select(id_col, text_field).mapInArrow(make, schema)


def signature(
    text: Column, hashes: int = 260, width: int = 5, seed: int = 42, wide: bool = False
) -> Column:
    """``array<bigint>`` of ``hashes`` minima, null for texts shorter than a shingle.

    ``wide`` refines every 31-bit value by a second, independent one, for
    corpora on which 31 bits collide too often.
    """
    first, second = coefficients(seed, hashes), coefficients(seed + 1, hashes)

    @F.arrow_udf("array<bigint>")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        minima = _Minima(first)

        def signed(sets: list[np.ndarray]) -> np.ndarray:
            return np.stack([_wide_minima(s, first, second) for s in sets]) if wide else minima(sets)

        for texts in batches:
            out: list[np.ndarray | None] = [None] * len(texts)
            waiting: list[tuple[int, np.ndarray]] = []
            room = _BATCH
            for i, text in enumerate(texts):
                values = shingle_set(text.as_py(), width) if text.is_valid else ()
                if len(values):
                    waiting.append((i, values))
                    room -= len(values)
                if waiting and (room < 0 or i + 1 == len(texts)):
                    for (row, _), low in zip(waiting, signed([s for _, s in waiting]), strict=True):
                        out[row] = low
                    waiting, room = [], _BATCH
            yield lists(out)

    return compute.asNondeterministic()(text)


def bands(sig: Column, num_buckets: int, rows: int) -> Column:
    """``array<binary>``: one 16-byte digest per band of ``rows`` signature values."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(num_buckets - 1)),
        lambda k: F.unhex(
            F.md5(F.array_join(F.slice(sig, k * rows + 1, rows).cast("array<string>"), ",").cast("binary"))
        ),
    )
