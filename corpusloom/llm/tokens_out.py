"""Token ids in training order, as shards of fixed stride.

Documents are tokenised and joined to one stream with an end token after each;
the stream is cut in sequences of one length. A keyed Feistel permutation with
cycle-walking gives each sequence its slot in the training order, without a sort
or a table of random numbers. Slots are dealt out in ranges; the task of a range
writes one shard, in which slot ``s`` begins at ``(s % per_shard) * stride``.
A reader can begin at any slot.

The stream's length must be known before any slot. So texts are tokenised once, to a
table of packed ids with one count per partition; the second pass only cuts these ids,
and sends what a chunk gives to a shard as one packed piece. A task holds one shard at a time.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.scratch import Scratch

# Fixed value: how a byte-level vocabulary of this kind cuts text before merging,
# with possessive repeats, which cut alike and don't backtrack.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


@dataclass(frozen=True)
class TokenConfig:
    """``vocabulary`` is a file that every executor finds under this path."""

    vocabulary: str = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    end: int = 50256
    length: int = 2048
    per_shard: int = 4096
    key: int = 20240601
    rounds: int = 4

    @property
    def kind(self) -> np.dtype:
        """Two bytes per id where the vocabulary allows."""
        return np.dtype("<u2" if self.end < 1 << 16 else "<u4")

    @property
    def stride(self) -> int:
        return self.length * self.kind.itemsize


_ENCODERS: dict[str, object] = {}


def encoder(config: TokenConfig):
    """The vocabulary's tokenizer, loaded once per Python worker."""
    if config.vocabulary not in _ENCODERS:
        import tiktoken

        with open(config.vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[config.vocabulary] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[config.vocabulary]


def feistel(x: np.ndarray, n: int, key: int, rounds: int = 4, inverse: bool = False) -> np.ndarray:
    """A keyed permutation of ``0 .. n - 1``, applied to ``x``.

    A balanced Feistel network permutes the smallest range of 4 ** k numbers that
    holds ``n``; a result beyond ``n`` is permuted again until it is below.
    """
    half = max(1, ((max(n - 1, 1)).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = [np.uint64(int.from_bytes(hashlib.sha256(f"{key}:{r}".encode()).digest()[:8], "big")) for r in range(rounds)]

    def once(v: np.ndarray) -> np.ndarray:
        left, right = v >> np.uint64(half), v & low
        for k in reversed(keys) if inverse else keys:
            side = left if inverse else right
            with np.errstate(over="ignore"):
                h = (side ^ k) * np.uint64(0x9E3779B97F4A7C15)
                h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                h ^= h >> np.uint64(32)
            left, right = (right ^ (h & low), left) if inverse else (right, left ^ (h & low))
        return (left << np.uint64(half)) | right

    out = once(x.astype(np.uint64))
    while (far := out >= n).any():
        out[far] = once(out[far])
    return out.astype(np.int64)


def _pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _unpack(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


CHUNK_TOKENS = 1 << 19


def _tokens(docs: DataFrame, text_col: str, config: TokenConfig) -> DataFrame:
    """``(part, before, n, ids)``: the stream in chunks; ``before`` counts the partition's tokens before a chunk."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part = encoder(config), TaskContext.get().partitionId()
        held: list[np.ndarray] = []
        before = n = 0

        def put() -> pa.RecordBatch:
            nonlocal before, n
            row = {"part": [part], "before": [before], "n": [n], "ids": [_pack(np.concatenate(held).tobytes())]}
            before, n = before + n, 0
            held.clear()
            return pa.RecordBatch.from_pydict(row, schema)

        for batch in batches:
            for text in batch.column(0):
                if body := text.as_py():
                    held.append(np.array([*known.encode_ordinary(body), config.end], config.kind))
                    n += len(held[-1])
                    if n >= CHUNK_TOKENS:
                        yield put()
        if n:
            yield put()

    schema = pa.schema([("part", pa.int64()), ("before", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])
    return docs.select(text_col).mapInArrow(encode, "part bigint, before bigint, n bigint, ids binary")


def _pieces(stream: DataFrame, starts: dict[int, int], sequences: int, config: TokenConfig) -> DataFrame:
    """``(shard, pieces)``: what each chunk gives to a shard, packed: slots, places, lengths and ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(_unpack(row["ids"]), config.kind)
                first = starts[row["part"]] + row["before"]
                sequence = np.arange(first // config.length, (first + len(ids) - 1) // config.length + 1)
                begin = np.maximum(sequence * config.length, first)
                size = np.minimum((sequence + 1) * config.length, first + len(ids)) - begin
                slot = feistel(sequence, sequences, config.key, config.rounds)
                shard = slot // config.per_shard
                order = np.argsort(shard, kind="stable")
                out: dict[str, list] = {"shard": [], "pieces": []}
                for own in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
                    data = [ids[a - first : a - first + n] for a, n in zip(begin[own].tolist(), size[own].tolist(), strict=True)]
                    head = np.stack([slot[own] % config.per_shard, begin[own] % config.length, size[own]]).astype("<i8")
                    out["shard"].append(int(shard[own[0]]))
                    out["pieces"].append(_pack(len(own).to_bytes(8, "little") + head.tobytes() + np.concatenate(data).tobytes()))
                yield pa.RecordBatch.from_pydict(out, schema)

    schema = pa.schema([("shard", pa.int64()), ("pieces", pa.binary())])
    return stream.select("part", "before", "ids").mapInArrow(cut, "shard bigint, pieces binary")


def _place(shard: np.ndarray, pieces: bytes, config: TokenConfig) -> None:
    """Put a chunk's ids where they belong in the shard, an array of its slots."""
    raw = _unpack(pieces)
    n = int.from_bytes(raw[:8], "little")
    slots, places, sizes = np.frombuffer(raw, "<i8", 3 * n, 8).reshape(3, n).tolist()
    ids, at = np.frombuffer(raw, config.kind, -1, 8 + 24 * n), 0
    for slot, place, size in zip(slots, places, sizes, strict=True):
        shard[slot, place : place + size] = ids[at : at + size]
        at += size


ROWS = "slot bigint, sequence bigint, shard bigint, byte_offset bigint, n_tokens int, tokens_sha256 string"


def materialise(
    docs: DataFrame, scratch: Scratch, path: str, text_col: str = "text", config: TokenConfig = TokenConfig()
) -> DataFrame:
    """Writes the shards to ``path``; ``(slot, sequence, shard, byte_offset, n_tokens, tokens_sha256)`` per sequence.

    The last sequence of the stream is filled up with end tokens, which don't
    count. Null and empty texts give no tokens; without any token there are no
    shards. The stream follows the stored order of the rows, as they are read this once;
    equal rows are texts of their own, and other columns aren't read. Texts may be of any length: a
    sequence is put together from chunks. A shard is written
    under another name and then moved, so a repeated task changes nothing.
    """
    stream = scratch.save(_tokens(docs, text_col, config), "tokens")
    # One row per partition comes to the driver.
    counts = {r[0]: r[1] for r in stream.groupBy("part").agg(F.sum("n")).collect()}
    starts, total = {}, 0
    for part in sorted(counts):
        starts[part] = total
        total += counts[part]
    sequences = -(-total // config.length)
    last = total - (sequences - 1) * config.length

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(path)
        attempt = TaskContext.get().taskAttemptId()
        now, shard = None, None

        def put() -> pa.RecordBatch:
            with system.open_output_stream(f"{root}/_{now}-{attempt}", compression=None) as out:
                out.write(shard.tobytes())
            system.move(f"{root}/_{now}-{attempt}", f"{root}/shard-{now:08d}.bin")
            slots = now * config.per_shard + np.arange(len(shard))
            sequence = feistel(slots, sequences, config.key, config.rounds, inverse=True)
            sizes = np.where(sequence == sequences - 1, last, config.length)
            digests = [hashlib.sha256(row[:n].tobytes()).hexdigest() for row, n in zip(shard, sizes.tolist(), strict=True)]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(slots),
                    pa.array(sequence),
                    pa.array(np.full(len(slots), now)),
                    pa.array(np.arange(len(slots), dtype=np.int64) * config.stride),
                    pa.array(sizes, pa.int32()),
                    pa.array(digests),
                ],
                names=["slot", "sequence", "shard", "byte_offset", "n_tokens", "tokens_sha256"],
            )

        for batch in batches:
            for own, pieces in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if own != now:
                    if shard is not None:
                        yield put()
                    rows = min(config.per_shard, sequences - own * config.per_shard)
                    now, shard = own, np.full((rows, config.length), config.end, config.kind)
                _place(shard, pieces.as_py(), config)
        if shard is not None:
            yield put()

    system, root = fs.FileSystem.from_uri(path)
    system.create_dir(root, recursive=True)
    shards = max(1, -(-sequences // config.per_shard))
    # Each task writes a range of shards, as many as it takes to use all partitions there are.
    tasks = min(shards, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    each = -(-shards // tasks)
    pieces = _pieces(stream, starts, sequences, config)
    ranges = pieces.repartitionById(-(-shards // each), (F.col("shard") / each).cast("int")).sortWithinPartitions("shard")
    rows = scratch.save(ranges.mapInArrow(write, ROWS), "sequences")
    scratch.drop(stream)
    meta = {"sequences": sequences, "tokens": total, "length": config.length, "per_shard": config.per_shard, "dtype": config.kind.str, "key": config.key}
    with system.open_output_stream(f"{root}/meta.json") as f:
        f.write(json.dumps(meta).encode())
    return rows


def read_slots(path: str, start: int, count: int) -> np.ndarray:
    """Sequences ``start .. start + count - 1`` of the training order, read in shard order."""
    system, root = fs.FileSystem.from_uri(path)
    with system.open_input_stream(f"{root}/meta.json") as f:
        meta = json.loads(f.read())
    kind, out, slot = np.dtype(meta["dtype"]), [], start
    stop = min(start + count, meta["sequences"])
    stride = meta["length"] * kind.itemsize
    while slot < stop:
        shard, at = divmod(slot, meta["per_shard"])
        n = min(stop - slot, meta["per_shard"] - at)
        with system.open_input_file(f"{root}/shard-{shard:08d}.bin") as f:
            f.seek(at * stride)
            out.append(np.frombuffer(f.read(n * stride), kind).reshape(n, meta["length"]))
        slot += n
    return np.concatenate(out) if out else np.empty((0, meta["length"]), kind)
