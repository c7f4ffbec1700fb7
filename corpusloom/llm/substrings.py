"""Repeated passages by super-k-mer partitioning.

A window is ``window`` consecutive words. Its minimiser is the least of its runs of
``MINIMISER`` words by a fixed hash; equal windows have equal minimisers, and
consecutive windows mostly share one. A stretch of windows that share a minimiser
(a super-k-mer) travels as one piece of text to the bucket of its minimiser, where
windows are sorted and the smallest document id of each is known exactly.

1. ``blocks``: documents are packed, some megabytes to a block, and written once.
2. ``pieces``: each block is cut. Equal pieces of a block are one, with the smallest
   and largest id, so copies within a block travel once; the pieces of a bucket are
   packed together.
3. ``firsts``: a bucket's pieces are grouped by minimiser. One that came alone can't
   repeat. Of others the windows are sorted by their words. Pieces that hold a window
   first seen in a smaller id are answered, with their places, to the blocks they are from.
4. ``apply``: in each block, the answers become words to remove.

A minimiser that very many windows share would make one bucket heavy. So step 1 also
counts minimisers in ``SLOTS`` slots by their hash, a table of fixed size; those in
slots with more than their share are put last, and windows take another run of words.
Windows with no other run are of a passage that repeats as a whole, which is one piece
a block. Answers go to blocks, so no passage's occurrences ever meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.decontaminate import shingle_hashes
from corpusloom.scratch import Scratch

WINDOW = 13
MINIMISER = 3
BLOCK_BYTES = 2 << 20
SLOT_BITS = 16
SLOTS = 1 << SLOT_BITS
#: A slot is put last if it has more than one in so many of all pieces: at most that many are.
HEAVY_SHARE = 2048
#: Blocks report slots with more than one in so many of their own pieces.
REPORT_SHARE = 8192
BUCKET_PIECES = 400_000
#: Windows of a bucket that are sorted at once.
SORTED_WINDOWS = 200_000
#: Bits of a minimiser's hash that put it in order, and of its place in a window. One more
#: bit puts those of heavy slots last.
ORDER_BITS = 56
PLACE_BITS = 7
_POWERS = np.cumprod(np.full(1024, 0x9E3779B97F4A7C15, np.uint64))


def _pack(*parts: np.ndarray | bytes) -> bytes:
    """Arrays and bytes, each after its length, compressed."""
    out = []
    for part in parts:
        raw = part if isinstance(part, bytes) else part.tobytes()
        out += [len(raw).to_bytes(8, "little"), raw]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(out))


def _unpack(packed: bytes, *kinds) -> list:
    raw, at, out = zstandard.ZstdDecompressor().decompress(packed), 0, []
    for kind in kinds:
        size = int.from_bytes(raw[at : at + 8], "little")
        part = raw[at + 8 : at + 8 + size]
        out.append(part if kind is bytes else np.frombuffer(part, kind))
        at += 8 + size
    return out


def blocks(docs: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """``(body, n_pieces, slots, counts)``: packed documents, and the heavy slots of their minimisers."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        texts: list[bytes] = []
        counts: list[int] = []
        room = BLOCK_BYTES

        def put() -> pa.RecordBatch:
            given = np.array([i is not None for i in ids], np.uint8)
            whole = np.array([i or 0 for i in ids], np.int64)
            block = Block(whole, given, np.array(counts, np.int64), b" ".join(x for x in texts if x))
            body = _pack(block.ids, block.given, block.counts, block.text)
            heavy = np.bincount(block.pieces(window, None).slots, minlength=SLOTS)
            n = int(heavy.sum())
            slots = np.flatnonzero(heavy * REPORT_SHARE > n)
            for x in (ids, texts, counts):
                x.clear()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([body], pa.binary()),
                    pa.array([n], pa.int64()),
                    pa.array([slots.astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([heavy[slots].astype(np.int64)], pa.list_(pa.int64())),
                ],
                names=["body", "n_pieces", "slots", "counts"],
            )

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                ids.append(i)
                counts.append(len(found))
                texts.append(b" ".join(found))
                room -= len(texts[-1]) + 16
                if room < 0:
                    yield put()
                    room = BLOCK_BYTES
        if ids:
            yield put()

    packed = docs.select(F.col(id_col).cast("bigint"), text_col).mapInArrow(
        pack, "body binary, n_pieces bigint, slots array<int>, counts array<bigint>"
    )
    return packed.withColumn("block", F.monotonically_increasing_id())


@dataclass
class Pieces:
    """The super-k-mers of a block: windows ``first`` to ``last`` (the number of their first word)."""

    first: np.ndarray
    last: np.ndarray
    minimiser: np.ndarray

    @property
    def slots(self) -> np.ndarray:
        return (self.minimiser >> np.uint64(ORDER_BITS - SLOT_BITS)).astype(np.int64) & (SLOTS - 1)


class Block:
    """Documents of a block: ids, whether they have one, word counts, and all words joined by a space."""

    def __init__(self, ids: np.ndarray, given: np.ndarray, counts: np.ndarray, text: bytes):
        self.ids, self.given, self.counts, self.text = ids, given, counts, text
        self.words = text.split(b" ") if text else []
        n = len(self.words)
        self.offsets = np.zeros(n + 1, np.int64)
        np.cumsum(np.fromiter(map(len, self.words), np.int64, n) + 1, out=self.offsets[1:])
        self.ends = np.cumsum(counts)
        self.doc = np.repeat(np.arange(len(counts)), counts)

    @classmethod
    def read(cls, body: bytes) -> Block:
        return cls(*_unpack(body, np.int64, np.uint8, np.int64, bytes))

    def hashes(self) -> np.ndarray:
        """A hash of each word, equal for equal words: a sum over its bytes. It only picks minimisers."""
        raw = np.frombuffer(self.text + b" ", np.uint8)
        starts, sizes = self.offsets[:-1], np.diff(self.offsets)
        place = np.arange(len(raw)) - np.repeat(starts, sizes)
        return np.add.reduceat((raw.astype(np.uint64) + np.uint64(1)) * _POWERS[place % len(_POWERS)], starts)

    def pieces(self, window: int, heavy: np.ndarray | None) -> Pieces:
        """Stretches of windows of one document with one minimiser; documents without id have none."""
        n = len(self.words) - window + 1
        none = np.empty(0, np.int64)
        if n <= 0:
            return Pieces(none, none, np.empty(0, np.uint64))
        order = shingle_hashes(self.hashes(), min(MINIMISER, window)) >> np.uint64(64 - ORDER_BITS)
        if heavy is not None:
            slot = (order >> np.uint64(ORDER_BITS - SLOT_BITS)).astype(np.int64)
            order |= heavy[slot].astype(np.uint64) << np.uint64(ORDER_BITS)
        # The place in the window is part of the key, so that the leftmost of equal runs wins.
        order <<= np.uint64(PLACE_BITS)
        best = order[:n].copy()
        for k in range(1, window - min(MINIMISER, window) + 1):
            np.minimum(best, order[k : k + n] | np.uint64(k), out=best)
        at = np.arange(n) + (best & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        best >>= np.uint64(PLACE_BITS)
        whole = (self.doc[:n] == self.doc[window - 1 :]) & (self.given[self.doc[:n]] > 0)
        change = np.ones(n, bool)
        change[1:] = (at[1:] != at[:-1]) | (whole[1:] != whole[:-1]) | (self.doc[1:n] != self.doc[: n - 1])
        first = np.flatnonzero(change)
        last = np.append(first[1:], n) - 1
        keep = whole[first]
        first, last = first[keep], last[keep]
        return Pieces(first, last, best[first])

    def cut(self, window: int, heavy: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
        """Buckets, and the distinct pieces of each: minimiser, ids, windows, places, text."""
        found = self.pieces(window, heavy)
        text, numbers = self.text, {}
        starts = self.offsets[found.first].tolist()
        stops = (self.offsets[found.last + window] - 1).tolist()
        which = np.fromiter(
            (numbers.setdefault(text[a:b], len(numbers)) for a, b in zip(starts, stops, strict=True)), np.int64, len(starts)
        )
        texts = list(numbers)
        del numbers
        # Occurrences by piece, so that each piece's are together.
        by_piece = np.argsort(which, kind="stable")
        times = np.bincount(which, minlength=len(texts))
        begin = np.cumsum(times) - times
        one = by_piece[begin] if len(texts) else begin
        ids = self.ids[self.doc[found.first]][by_piece]
        low, high = (f.reduceat(ids, begin) if len(texts) else ids for f in (np.minimum, np.maximum))
        windows = (found.last - found.first + 1)[one]
        minimiser = found.minimiser[one]
        bucket = (minimiser % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bounds = np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1])) if len(order) else []
        for members in np.split(order, bounds[1:]):
            if not len(members):
                continue
            own = [texts[i] for i in members.tolist()]
            places = np.repeat(begin[members], times[members]) + _steps(times[members])
            yield int(bucket[members[0]]), _pack(
                # Only pieces of one minimiser need to meet; others may, as windows are compared.
                (minimiser[members] // np.uint64(buckets)).astype(np.uint32),
                low[members],
                high[members],
                windows[members].astype(np.int32),
                times[members].astype(np.int32),
                found.first[by_piece[places]].astype(np.int32),
                np.array([len(x) for x in own], np.int32),
                b"".join(own),
            )


def _steps(sizes: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... for each size in turn."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _smallest(texts: list[bytes], lows: np.ndarray, windows: np.ndarray, window: int) -> np.ndarray:
    """The smallest id of each window of the pieces, one piece after the other, by sorting windows."""
    entries = []
    at = 0
    for text, low, n in zip(texts, lows.tolist(), windows.tolist(), strict=True):
        if n == 1:
            entries.append((text, low, at))
        else:
            words = text.split(b" ")
            begin = end = 0
            end = sum(map(len, words[:window])) + window - 1
            for k in range(n):
                entries.append((text[begin:end], low, at + k))
                if k + 1 < n:
                    begin += len(words[k]) + 1
                    end += len(words[k + window]) + 1
        at += n
    entries.sort()
    out = np.empty(at, np.int64)
    now, least = None, 0
    for text, low, place in entries:
        if text != now:
            now, least = text, low
        out[place] = least
    return out


def _answers(rows: list[tuple[int, bytes]], window: int) -> Iterator[tuple[int, bytes]]:
    """For each block of a bucket: where its pieces with a window of a smaller id are, and the smallest ids."""
    texts: list[bytes] = []
    parts, places = [], {}
    for block, packed in rows:
        key, low, high, windows, times, at, sizes, body = _unpack(
            packed, np.uint32, np.int64, np.int64, np.int32, np.int32, np.int32, np.int32, bytes
        )
        ends = np.cumsum(sizes, dtype=np.int64)
        texts += [body[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
        begin = np.cumsum(times, dtype=np.int64) - times
        parts.append((np.full(len(key), block, np.int64), begin, times, key, low, high, windows.astype(np.int64)))
        places[block] = at
    blocks, begin, times, key, low, high, windows = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(key, kind="stable")
    opens = np.append(True, key[order][1:] != key[order][:-1])
    starts = np.flatnonzero(opens)
    group = np.cumsum(opens) - 1
    ordered = [texts[i] for i in order.tolist()]
    # Groups of one text need no windows: its smallest id is that of all of them.
    other = np.fromiter(
        (a != b for a, b in zip(ordered[1:], ordered[:-1], strict=True)), bool, max(0, len(ordered) - 1)
    )
    mixed = np.zeros(len(starts), bool)
    mixed[group[1:][other & ~opens[1:]]] = True
    least = np.empty(len(order), np.int64)
    least[order] = np.minimum.reduceat(low[order], starts)[group]
    apart: dict[int, np.ndarray] = {}
    waiting: list[np.ndarray] = []
    room = SORTED_WINDOWS

    def sort() -> None:
        members = np.concatenate(waiting)
        found = _smallest([texts[i] for i in members.tolist()], low[members], windows[members], window)
        for i, own in zip(members.tolist(), np.split(found, np.cumsum(windows[members])[:-1]), strict=True):
            apart[i] = own
            least[i] = own.min()

    stops = np.append(starts[1:], len(order))
    for a, b in zip(starts[mixed].tolist(), stops[mixed].tolist(), strict=True):
        waiting.append(order[a:b])
        room -= int(windows[order[a:b]].sum())
        if room < 0:
            sort()
            waiting, room = [], SORTED_WINDOWS
    if waiting:
        sort()
    told = np.flatnonzero(least < high)
    for members in np.split(told, np.flatnonzero(np.diff(blocks[told])) + 1):
        if len(members):
            block = int(blocks[members[0]])
            firsts = [apart[i] if i in apart else np.full(windows[i], least[i]) for i in members.tolist()]
            own = np.repeat(begin[members], times[members]) + _steps(times[members])
            yield block, _pack(
                times[members].astype(np.int32), windows[members].astype(np.int32), places[block][own], np.concatenate(firsts)
            )


def drop_repeated_passages(
    docs: DataFrame,
    scratch: Scratch,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    words: str = "n_words",
    removed: str = "n_removed",
) -> DataFrame:
    """``(id, n_words, n_removed, text)``: each text without the words that repeat a smaller id's.

    A word goes if it is in a window whose words also begin in a document with a
    smaller id. Windows are those of the input. Words are `[^\\x20\\x09-\\x0D]+`, and
    the words kept are joined by one space. Null and empty texts have no words and
    become empty. Texts of fewer words than a window stay. Documents may share an id:
    neither is smaller, so they don't remove from each other. ``window`` is at most 128. A null id is neither
    smaller nor larger than any other: such a document stays whole and removes nothing. An empty
    table gives no rows. Other columns, whatever their names, aren't read.
    """
    if not 0 < window <= 1 << PLACE_BITS:
        raise ValueError(f"a window of {window} words")
    packed = scratch.save(blocks(docs, id_col, text_col, window), "blocks")
    total = packed.agg(F.sum("n_pieces")).first()[0] or 0
    counted = packed.select(F.explode(F.arrays_zip("slots", "counts")).alias("x")).groupBy("x.slots").agg(
        F.sum("x.counts").alias("n")
    )
    # Fewer than HEAVY_SHARE rows, as each holds more than that share of all pieces.
    found = counted.where(F.col("n") * HEAVY_SHARE > total).select("slots").collect()
    heavy = np.zeros(SLOTS, bool)
    heavy[[r[0] for r in found]] = True
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(2 * partitions, -(-total // BUCKET_PIECES))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, block in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                made = list(Block.read(body.as_py()).cut(window, heavy, buckets))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([bucket for bucket, _ in made], pa.int64()),
                        pa.array([block] * len(made), pa.int64()),
                        pa.array([pieces for _, pieces in made], pa.binary()),
                    ],
                    names=["bucket", "block", "pieces"],
                )

    def first(table: pa.Table) -> pa.Table:
        rows = zip(table.column("block").to_pylist(), table.column("pieces").to_pylist(), strict=True)
        answers = list(_answers(list(rows), window))
        return pa.table(
            {
                "block": pa.array([block for block, _ in answers], pa.int64()),
                "answer": pa.array([answer for _, answer in answers], pa.binary()),
            }
        )

    pieces = packed.select("body", "block").mapInArrow(cut, "bucket bigint, block bigint, pieces binary")
    firsts = pieces.groupBy("bucket").applyInArrow(first, "block bigint, answer binary")
    firsts = scratch.save(firsts, "firsts")

    def apply(block: pa.Table, told: pa.Table) -> pa.Table:
        documents = Block.read(block.column("body")[0].as_py())
        covered = [np.empty(0, np.int64)]
        for answer in told.column("answer"):
            times, windows, places, least = _unpack(answer.as_py(), np.int32, np.int32, np.int32, np.int64)
            # Every occurrence of a piece, window by window.
            sizes = np.repeat(windows, times).astype(np.int64)
            step = _steps(sizes)
            start = np.repeat(places, sizes) + step
            begin = np.cumsum(windows, dtype=np.int64) - windows
            known = least[np.repeat(np.repeat(begin, times), sizes) + step]
            covered.append(start[known < documents.ids[documents.doc[start]]])
        start = np.concatenate(covered)
        n = len(documents.words)
        stays = np.cumsum(np.bincount(start, minlength=n + 1) - np.bincount(start + window, minlength=n + 1))[:n] == 0
        texts, lost = [], []
        ends = documents.ends.tolist()
        for n, end in zip(documents.counts.tolist(), ends, strict=True):
            own = stays[end - n : end]
            kept = int(own.sum())
            lost.append(n - kept)
            if kept == n:
                texts.append(documents.text[documents.offsets[end - n] : documents.offsets[end] - 1] if n else b"")
            else:
                texts.append(b" ".join(documents.words[end - n + i] for i in np.flatnonzero(own).tolist()))
        return pa.table(
            {
                "id": pa.array(documents.ids, pa.int64(), mask=documents.given == 0),
                words: pa.array(documents.counts, pa.int64()),
                removed: pa.array(lost, pa.int64()),
                "text": pa.array(texts, pa.binary()).cast(pa.string()),
            }
        )

    return (
        packed.select("block", "body")
        .groupBy("block")
        .cogroup(firsts.groupBy("block"))
        .applyInArrow(apply, f"id bigint, `{words}` bigint, `{removed}` bigint, text string")
    )
