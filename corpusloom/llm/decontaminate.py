"""Benchmark decontamination by a prefix-filtered set join.

An item is cut in windows of ``window`` words (a shorter item is one window). A
window is a set of word shingles, and to be contained it needs all of them, so
one prefix token is enough to find it: its rarest shingle, by the counts over
all documents. Matches on that token are narrowed by position and length (the
window must fit in the text where the token says it begins) and then verified
word by word.

1. ``scan``: documents are read once. A Bloom filter of the items' shingles, of
   a fixed size whatever the number of items, goes to the executors; stretches
   of text whose shingles are all in it are kept with their words.
2. ``token_counts``: how often each shingle occurs in those stretches.
3. ``prefix_index``: the rarest shingle of each window; windows with an absent
   shingle can't occur and go.
4. ``window_hits``: stretches meet the index on the prefix token. A token found
   in very many documents is cut in slices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import WordHashes, fresh
from corpusloom.operators.skew import salted_join
from corpusloom.scratch import Scratch

WINDOW = 13
SHINGLE = 5
FILTER_BITS = 24
ROWS_PER_SLICE = 100_000

#: Words are `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after A-Z become a-z: digits, a-z and all beyond ASCII.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xD6E8FEB86659FD93)


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, width, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            h = (h ^ hashes[k : k + n]) * _A
            h ^= h >> np.uint64(29)
        h *= _B
    return h ^ (h >> np.uint64(32))


def _probes(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    size = np.uint64((1 << bits) - 1)
    return h & size, (h >> np.uint64(40 - bits // 2)) & size


def windows(items: DataFrame, id_col: str, text_col: str, window: int = WINDOW) -> DataFrame:
    """``(window, n, width, shingles, items)``: each distinct window and the items that have it."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            out = {"item": [], "window": [], "n": [], "width": [], "shingles": []}
            for item, text in zip(batch.column(0), batch.column(1), strict=True):
                found = split_words(text.as_py())
                hashes = np.array([known[w] for w in found], np.uint64)
                n = min(window, len(found))
                width = min(SHINGLE, n)
                shingles = shingle_hashes(hashes, width).view(np.int64) if n else []
                for at in range(len(found) - n + 1 if n else 0):
                    out["item"].append(item.as_py())
                    out["window"].append(b" ".join(found[at : at + n]).decode("utf-8", "surrogatepass"))
                    out["n"].append(n)
                    out["width"].append(width)
                    out["shingles"].append(shingles[at : at + n - width + 1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out["item"], batch.schema.field(0).type),
                    pa.array(out["window"], pa.string()),
                    pa.array(out["n"], pa.int32()),
                    pa.array(out["width"], pa.int32()),
                    pa.array(out["shingles"], pa.list_(pa.int64())),
                ],
                names=list(out),
            )

    kind = items.schema[id_col].dataType.simpleString()
    rows = items.select(id_col, text_col).mapInArrow(
        cut, f"item {kind}, window string, n int, width int, shingles array<bigint>"
    )
    return rows.groupBy("window", "n", "width").agg(
        F.first("shingles").alias("shingles"), F.collect_set("item").alias("items")
    )


def _filter(index: DataFrame, bits: int) -> tuple[np.ndarray, list[int]]:
    """The Bloom filter (2 ** bits bits) and the shingle widths of the windows.

    The bits are gathered on the executors into words of 32, so the driver gets
    at most 2 ** (bits - 5) rows, however many items there are.
    """
    h = F.explode("shingles").alias("h")
    at = [
        F.col("h").bitwiseAND((1 << bits) - 1),
        F.shiftrightunsigned("h", 40 - bits // 2).bitwiseAND((1 << bits) - 1),
    ]
    words = (
        index.select(h)
        .select(F.explode(F.array(*at)).alias("bit"))
        .groupBy(F.shiftright("bit", 5).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 31 as int))")).alias("bits"))
    )
    filled = np.zeros(1 << (bits - 5), np.uint32)
    for batch in words.toArrow().to_batches():
        filled[batch.column(0).to_numpy()] = batch.column(1).to_numpy().astype(np.uint32)
    return filled, sorted(r[0] for r in index.select("width").distinct().collect())


def scan(
    docs: DataFrame, index: DataFrame, id_col: str, text_col: str, filter_bits: int = FILTER_BITS
) -> DataFrame:
    """``(id, n_words, runs)`` per document: stretches ``(at, words)`` covered by filter hits."""
    filled, widths = _filter(index, filter_bits)
    shared = docs.sparkSession.sparkContext.broadcast(filled)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, known = shared.value, WordHashes()
        run = pa.struct([("at", pa.int32()), ("words", pa.string())])
        five = np.uint64(5)

        def present(at: np.ndarray) -> np.ndarray:
            return (bits[at >> five] >> (at & np.uint64(31)).astype(np.uint32)) & np.uint32(1) != 0

        for batch in batches:
            counts, runs = [], []
            for text in batch.column(1):
                found = split_words(text.as_py())
                counts.append(len(found))
                hashes = np.array([known[w] for w in found], np.uint64)
                covered = np.zeros(len(found) + 2, np.int8)
                for width in widths:
                    h = shingle_hashes(hashes, width)
                    one, two = _probes(h, filter_bits)
                    hit = np.flatnonzero(present(one))
                    hit = hit[present(two[hit])]
                    for k in range(width):
                        covered[1 + hit + k] = 1
                edges = np.flatnonzero(np.diff(covered))
                runs.append(
                    [
                        {"at": int(a), "words": b" ".join(found[a:b]).decode("utf-8", "surrogatepass")}
                        for a, b in zip(edges[::2], edges[1::2], strict=True)
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(runs, pa.list_(run))],
                names=["id", "n_words", "runs"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        look, f"id {kind}, n_words bigint, runs array<struct<at:int,words:string>>"
    )


def _tokens(runs: DataFrame, widths_of: DataFrame) -> DataFrame:
    """``(row, n_words, at, h, before, context)``: every shingle of the stretches.

    ``context`` is the words of the stretch that a window around the shingle can
    have; ``before`` of them come before the shingle.
    """
    widths = sorted(r[0] for r in widths_of.select("width").distinct().collect())
    longest = widths_of.agg(F.max("n")).first()[0] or 0

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            out = {"row": [], "n_words": [], "at": [], "h": [], "before": [], "context": []}
            for row, n_words, start, text in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                found = text.split(" ")
                hashes = np.array([known[w.encode("utf-8", "surrogatepass")] for w in found], np.uint64)
                for width in widths:
                    room = longest - width if width == SHINGLE else 0
                    for at, h in enumerate(shingle_hashes(hashes, width).view(np.int64).tolist()):
                        first = max(0, at - room)
                        out["row"].append(row)
                        out["n_words"].append(n_words)
                        out["at"].append(start + at)
                        out["h"].append(h)
                        out["before"].append(at - first)
                        out["context"].append(" ".join(found[first : at + width + room]))
            yield pa.RecordBatch.from_pydict(
                out,
                pa.schema([("row", pa.int64()), ("n_words", pa.int64()), ("at", pa.int32()), ("h", pa.int64()), ("before", pa.int32()), ("context", pa.string())]),
            )

    return runs.mapInArrow(
        spread, "row bigint, n_words bigint, at int, h bigint, before int, context string"
    )


def prefix_index(index: DataFrame, counts: DataFrame) -> DataFrame:
    """``(h, offset, window, n, items)``: each window under its rarest shingle."""
    shingles = index.select("window", F.posexplode("shingles").alias("offset", "h"))
    ranked = shingles.join(counts, "h", "left").withColumn("f", F.coalesce("f", F.lit(0)))
    rarest = ranked.groupBy("window").agg(F.min(F.struct("f", "h", "offset")).alias("least"))
    return (
        index.join(rarest.where("least.f > 0"), "window")
        .select("least.h", "least.offset", "window", "n", "items")
    )


def window_hits(
    docs: DataFrame,
    items: DataFrame,
    scratch: Scratch,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> tuple[DataFrame, DataFrame]:
    """``scanned(row, id, n_words)`` and ``hits(row, at, n, items)``.

    ``row`` numbers the input rows, so repeated or null ids stay apart. A hit is
    an occurrence of a window of ``n`` words at word ``at``.
    """
    index = scratch.save(windows(items, item_id, item_text, window), "windows")
    scanned = scratch.save(
        scan(docs, index, doc_id, doc_text).withColumn("row", F.monotonically_increasing_id()), "scanned"
    )
    runs = scanned.select("row", "n_words", F.explode("runs").alias("run")).select(
        "row", "n_words", "run.at", "run.words"
    )
    tokens = scratch.save(_tokens(runs, index), "tokens")
    counts = scratch.save(tokens.groupBy("h").agg(F.count(F.lit(1)).alias("f")), "counts")
    prefixes = scratch.save(prefix_index(index, counts), "prefixes")
    met = salted_join(
        tokens, prefixes, ["h"], counts.withColumnRenamed("f", "n"), F.col("row"), rows_per_slice
    )
    start = F.col("at") - F.col("offset")
    begin = F.col("before") - F.col("offset")
    fits = (start >= 0) & (start + F.col("n") <= F.col("n_words")) & (begin >= 0)
    same = F.array_join(F.slice(F.split("context", " "), begin + 1, F.col("n")), " ") == F.col("window")
    hits = met.where(fits).where(same).select("row", start.alias("at"), "n", "items")
    return scanned.select("row", "id", "n_words"), hits


def contamination(
    docs: DataFrame,
    items: DataFrame,
    scratch: Scratch,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    least_share: int = 20,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """``(id, n_words, n_hit, item_ids, contaminated)``, one row per input row.

    ``n_hit`` words lie in an occurrence of a window; ``item_ids`` have such a
    window, sorted as strings. A document is contaminated when
    ``least_share * n_hit >= n_words`` and something is hit. Texts or items
    without words (null, empty) hit nothing; so does an empty ``items``.
    """
    scanned, hits = window_hits(
        docs, items, scratch, doc_id, doc_text, item_id, item_text, window, rows_per_slice
    )
    covered = F.aggregate(
        F.array_sort(F.collect_set(F.struct("at", "n"))),
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["at"] + s["n"] - F.greatest(a["end"], s["at"]))).alias("n"),
            F.greatest(a["end"], s["at"] + s["n"]).alias("end"),
        ),
        lambda a: a["n"],
    )
    ids = F.transform(F.array_distinct(F.flatten(F.collect_set("items"))), lambda i: i.cast("string"))
    found = hits.groupBy("row").agg(covered.alias("n_hit"), F.array_sort(ids).alias("item_ids"))
    return (
        scanned.join(found, "row", "left")
        .withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("bigint")))
        .withColumn("item_ids", F.coalesce("item_ids", F.array().cast("array<string>")))
        .select(
            "id",
            "n_words",
            "n_hit",
            "item_ids",
            ((F.col("n_hit") > 0) & (least_share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        )
    )


def clean(
    docs: DataFrame, items: DataFrame, scratch: Scratch, doc_id: str = "doc_id", doc_text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns unchanged.

    Rows are removed by id; of rows that share an id all go if one is
    contaminated. A row with a null id is judged by its text alone.
    """
    (key,) = fresh(docs, "_key")
    # A null id never matches another, so such rows are looked up by their text.
    keyed = docs.withColumn(
        key,
        F.when(F.col(doc_id).isNotNull(), F.concat(F.lit("i"), F.col(doc_id).cast("string"))).otherwise(
            F.concat(F.lit("t"), F.sha2(F.coalesce(F.col(doc_text), F.lit("")), 256))
        ),
    )
    bad = contamination(keyed, items, scratch, key, doc_text, item_id, item_text)
    bad = scratch.save(bad.where("contaminated").select(F.col("id").alias(key)).distinct(), "contaminated")
    return keyed.join(bad, key, "left_anti").select(*docs.columns)
