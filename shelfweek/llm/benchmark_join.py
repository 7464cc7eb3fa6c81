"""Occurrences of benchmark windows in documents, for a benchmark too large to be sent.

The same prefix-filtered join as for a small one, by shuffles. A window is a row; its shingles
are 64-bit numbers. All shingles of a window that occurs stand side by side in a document, so
a task looks for runs of shingles that may be a window's, by a bitmap of bounded size that is
sent to it. What passes is counted over all documents; every window is joined by its rarest
shingle alone, and the words around it, which travel with it, are compared with the window's.
Only what passes the bitmaps is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrow_text import text_slices
from .scratch import numbered, sent, settle

#: Bits of a bitmap for each shingle, and the most of a bitmap: 64 MB.
BITS_EACH = 16
MOST_BITS = 1 << 29
#: Rows handed on at a time.
ROWS = 1 << 14
# bits of one value of Spark's bitmap aggregate
_BITS = 32768
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def hashes(flat: pa.Array) -> np.ndarray:
    """A number for every word, the same wherever the word stands."""
    words = flat.dictionary_encode()
    own = np.array([xxhash.xxh64_intdigest(w) for w in words.dictionary.to_pylist()], np.uint64)
    return own[words.indices.to_numpy(zero_copy_only=False)]


def shingles(numbers: np.ndarray, size: int) -> np.ndarray:
    """The number of the ``size`` words from each word on."""
    out = np.full(max(0, len(numbers) - size + 1), size, np.uint64)
    for k in range(size):
        out = out * _FACTOR + numbers[k : k + len(out)]
    return out.view(np.int64)


class Bitmap:
    """Which shingles may be among those of a table: all that are, and some others."""

    def __init__(self, codes: DataFrame):
        count = codes.count()
        self.bits = min(MOST_BITS, max(_BITS, 1 << (count * BITS_EACH).bit_length()))
        spot = F.col("code").bitwiseAND(self.bits - 1)
        maps = codes.groupBy((F.floor(spot / _BITS)).cast("int").alias("k")).agg(
            F.bitmap_construct_agg(spot % _BITS).alias("bits")
        )
        self.bytes = np.zeros(self.bits // 8, np.uint8)
        for row in maps.toLocalIterator():  # MOST_BITS bounds them
            at = row.k * (_BITS // 8)
            self.bytes[at : at + _BITS // 8] = np.frombuffer(bytes(row.bits), np.uint8)

    def holds(self, codes: np.ndarray) -> np.ndarray:
        spot = codes & (self.bits - 1)
        return (self.bytes[spot >> 3] >> (spot & 7).astype(np.uint8) & 1).astype(bool)


def long_runs(mask: np.ndarray, least: int) -> np.ndarray:
    """``mask`` without its runs of fewer than ``least``."""
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    first, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = stop - first >= least
    marks = np.zeros(len(mask) + 1, np.int64)
    marks[first[long]] += 1
    marks[stop[long]] -= 1
    return np.cumsum(marks)[: len(mask)] > 0


def windows_of(items: DataFrame, width: int, shingle: int, words_of: Callable) -> DataFrame:
    """(text, n, codes, item) for each window of each row (i, t): its words with spaces, how
    many they are, the numbers of its shingles, and the item."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_slices(batch, 1, 1 << 18):
                flat, ends = words_of(texts)
                numbers, words, names = hashes(flat), flat.to_pylist(), rows.column(0).to_pylist()
                out = []
                for k, name in enumerate(names):
                    lo, hi = int(ends[k]), int(ends[k + 1])
                    n = min(width, hi - lo)
                    size = min(n, shingle)
                    for at in range(lo, hi - n + 1) if n else ():
                        codes = shingles(numbers[at : at + n], size).tolist()
                        out.append({"text": " ".join(words[at : at + n]), "n": n, "codes": codes, "item": name})
                        if len(out) == ROWS:
                            yield pa.RecordBatch.from_pylist(out, schema)
                            out = []
                yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema(
        [("text", pa.string()), ("n", pa.int32()), ("codes", pa.list_(pa.int64())), ("item", pa.string())]
    )
    return items.mapInArrow(cut, "text string, n int, codes array<long>, item string")


def _passing(texts: pa.Array, least: dict[int, int], known: Bitmap, words_of: Callable) -> Iterator[tuple]:
    """(size, words, ends, places, shingles, texts) of what may be part of a window."""
    flat, ends = words_of(texts)
    numbers, stops = hashes(flat), ends[1:]
    for size, run in least.items():
        codes = shingles(numbers, size)
        if not len(codes):
            continue
        at = np.arange(len(codes))
        inside = at + size <= stops[np.searchsorted(stops, at, "right")]
        at = np.flatnonzero(long_runs(inside & known.holds(codes), run))
        yield size, flat, ends, at, codes[at], np.searchsorted(stops, at, "right")


def occurrences(
    docs: DataFrame, items: DataFrame, width: int, shingle: int, words_of: Callable
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of documents (_row, _text), a written table, and items (i, t): a row (_row, n_words) for
    each document, (_row, start, n, window) for each occurrence of a window, and the items
    (window, item) that have a window, without null ones."""
    found = settle(windows_of(items, width, shingle, words_of))
    windows = numbered(found.select("text", "n", "codes").distinct(), "window")
    owners = found.where("item IS NOT NULL").select("text", "item").distinct()
    owners = owners.join(windows.select("text", "window"), "text").select("window", "item")
    tokens = windows.select("window", "n", F.posexplode("codes").alias("offset", "code"))

    # the shortest run of shingles that a window of each kind has, at most ``shingle`` kinds
    size = F.least("n", F.lit(shingle))
    kinds = windows.groupBy(size.alias("size")).agg(F.min(F.col("n") - size + 1).alias("run"))
    least = {r["size"]: r["run"] for r in kinds.collect()}
    spark = docs.sparkSession
    known = sent(spark, Bitmap(tokens.select("code").distinct()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = known()
        for batch in batches:
            for _, texts in text_slices(batch, 0):
                for _, _, _, _, codes, _ in _passing(texts, least, own, words_of):
                    codes, n = np.unique(codes, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n.astype(np.int64))], ["code", "n"])

    counts = docs.select("_text").mapInArrow(count, "code long, n long")
    # settled, so that the join deals the shingles anew and a very frequent one is split
    counts = settle(counts.groupBy("code").agg(F.sum("n").alias("times")))
    # a window with a shingle that no document has cannot occur
    rarest = tokens.join(counts, "code").groupBy("window", "n").agg(
        F.min(F.struct("times", "code", "offset")).alias("r"), F.count("*").alias("there")
    )
    rarest = rarest.where(F.col("there") == F.col("n") - F.least("n", F.lit(shingle)) + 1)
    prefix = settle(rarest.select("window", "n", "r.code", "r.offset").join(windows.select("window", "text"), "window"))
    wanted = sent(spark, Bitmap(prefix.select("code").distinct()))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, rare = known(), wanted()
        for batch in batches:
            for rows, texts in text_slices(batch, 1):
                _, ends = words_of(texts)
                none = pa.nulls(len(rows), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.diff(ends)), none, none, none, pa.nulls(len(rows), pa.string())], names
                )
                for size, flat, ends, at, codes, text in _passing(texts, least, own, words_of):
                    some = rare.holds(codes)
                    at, codes, text = at[some], codes[some], text[some]
                    low = np.maximum(at - (width - size), ends[text])
                    high = np.minimum(at + width, ends[text + 1])
                    for k in range(0, len(at), ROWS):
                        cut = slice(k, k + ROWS)
                        around = [
                            " ".join(flat.slice(a, b - a).to_pylist())
                            for a, b in zip(low[cut].tolist(), high[cut].tolist())
                        ]
                        yield pa.RecordBatch.from_arrays(
                            [
                                rows.column(0).take(pa.array(text[cut])),
                                pa.nulls(len(around), pa.int64()),
                                pa.array(codes[cut]),
                                pa.array((at - ends[text])[cut]),
                                pa.array((at - low)[cut]),
                                pa.array(around, pa.string()),
                            ],
                            names,
                        )

    names = ["_row", "n_words", "code", "at", "before", "around"]
    schema = "_row long, n_words long, code long, at long, before long, around string"
    met = settle(docs.select("_row", "_text").mapInArrow(scan, schema))
    words = F.split("around", " ")
    same = F.array_join(F.slice(words, (F.col("before") - F.col("offset") + 1).cast("int"), F.col("n")), " ")
    hits = met.where("code IS NOT NULL").join(prefix, "code").where("before >= offset").where(same == F.col("text"))
    hits = settle(hits.select("_row", (F.col("at") - F.col("offset")).alias("start"), "n", "window"))
    return met.where("code IS NULL").select("_row", "n_words"), hits, owners


def by_document(hits: DataFrame, owners: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(_row, spans) and (_row, items) of the documents with hits: runs of words inside any
    occurrence (first, behind the last), and the ids of the items, sorted."""
    places = hits.select("_row", "start", (F.col("start") + F.col("n")).alias("end")).distinct()
    order = Window.partitionBy("_row").orderBy("start", "end")
    upto = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    places = places.withColumn("new", F.coalesce((F.col("start") > upto).cast("int"), F.lit(0)))
    places = places.withColumn("run", F.sum("new").over(order))
    spans = places.groupBy("_row", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    spans = spans.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    listed = hits.select("_row", "window").distinct().join(owners, "window").select("_row", "item").distinct()
    return spans, listed.groupBy("_row").agg(F.sort_array(F.collect_list("item")).alias("items"))
