"""Benchmark decontamination by a prefix-filtered join of windows with documents.

A benchmark item is cut into windows of consecutive words. A window's shingles are ordered
by how rare they are in the corpus; a document that holds the window must hold its rarest
shingle, so that one alone is joined. Each meeting says where the window would have to
begin; bounds on that place and on the document's length, then a comparison of all words,
confirm it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow_text import from_raw, raw, text_slices
from .benchmark_join import by_document, occurrences
from .scratch import numbered, sent, settle

#: Words of a shingle; a window of fewer words is one shingle.
SHINGLE = 3
#: Bytes of benchmark text whose windows are sent to all tasks at once. A larger benchmark
#: is taken in blocks of about this size, each against all documents.
BLOCK_BYTES = 8 << 20
#: Bytes of benchmark text, copies included, beyond which its windows are joined by shuffles.
JOIN_BYTES = 32 << 20
#: Candidates compared word by word at a time.
COMPARED = 1 << 16

# A-Z to a-z; ASCII other than letters and digits to a space; other bytes as they are
_WORD_BYTES = bytes(
    ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(128)
) + bytes(range(128, 256))


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and how many there are up to each text's start."""
    offsets, data = raw(texts)
    lists = pc.split_pattern(from_raw(offsets, bytes(data).translate(_WORD_BYTES)), " ")
    flat = lists.flatten()
    real = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    before = np.concatenate([[0], np.cumsum(real)])
    at = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
    return flat.filter(pa.array(real)), before[at]


class Windows:
    """The windows of one block of items, by number of words, as ids of the block's words
    (from 1; 0 is any other word)."""

    def __init__(self, items: list[tuple[str | None, str | None]], width: int):
        texts = pa.array([t or "" for _, t in items], pa.large_string())
        flat, ends = words_of(texts)
        codes = flat.dictionary_encode()
        self.words = codes.dictionary
        ids = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
        self.base = len(self.words) + 1
        found: dict[int, dict[tuple, set]] = {}
        for k, (item, _) in enumerate(items):
            own = ids[ends[k] : ends[k + 1]]
            size = min(width, len(own))
            for at in range(len(own) - size + 1) if size else ():
                owners = found.setdefault(size, {}).setdefault(tuple(own[at : at + size].tolist()), set())
                if item is not None:
                    owners.add(item)
        self.names = sorted({i for by in found.values() for s in by.values() for i in s})
        number = {n: k for k, n in enumerate(self.names)}
        self.rows = {s: np.array(list(by), np.int64).reshape(-1, s) for s, by in found.items()}
        self.owners = {s: [sorted(number[i] for i in o) for o in by.values()] for s, by in found.items()}
        self.tokens = {
            s: np.unique(np.concatenate([self._shingles(r, s).ravel() for r in rows]))
            for s in range(1, SHINGLE + 1)
            if (rows := [r for n, r in self.rows.items() if min(n, SHINGLE) == s])
        }

    def _shingles(self, rows: np.ndarray, size: int) -> np.ndarray:
        out = 0
        for k in range(size):
            out = out * self.base + rows[:, k : rows.shape[1] - size + 1 + k]
        return out

    def ids(self, flat: pa.Array) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(flat), np.int64)
        at = pc.index_in(flat, value_set=self.words)
        return pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1

    def meetings(self, ids: np.ndarray, ends: np.ndarray, size: int, tokens: np.ndarray):
        """Positions where one of ``tokens`` begins within a text, and which it is."""
        if len(ids) < size or not len(tokens):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        known = ids > 0
        whole = known[: len(ids) - size + 1].copy()
        for k in range(1, size):
            whole &= known[k : len(ids) - size + 1 + k]
        at = np.flatnonzero(whole)
        code = np.zeros(len(at), np.int64)
        for k in range(size):
            code = code * self.base + ids[at + k]
        which = np.searchsorted(tokens, code)
        which[which == len(tokens)] = 0
        hit = tokens[which] == code
        at, which = at[hit], which[hit]
        inside = ends[np.searchsorted(ends, at, "right")] >= at + size
        return at[inside], which[inside]

    def keep_rarest(self, counts: dict[int, np.ndarray]) -> None:
        """Per window its rarest shingle (the smaller code among equals). A window with a
        shingle that no document has cannot occur and is let go."""
        self.prefix = {}
        for n, rows in self.rows.items():
            size = min(n, SHINGLE)
            at = np.searchsorted(self.tokens[size], self._shingles(rows, size))
            order = np.lexsort(
                (np.broadcast_to(np.arange(at.shape[1]), at.shape), at, counts[size][at]), axis=1
            )[:, 0]
            token = at[np.arange(len(at)), order]
            live = counts[size][token] > 0
            where = np.flatnonzero(live)
            where = where[np.argsort(token[live], kind="stable")]
            self.prefix[n] = (size, token[where], where, order[where])

    def hits(self, ids: np.ndarray, ends: np.ndarray):
        """Each occurrence of a window in a text: (position, words, window) arrays."""
        for n, (size, token, window, offset) in self.prefix.items():
            wanted = np.unique(token)
            at, which = self.meetings(ids, ends, size, self.tokens[size][wanted])
            lo = np.searchsorted(token, wanted[which], "left")
            count = np.searchsorted(token, wanted[which], "right") - lo
            upto = np.cumsum(count)
            done = 0
            while done < len(at):
                before = upto[done - 1] if done else 0
                stop = max(done + 1, int(np.searchsorted(upto, before + COMPARED, "right")))
                cut, done = slice(done, stop), stop
                each = np.repeat(np.arange(len(at[cut])), count[cut])
                k = np.arange(len(each)) - np.repeat(np.cumsum(count[cut]) - count[cut], count[cut])
                row = lo[cut][each] + k
                start = at[cut][each] - offset[row]
                # the text the shingle is in must hold the whole window
                text = np.searchsorted(ends, at[cut][each], "right")
                first = np.where(text > 0, ends[text - 1], 0)
                fits = (start >= first) & (start + n <= ends[text])
                start, row = start[fits], row[fits]
                same = (ids[start[:, None] + np.arange(n)] == self.rows[n][window[row]]).all(axis=1)
                yield start[same], n, window[row[same]]


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t"))


def _bytes(items: DataFrame) -> int:
    return items.agg(F.sum(F.octet_length("t"))).first()[0] or 0


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list]:
    rows = settle(_items(items, id_col, text_col).distinct())  # equal items would all fall into one block
    count = -(-_bytes(rows) // BLOCK_BYTES) or 1
    for k in range(count):
        block = rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(count)) == k)
        yield sorted(((r.i, r.t) for r in block.collect()), key=repr)


def _corpus_counts(docs: DataFrame, windows: Windows) -> dict[int, np.ndarray]:
    """How often each shingle of the windows occurs in all documents."""
    get = sent(docs.sparkSession, windows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = get()
        sums = {s: np.zeros(len(t), np.int64) for s, t in own.tokens.items()}
        for batch in batches:
            for _, texts in text_slices(batch, 0):
                flat, ends = words_of(texts)
                ids = own.ids(flat)
                for s, t in own.tokens.items():
                    _, which = own.meetings(ids, ends[1:], s, t)
                    sums[s] += np.bincount(which, minlength=len(t))
        for s, total in sums.items():
            k = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(k), s, np.int32)), pa.array(k), pa.array(total[k])], ["s", "k", "n"]
            )

    found = docs.select("_text").mapInArrow(count, "s int, k long, n long")
    sums = {s: np.zeros(len(t), np.int64) for s, t in windows.tokens.items()}
    # a row per shingle of the block, which BLOCK_BYTES bounds
    for row in found.groupBy("s", "k").agg(F.sum("n").alias("n")).toLocalIterator():
        sums[row.s][row.k] = row.n
    return sums


def _scan(docs: DataFrame, windows: Windows, kind: str) -> DataFrame:
    get = sent(docs.sparkSession, windows)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = get()
        for batch in batches:
            for rows, texts in text_slices(batch, 2):
                flat, ends = words_of(texts)
                ids, total = own.ids(flat), len(flat)
                marks, pairs = np.zeros(total + 1, np.int64), []
                for start, n, window in own.hits(ids, ends[1:]):
                    np.add.at(marks, start, 1)
                    np.add.at(marks, start + n, -1)
                    text = np.searchsorted(ends[1:], start, "right")
                    pairs += [
                        (t, i)
                        for t, w in set(zip(text.tolist(), window.tolist()))
                        for i in own.owners[n][w]
                    ]
                hit = np.cumsum(marks)[:total] > 0
                edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
                # a run that goes on into the next text is cut at the text's end
                cuts = ends[1:-1][(ends[1:-1] > 0) & (ends[1:-1] < total)]
                cuts = cuts[hit[cuts - 1] & hit[cuts]]
                starts = np.sort(np.concatenate([np.flatnonzero(edge == 1), np.unique(cuts)]))
                stops = np.sort(np.concatenate([np.flatnonzero(edge == -1), np.unique(cuts)]))
                of = np.searchsorted(ends[1:], starts, "right")
                spans = [[] for _ in range(len(texts))]
                for t, s, e in zip(of.tolist(), starts.tolist(), stops.tolist()):
                    spans[t].append({"start": s - int(ends[t]), "end": e - int(ends[t])})
                names = [set() for _ in range(len(texts))]
                for t, i in pairs:
                    names[t].add(own.names[i])
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        rows.column(1),
                        pa.array(np.diff(ends)),
                        pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                        pa.array([sorted(x) for x in names], pa.list_(pa.string())),
                    ],
                    ["_row", "_id", "n_words", "spans", "items"],
                )

    schema = f"_row long, _id {kind}, n_words long, spans array<struct<start:long,end:long>>, items array<string>"
    return docs.select("_row", "_id", "_text").mapInArrow(scan, schema)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(id_col, n_words, n_hit, items, spans) per row of ``docs``.

    Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased. A window
    is ``width`` consecutive words of an item, or all words of a shorter one. ``spans`` are
    the runs of document words (from 0, end exclusive) inside any occurrence of a window,
    ``n_hit`` their number, ``items`` the ids (as text, sorted) of items with occurring
    windows. Null or empty text has no words. Items without words have no windows; an item
    with a null id hits words but is not listed. Rows with equal ids stay rows of their own,
    equal items count under each of their ids. Other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(id_col).alias("_id"),
        F.col(text_col).cast("string").alias("_text"),
    )
    items = _items(benchmark, item_col, item_text_col)
    if _bytes(items) > JOIN_BYTES:
        rows = numbered(rows.drop("_row"))
        return _joined(rows, items, width).select(F.col("_id").alias(id_col), "n_words", "n_hit", "items", "spans")
    found = []
    for block in _blocks(items, "i", "t"):
        if len(found) == 1:
            rows = settle(rows)  # the same row numbers for every block
            found = [_scan(rows, windows, kind)]
        windows = Windows(block, width)
        windows.keep_rarest(_corpus_counts(rows, windows))
        found.append(_scan(rows, windows, kind))
    out = found[0]
    if len(found) > 1:
        for more in found[1:]:
            out = out.union(more)
        out = out.groupBy("_row", "_id", "n_words").agg(
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
    covered = F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto")),
        lambda acc, s: F.struct(
            (acc.n + F.greatest(F.lit(0).cast("long"), s.end - F.greatest(s.start, acc.upto))).alias("n"),
            F.greatest(acc.upto, s.end).alias("upto"),
        ),
        lambda acc: acc.n,
    )
    return out.select(F.col("_id").alias(id_col), "n_words", covered.alias("n_hit"), "items", "spans")


def _joined(rows: DataFrame, items: DataFrame, width: int) -> DataFrame:
    """(_id, n_words, n_hit, items, spans) of numbered documents (_row, _id, _text)."""
    words, hits, owners = occurrences(rows.select("_row", "_text"), items.distinct(), width, SHINGLE, words_of)
    spans, listed = by_document(hits, owners)
    out = rows.select("_row", "_id").join(words, "_row").join(spans, "_row", "left").join(listed, "_row", "left")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s.end - s.start)
    none = F.array().cast("array<string>")
    return out.select(
        "_id",
        "n_words",
        F.coalesce(n_hit, F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", none).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start:long,end:long>>")).alias("spans"),
    )


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 10,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` without any occurrence of a window, all their columns as they
    are. A filter for each block of the benchmark; no row leaves its task. For a benchmark
    of more than ``JOIN_BYTES`` rows are numbered in a written table, and those hit are left
    out by a join."""
    items = _items(benchmark, item_col, item_text_col)
    if _bytes(items) > JOIN_BYTES:
        name = "_row"
        while name in docs.columns:
            name = f"_{name}"
        rows = numbered(docs, name)
        texts = rows.select(F.col(name).alias("_row"), F.col(text_col).cast("string").alias("_text"))
        _, hits, _ = occurrences(texts, items.distinct(), width, SHINGLE, words_of)
        return rows.join(hits.select(F.col("_row").alias(name)).distinct(), name, "left_anti").select(
            *[F.col(f"`{c}`") for c in docs.columns]
        )
    texts = docs.select(F.col(text_col).cast("string").alias("_text"))
    for block in _blocks(items, "i", "t"):
        windows = Windows(block, width)
        windows.keep_rarest(_corpus_counts(texts, windows))
        docs = docs.where(~_holds(docs.sparkSession, windows)(F.col(text_col).cast("string")))
    return docs


def _holds(spark, windows: Windows):
    get = sent(spark, windows)

    @F.pandas_udf("boolean")
    def holds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = get()
        for batch in batches:
            column = pa.array(batch, pa.large_string(), from_pandas=True)
            parts = []
            for _, texts in text_slices(pa.RecordBatch.from_arrays([column], ["_text"]), 0):
                flat, ends = words_of(texts)
                found = np.zeros(len(texts), bool)
                for start, _, _ in own.hits(own.ids(flat), ends[1:]):
                    found[np.searchsorted(ends[1:], start, "right")] = True
                parts.append(found)
            yield pd.Series(np.concatenate(parts or [np.zeros(0, bool)]))

    return holds
