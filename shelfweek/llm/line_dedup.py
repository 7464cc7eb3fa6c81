"""Substring deduplication: repeated lines and passages go, the earliest occurrence stays.

A text is a row of words (in scripts without spaces, of characters), with boundaries between
some of them: at line ends, and after the word of every stretch of 14 whose own letters give
it the smallest number, ends of sentences before others.
Units are whole lines and, as passages are often put into a line or wrapped otherwise, the
pieces from every boundary to the next one that makes them long enough: the same words give
the same pieces wherever they stand. Units are normalised (lower case, single spaces) and
hashed to 128 bits; digests are grouped over all documents, and every occurrence but the one
ranked first (by id, then row, then place) is a repeat. Repeats that touch or overlap form a
run; runs of enough words or characters are cut out, their offsets in the original text kept.
Shorter runs are chance, and stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import numbered, settle

#: Words of the shortest line and of the shortest piece that are hashed.
LINE_WORDS = 4
PIECE_WORDS = 6
#: Words of a stretch; in each of them one ends a piece.
STRETCH = 14
#: Runs of so many words, or of so many characters, are cut out.
RUN_WORDS = 20
RUN_CHARS = 130
#: Words whose numbers are remembered.
_REMEMBERED = 1 << 18

# fixed values: characters that are words by themselves (kana, CJK, Hangul), white space, and
# the ends of sentences; longer words than 16 characters are taken apart
ALONE = "\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uac00-\ud7af"
SPACE = " \\t\\n\\r\\f\\v"
WORD = re.compile(f"[{ALONE}]|[^{SPACE}{ALONE}]{{1,16}}")
ENDS = frozenset(".!?\u3002\uff01\uff1f")


class Numbers(dict):
    """The number that its letters give a word, worked out once for each word."""

    def __missing__(self, word: str) -> int:
        if len(self) > _REMEMBERED:
            self.clear()
        number = sum(map(ord, word)) * 40503 % 65521
        self[word] = number = number if word[-1] in ENDS else number + 65521
        return number


def ends(numbers: list[int]) -> list[int]:
    """Behind which words a piece ends: the first with the smallest number, of each stretch."""
    if len(numbers) < STRETCH:
        return []
    stretches = np.lib.stride_tricks.sliding_window_view(np.array(numbers, np.int32), STRETCH)
    least = stretches.argmin(1) + np.arange(len(stretches))
    return (least[np.concatenate([[True], np.diff(least) > 0])] + 1).tolist()


def units(text: str, numbers: dict[str, int]) -> Iterator[tuple[int, int, str]]:
    """(first word, number of words, normalised text) of the lines and pieces long enough."""
    words: list[str] = []
    line_ends = [0]
    for line in text.split("\n"):
        own = WORD.findall(line)
        if own:
            words += " ".join(own).lower().split(" ")
            line_ends.append(len(words))
    bounds = sorted({*line_ends, *ends([numbers[w] for w in words])})
    lines = {a: b for a, b in zip(line_ends, line_ends[1:]) if b - a >= LINE_WORDS}
    stop = 0
    for at in bounds:
        while stop < len(bounds) and bounds[stop] < at + PIECE_WORDS:
            stop += 1
        end = bounds[stop] if stop < len(bounds) else at
        if end > at:
            yield at, end - at, " ".join(words[at:end])
        upto = lines.get(at, end)
        if upto != end:
            yield at, upto - at, " ".join(words[at:upto])


def _unit_rows(docs: DataFrame, kind: str) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                of, first, count, digests = [], [], [], []
                for k, text in enumerate(part.column(2)):
                    for start, n, key in units(text.as_py() or "", numbers):
                        of.append(k)
                        first.append(start)
                        count.append(n)
                        digests.append(xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass")))
                halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                rows = pa.array(of, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(rows),
                        part.column(1).take(rows),
                        pa.array(np.array(first, np.int64) << 32 | np.array(count, np.int64)),
                        pa.array(np.ascontiguousarray(halves[:, 0])),
                        pa.array(np.ascontiguousarray(halves[:, 1])),
                    ],
                    ["_row", "_id", "place", "h1", "h2"],
                )

    # a place is the first word above bit 32, the number of words below
    return docs.mapInArrow(read, f"_row long, _id {kind}, place long, h1 long, h2 long")


def repeats(rows: DataFrame, kind: str) -> DataFrame:
    """(_row, place, first): the units of ``rows`` (_row, _id, _text) that repeat another, and
    the id of the document that keeps it. A unit may lie in another that repeats as well."""
    found = settle(_unit_rows(rows, kind))
    # first by half a digest and a count, which shuffles little, then the few that repeat
    repeated = found.groupBy("h1").agg(F.count("*").alias("copies")).where("copies > 1")
    # joined by another key than counted by, so that both sides are dealt anew and the units
    # of a digest with very many can be split
    repeated = repeated.select(F.bitwise_not("h1").alias("_k"))
    found = settle(found.join(repeated, F.bitwise_not("h1") == F.col("_k"), "left_semi"))
    rank = F.struct(F.col("_id").isNull().alias("n"), "_id", "_row", "place")
    firsts = found.groupBy("h1", "h2").agg(F.min(rank).alias("f"), F.count("*").alias("copies"))
    # settled, so that the join deals the units anew and a digest with very many is split
    firsts = settle(firsts.where("copies > 1").select("h1", "h2", "f"))
    gone = found.join(firsts, ["h1", "h2"]).where("NOT (_row = f._row AND place = f.place)")
    return gone.select("_row", "place", F.col("f._id").alias("first"))


def runs(found: list[tuple]) -> list[tuple]:
    """(first word, word after the last, first) of the runs of units (first word, number of
    words, first). ``first`` is that of the unit it begins with, the longest one."""
    out: list[tuple] = []
    for start, n, first in sorted(found, key=lambda u: (u[0], -u[1])):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], start + n), out[-1][2])
        else:
            out.append((start, start + n, first))
    return out


def dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_words: int = RUN_WORDS,
    least_chars: int = RUN_CHARS,
) -> DataFrame:
    """(id_col, n_removed, removed_chars, spans, text) per row: ``spans`` are the runs cut out
    (start, end, first) in code points of the original text, end exclusive, ``first`` the id
    that keeps what the run begins with. ``text`` is what is left, otherwise unchanged: the
    space around a run stays. Runs of fewer than ``least_words`` words and fewer than
    ``least_chars`` characters stay.

    Null text counts as empty and stays null. Equal ids: the row read first keeps the unit.
    Null ids rank last. Repeats within one document go too. Other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    rows = numbered(rows).select("_row", "_id", "_text")
    spans = (
        repeats(rows, kind)
        .groupBy("_row")
        .agg(F.collect_list(F.struct("place", "first")).alias("units"))
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                left, lists, lost = [], [], []
                for text, found in zip(part.column(1), part.column(2)):
                    text, found = text.as_py(), found.as_py() or []
                    units = [(u["place"] >> 32, u["place"] & 0xFFFFFFFF, u["first"]) for u in found]
                    words = [m.span() for m in WORD.finditer(text)] if units else []
                    kept = [
                        {"start": words[a][0], "end": words[b - 1][1], "first": first}
                        for a, b, first in runs(units)
                        if b - a >= least_words or words[b - 1][1] - words[a][0] >= least_chars
                    ]
                    pieces, upto = [], 0
                    for span in kept:
                        pieces.append(text[upto : span["start"]])
                        upto = span["end"]
                    left.append("".join(pieces) + text[upto:] if kept else text)
                    lists.append(kept)
                    lost.append(len(text or "") - len(left[-1] or ""))
                kinds = pa.list_(
                    pa.struct([("start", pa.int32()), ("end", pa.int32()), ("first", part.column(0).type)])
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lost, pa.int64()), pa.array(lists, kinds), pa.array(left, pa.string())],
                    ["_id", "removed_chars", "spans", "text"],
                )

    joined = rows.join(spans, "_row", "left").select("_id", "_text", "units")
    schema = f"_id {kind}, removed_chars long, spans array<struct<start:int,end:int,first:{kind}>>, text string"
    out = joined.mapInArrow(cut, schema)
    return out.select(
        F.col("_id").alias(id_col),
        F.size("spans").cast("long").alias("n_removed"),
        "removed_chars",
        "spans",
        "text",
    )
