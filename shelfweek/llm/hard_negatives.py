"""Hard negatives by exact integer scores, multiplied in a residue number system.

Components are whole numbers. A block of anchors and a batch of rows are reduced modulo a few
small primes, to residues so small that the products of their matrices are exact in float32;
from the residues of a score the Chinese remainder theorem gives back the signed score itself.
How many primes it takes follows from the longest vectors. Windows of scores are then cut from
these exact numbers: first the best rows of an anchor's own label, then, for each of them, the
best rows of other labels within a window below its score.

Anchors go to the tasks in blocks of bounded size, and every block meets all rows where these
are read: rows are never shuffled, only a few candidates of each task are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfweek.sinks.files import forget

from .scratch import sent, settle

#: Components multiplied at a time. With residues up to 254 a product stays below 2^24.
DEPTH = 256
LARGEST_PRIME = 509
#: Bytes of anchor components (8 each) in a block sent to the tasks; one vector at least.
BLOCK_BYTES = 8 << 20
#: Anchors and rows of a tile of scores.
TILE = (256, 8192)

_NONE = np.iinfo(np.int64).min  # the score of a place not taken
_NO_ID = np.iinfo(np.int64).max  # stands for a null id, which ranks last among equal scores


def primes_for(bound: float) -> list[int]:
    """Primes whose product is over four times ``bound``, the largest first."""
    found, product, p = [], 1, LARGEST_PRIME
    while product <= 4 * bound + 4:
        while any(p % d == 0 for d in range(3, int(p**0.5) + 1, 2)):
            p -= 2
        found.append(p)
        product, p = product * p, p - 2
    return found


def residues(components: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """Per prime the components' residues, as near to zero as can be."""
    out = []
    for p in primes:
        r = np.mod(components, p)  # exact for any double
        out.append(np.where(r > p // 2, r - p, r).astype(np.float32))
    return out


def _balanced(x: np.ndarray, p: int) -> np.ndarray:
    return x - p * np.rint(x * np.float32(1 / p))


def scores(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all rows of ``b``, from residues.

    Digits of the mixed radix are taken around zero, so the sum of digits times radices is
    the signed score; int64 wraps on the way, which does not change the outcome.
    """
    depth = a[0].shape[1]
    digits: list[np.ndarray] = []
    total = np.zeros((len(a[0]), len(b[0])), np.int64)
    radix = 1
    for k, p in enumerate(primes):
        r = np.zeros(total.shape, np.float32)
        for at in range(0, depth, DEPTH):
            r = _balanced(r + _balanced(a[k][:, at : at + DEPTH] @ b[k][:, at : at + DEPTH].T, p), p)
        for digit, q in zip(digits, primes):
            r = _balanced((r - digit) * pow(q, -1, p), p)
        digits.append(r)
        # a radix beyond 2^63 only ever meets digits of zero
        total += r.astype(np.int64) * np.int64((radix + (1 << 63)) % (1 << 64) - (1 << 63))
        radix *= p
    return total


class Best:
    """The best ``k`` (score, id) of every key: larger scores first, smaller ids among equals."""

    def __init__(self, keys: int, k: int):
        self.scores = np.full((keys, k), _NONE)
        self.ids = np.full((keys, k), _NO_ID)

    def add(self, keys: np.ndarray, found: np.ndarray, ids: np.ndarray) -> None:
        last, last_id = self.scores[keys, -1], self.ids[keys, -1]
        better = (found > last) | ((found == last) & (ids < last_id))
        keys, found, ids = keys[better], found[better], ids[better]
        own, at = np.unique(keys, return_inverse=True)
        n, k = len(own), self.scores.shape[1]
        keys = np.concatenate([np.repeat(np.arange(n), k), at])
        found = np.concatenate([self.scores[own].ravel(), found])
        ids = np.concatenate([self.ids[own].ravel(), ids])
        order = np.lexsort((ids, ~found, keys))
        count = np.bincount(keys, minlength=n)
        first = np.cumsum(count) - count
        order = order[(first[:, None] + np.arange(k)).ravel()]
        self.scores[own], self.ids[own] = found[order].reshape(n, k), ids[order].reshape(n, k)


class Block:
    """Anchors of one length, as sent to the tasks."""

    def __init__(self, rows: list, primes: list[int]):
        self.rows = np.array([r["_row"] for r in rows], np.int64)
        self.ids = [r["_id"] for r in rows]
        self.labels = np.array([r["_label"] for r in rows], np.int64)
        size = rows[0]["size"]
        components = np.frombuffer(b"".join(r["components"] for r in rows), "<f8")
        self.components = residues(components.reshape(len(rows), size), primes)
        self.positives: Best | None = None


def _batches(batch: pa.RecordBatch, size: int, primes: list[int]) -> Iterator[tuple]:
    """Rows of one length: their numbers, ids, labels and residues, a tile at a time."""
    own = batch.filter(pa.compute.equal(batch.column("size"), size))
    for at in range(0, own.num_rows, TILE[1]):
        part = own.slice(at, TILE[1])
        components = b"".join(part.column("components").to_pylist())
        components = np.frombuffer(components, "<f8").reshape(part.num_rows, size)
        ids = part.column("_id").fill_null(_NO_ID).to_numpy(zero_copy_only=False)
        yield (
            part.column("_row").to_numpy(),
            ids,
            part.column("_label").to_numpy(),
            residues(components, primes),
        )


def _window(score: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores x with least * score <= 100 * x <= most * score, as whole bounds."""
    whole, rest = np.divmod(score, 100)
    low, high = least * whole - (-least * rest) // 100, most * whole + (most * rest) // 100
    none = score == _NONE
    return np.where(none, 1, low), np.where(none, 0, high)


def _search(blocks: dict[int, Block], primes: list[int], k: int, windows: tuple | None):
    """A function for mapInArrow: the best ``k`` of its rows for each anchor, or, with
    ``windows`` (percents), for each anchor and positive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = blocks()
        slots = {s: 1 if windows is None else b.positives.scores.shape[1] for s, b in own.items()}
        best = {s: Best(len(b.rows) * slots[s], k) for s, b in own.items()}
        limits = {}
        if windows is not None:
            limits = {s: _window(b.positives.scores, *windows) for s, b in own.items()}
        for batch in batches:
            for size, block in own.items():
                for number, ids, labels, matrix in _batches(batch, size, primes):
                    for at in range(0, len(block.rows), TILE[0]):
                        part = slice(at, at + TILE[0])
                        found = scores([m[part] for m in block.components], matrix, primes)
                        same = block.labels[part, None] == labels
                        for slot in range(slots[size]):
                            if windows is None:
                                fits = same & (block.rows[part, None] != number)
                            else:
                                low, high = (x[part, slot, None] for x in limits[size])
                                fits = ~same & (found >= low) & (found <= high)
                            key = np.arange(at, at + len(found)) * slots[size] + slot
                            fits &= found >= best[size].scores[key, -1][:, None]
                            i, j = np.nonzero(fits)
                            best[size].add(key[i], found[i, j], ids[j])
        for size, top in best.items():
            i, j = np.nonzero(top.scores != _NONE)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(i), size, np.int32)),
                    pa.array(i // slots[size]),
                    pa.array((i % slots[size]).astype(np.int32)),
                    pa.array(top.scores[i, j]),
                    pa.array(top.ids[i, j]),
                ],
                ["size", "anchor", "slot", "score", "_id"],
            )

    return run


_FOUND = "size int, anchor long, slot int, score long, _id long"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of all tasks' candidates, with their rank from 0."""
    order = Window.partitionBy("size", "anchor", "slot").orderBy(F.desc("score"), "_id")
    return found.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < k)


def prepared(
    vectors: DataFrame, anchor: Column, id_col: str, vec_col: str, label_col: str, scale: int
) -> DataFrame:
    """The rows that take part, settled: number, id, label, length and the components'
    floor(scale * x) as little-endian doubles, with their squared length."""
    vector = F.col(vec_col).cast("array<double>")
    rows = vectors.select(
        F.col(id_col).cast("long").alias("_id"),
        F.col(label_col).cast("long").alias("_label"),
        F.coalesce(anchor, F.lit(False)).alias("_anchor"),
        vector.alias("_vec"),
    ).where("_label IS NOT NULL AND forall(_vec, x -> x IS NOT NULL AND abs(x) < double('inf'))")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = batch.column(3)
            size = vec.value_lengths().to_numpy(zero_copy_only=False)
            whole = np.floor(vec.flatten().to_numpy(zero_copy_only=False) * scale)
            ends = np.concatenate([[0], np.cumsum(size)])
            squares = np.concatenate([[0.0], np.cumsum(whole * whole)])
            packed = [whole[s:e].astype("<f8").tobytes() for s, e in zip(ends, ends[1:])]
            # sums of differences may lose what a huge neighbour takes: then row by row
            length = np.diff(squares[ends])
            if squares[-1] >= 2.0**53:
                length = np.array([np.square(whole[s:e]).sum() for s, e in zip(ends, ends[1:])])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    batch.column(2),
                    pa.array(size.astype(np.int32)),
                    pa.array(np.asarray(length, float)),
                    pa.array(packed, pa.binary()),
                ],
                ["_id", "_label", "_anchor", "size", "square", "components"],
            )

    schema = "_id long, _label long, _anchor boolean, size int, square double, components binary"
    return settle(rows.mapInArrow(read, schema).withColumn("_row", F.monotonically_increasing_id()))


def mine(
    vectors: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 5,
    least: int = 80,
    most: int = 100,
    scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor`` says which rows of ``vectors`` are anchors. A component x counts as the whole
    number floor(scale * x), a score is the inner product with the anchor; higher scores come
    first, smaller ids among equals. An anchor's positives are its first other rows of the
    same label; for each of them, its negatives are the first rows of other labels whose
    score is ``least`` to ``most`` percent of the positive's (100 at most), ranked from 1.

    Rows with a null label, a null vector, or a null or non-finite component take no part.
    Labels and ids are whole numbers; a null id ranks last among equal scores and stays null.
    Repeated rows are rows of their own: an equal copy of an anchor is an anchor too, and one
    of its positives. Vectors of different lengths have no score and are never compared.
    Empty tables, and tables without anchors, give an empty result. Other columns are not
    read. Vectors so long that a score might not fit a long are an error.
    """
    spark = vectors.sparkSession
    rows = prepared(vectors, anchor, id_col, vec_col, label_col, scale)
    anchors = rows.where("_anchor")
    longest = rows.agg(
        F.coalesce(F.max("square"), F.lit(0.0)).alias("any"),
        F.coalesce(F.max(F.when(F.col("_anchor"), F.col("square"))), F.lit(0.0)).alias("anchor"),
        F.coalesce(F.sum(F.when(F.col("_anchor"), F.col("size") + 1)), F.lit(0)).alias("held"),
    ).first()
    bound = (longest["any"] * longest["anchor"]) ** 0.5 * (1 + 1e-9) + 1
    if not bound < 2.0**63:
        raise ValueError("vectors are too long: a score might not fit a long")
    primes = primes_for(bound)
    parts = -(-8 * longest["held"] // BLOCK_BYTES)
    schema = (
        "anchor_id long, positive_id long, rank int, negative_id long, "
        "positive_score long, negative_score long"
    )
    done = [spark.createDataFrame([], schema)]
    for part in range(parts):
        chosen = F.pmod(F.xxhash64("_row"), F.lit(parts)) == part
        by_size: dict[int, list] = {}
        for row in anchors.where(chosen).collect():  # a block of bounded size
            by_size.setdefault(row["size"], []).append(row)
        blocks = {size: Block(own, primes) for size, own in by_size.items()}
        found = rows.mapInArrow(_search(sent(spark, blocks), primes, positives, None), _FOUND)
        for block in blocks.values():
            block.positives = Best(len(block.rows), positives)
        for r in _ranked(found, positives).collect():  # as many as positives of the block
            best = blocks[r["size"]].positives
            best.scores[r["anchor"], r["rank"]], best.ids[r["anchor"], r["rank"]] = r["score"], r["_id"]
        again = sent(spark, blocks)
        found = rows.mapInArrow(_search(again, primes, negatives, (least, most)), _FOUND)
        done.append(settle(_named(_ranked(found, negatives), again, schema)))
    forget(rows)
    return reduce(DataFrame.union, done)


def _named(ranked: DataFrame, blocks, schema: str) -> DataFrame:
    """Places in a block as ids and scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = blocks()

        def ids(values):
            return pa.array([None if x is None or x == _NO_ID else x for x in values], pa.int64())

        for batch in batches:
            found = batch.to_pylist()
            place = [(own[r["size"]], r["anchor"], r["slot"]) for r in found]
            yield pa.RecordBatch.from_arrays(
                [
                    ids([b.ids[a] for b, a, _ in place]),
                    ids([int(b.positives.ids[a, s]) for b, a, s in place]),
                    pa.array([r["rank"] + 1 for r in found], pa.int32()),
                    ids([r["_id"] for r in found]),
                    pa.array([int(b.positives.scores[a, s]) for b, a, s in place], pa.int64()),
                    pa.array([r["score"] for r in found], pa.int64()),
                ],
                ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
            )

    return ranked.mapInArrow(run, schema)
