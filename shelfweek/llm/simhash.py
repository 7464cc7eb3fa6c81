"""SimHash near-duplicates by joining a binary trie of fingerprints with itself.

A pair of trie nodes is carried down together with the bits in which their prefixes
differ; it is dropped as soon as these exceed the budget. Nodes with few fingerprints are
not opened further: their fingerprints meet in one task, which goes on down the same trie
in vectorised steps. How deep the distributed part goes follows from the counts, so a
crowded part of the trie is opened deeper, and a task never sees more than two leaves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import Forest, components
from .scratch import numbered, settle

#: Fingerprints in a trie node that is handed to a task, at most (but at full depth).
LEAF = 2048
#: Bits by which the distributed part goes down at a time.
STRIDE = 3
#: Shingles hashed at a time, which bounds the memory that one long text takes.
SLICE = 1 << 16


def text_fingerprint(text: bytes | None, shingle: int) -> int:
    """64 bits: each set if set in over half of the shingles' XXH64 (seed 42), repeats
    included. Fewer words than a shingle: the whole sequence; none or null: zero."""
    words = (text or b"").lower().split()  # both ASCII only on bytes
    if not words:
        return 0
    size = min(shingle, len(words))
    joined, total = b" ".join(words), len(words) - size + 1
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts, ends = (ends - lengths)[:total], ends[size - 1 :]
    ones = np.zeros(64, np.int64)
    for at in range(0, total, SLICE):
        cut = slice(at, at + SLICE)
        hashes = np.array(
            [
                xxhash.xxh64_intdigest(joined[s:e], 42)
                for s, e in zip(starts[cut].tolist(), ends[cut].tolist())
            ],
            "<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    most = (ones * 2 > total).astype(np.uint8)
    return int(np.packbits(most, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col="doc_id", text_col="text") -> DataFrame:
    """(id_col, fp): a fingerprint per row, as a signed long. Words are runs of characters
    other than ASCII white space, A-Z lower-cased."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = [text_fingerprint(t.as_py(), shingle) for t in texts]
            fp = pa.array(np.array(found, "<u8").view("<i8"))
            yield pa.RecordBatch.from_arrays([batch.column(0), fp], ["_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(read, f"_id {kind}, fp long").withColumnRenamed("_id", id_col)


def _split(sorted_fps, lo, hi, bit):
    """Where, in each run lo:hi of equal prefixes, the fingerprints with ``bit`` begin."""
    prefix = sorted_fps[lo] & ~np.uint64((int(bit) << 1) - 1)
    return np.clip(np.searchsorted(sorted_fps, prefix | bit), lo, hi)


def leaf_links(a: np.ndarray, b: np.ndarray, depth: int, diff: int, budget: int) -> np.ndarray:
    """Pairs of positions in the sorted arrays within ``budget`` bits, joined into a forest:
    rows (position, smaller position) over a followed by b. ``a is b``: each pair once."""
    same = a is b
    n, offset = len(a) + (0 if same else len(b)), 0 if same else len(a)
    forest = Forest(n)
    pairs = np.array([[0, len(a), 0, len(b), diff]])
    for level in range(depth, 65):
        al, ah, bl, bh, bits = pairs.T
        few = ((ah - al) * (bh - bl) <= 32) | (level == 64)
        # few against few: compare them all, a bounded number at a time
        rest, pairs = pairs[few], pairs[~few]
        sizes = (rest[:, 1] - rest[:, 0]) * (rest[:, 3] - rest[:, 2])
        for at in range(0, len(rest), 1 << 15):
            part, size = rest[at : at + (1 << 15)], sizes[at : at + (1 << 15)]
            row = np.repeat(np.arange(len(part)), size)
            k = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
            width = (part[:, 3] - part[:, 2])[row]
            i, j = part[row, 0] + k // width, part[row, 2] + k % width
            near = np.bitwise_count(a[i] ^ b[j]) <= budget
            if same:
                near &= i < j
            forest.join(i[near], j[near] + offset)
        if not len(pairs):
            break
        al, ah, bl, bh, bits = pairs.T
        bit = np.uint64(1 << (63 - level))
        am, bm = _split(a, al, ah, bit), _split(b, bl, bh, bit)
        own = same & (al == bl)
        pairs = np.concatenate(
            [
                np.stack(x, 1)
                for x in (
                    (al, am, bl, bm, bits),
                    (am, ah, bm, bh, bits),
                    (al, am, bm, bh, bits + 1),
                    (am[~own], ah[~own], bl[~own], bm[~own], bits[~own] + 1),
                )
            ]
        )
        pairs = pairs[(pairs[:, 0] < pairs[:, 1]) & (pairs[:, 2] < pairs[:, 3])]
        pairs = pairs[pairs[:, 4] <= budget]
    return np.stack(forest.links(), 1)


def _prefix(depth: int):
    return F.lit(0).cast("long") if depth == 0 else F.shiftrightunsigned("fp", 64 - depth)


def trie_links(fps: DataFrame, budget: int = 2, leaf: int = LEAF, stride: int = STRIDE) -> DataFrame:
    """(a, b): links that connect just the distinct fingerprints ``fp`` reachable from one
    another over pairs within ``budget`` differing bits. Not all such pairs: a task hands on
    a forest, so a thousand near copies give a thousand rows, not a million."""
    spark = fps.sparkSession
    masks = [(m, m.bit_count()) for m in range(1 << stride) if m.bit_count() <= budget]
    turns = F.explode(
        F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.lit(n).alias("n")) for m, n in masks])
    )

    def nodes(depth):
        return fps.groupBy(_prefix(depth).alias("p")).agg(F.count("*").alias("n"))

    def sized(pairs, own):
        left = own.select("p", F.col("n").alias("n_p"))
        right = own.select(F.col("p").alias("q"), F.col("n").alias("n_q"))
        return settle(pairs.join(left, "p").join(right, "q"))

    depth, closed, total = 0, [], F.lit(fps.count())
    pairs = spark.range(1).select(
        F.col("id").alias("p"),
        F.col("id").alias("q"),
        F.lit(0).alias("diff"),
        total.alias("n_p"),
        total.alias("n_q"),
    )
    while True:
        small = (F.col("n_p") <= leaf) & (F.col("n_q") <= leaf) | F.lit(depth == 64)
        closed.append((depth, pairs.where(small)))
        opened = pairs.where(~small)
        if depth == 64 or opened.isEmpty():
            break
        step = min(stride, 64 - depth)
        depth += step
        own = settle(nodes(depth))
        low = (1 << step) - 1
        child = own.select(
            F.shiftrightunsigned("p", step).alias("p"),
            F.col("p").bitwiseAND(F.lit(low)).alias("c"),
        )
        grown = opened.select("p", "q", "diff").join(child, "p").withColumn("t", turns)
        grown = grown.where((F.col("t.m") <= low) & (F.col("diff") + F.col("t.n") <= budget))
        p = F.shiftleft("p", step).bitwiseOR(F.col("c"))
        q = F.shiftleft("q", step).bitwiseOR(F.col("c").bitwiseXOR(F.col("t.m")))
        grown = grown.where((F.col("p") != F.col("q")) | (p <= q))
        grown = grown.select(
            p.alias("p"), q.alias("q"), (F.col("diff") + F.col("t.n")).cast("int").alias("diff")
        )
        pairs = sized(grown, own)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                a = np.sort(np.frombuffer(row["left"], ">u8").astype(np.uint64))
                b = a if row["p"] == row["q"] else None
                if b is None:
                    b = np.sort(np.frombuffer(row["right"], ">u8").astype(np.uint64))
                found = leaf_links(a, b, row["depth"], row["diff"], budget)
                both = (a if a is b else np.concatenate([a, b])).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(both[found[:, 0]]), pa.array(both[found[:, 1]])], ["a", "b"]
                )

    links = []
    for depth, pairs in closed:
        wanted = pairs.select("p").union(pairs.select("q")).distinct()
        # bounded: closed nodes hold `leaf` fingerprints at most, or one at full depth
        packed = (
            fps.withColumn("p", _prefix(depth))
            .join(wanted, "p", "left_semi")
            .groupBy("p")
            .agg(
                F.unhex(F.array_join(F.collect_list(F.lpad(F.hex("fp"), 16, "0")), "")).alias("left")
            )
        )
        right = packed.select(F.col("p").alias("q"), F.col("left").alias("right"))
        met = pairs.join(packed, "p").join(right, "q")
        met = met.select("p", "q", "diff", F.lit(depth).alias("depth"), "left", "right")
        links.append(met.mapInArrow(link, "a long, b long"))
    out = links[0]
    for more in links[1:]:
        out = out.union(more)
    return out


def _grouped(rows: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    """(_row, _id, fp, first) of rows (_row, _id, _text): ``first`` is the row ranked first of
    all reachable ones, as (null id?, _id, _row)."""
    rows = rows.select(F.struct("_id", "_row").alias("_own"), "_text")
    prints = fingerprints(rows, shingle, "_own", "_text").select("_own._id", "_own._row", "fp")
    prints = settle(prints)
    rank = F.struct(F.col("_id").isNull().alias("n"), "_id", "_row")
    classes = settle(prints.groupBy("fp").agg(F.min(rank).alias("first")))
    roots = components(trie_links(classes.select("fp"), max_bits), "a", "b")
    roots = roots.select(F.col("node").alias("fp"), "root")
    rooted = classes.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = settle(rooted)
    least = rooted.groupBy("root").agg(F.min("first").alias("first"))
    return prints.join(rooted.select("fp", "root").join(least, "root").select("fp", "first"), "fp")


def near_duplicates(
    docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id_col, fingerprint, component_id) per row: documents whose fingerprints differ in
    ``max_bits`` bits or fewer are linked; component_id is the smallest id reachable.

    Null and empty texts have the fingerprint zero and are linked like any other. Rows with
    equal ids stay rows of their own. A null id is a member but never a component_id, unless
    a component has no other: then it is null. Other columns are not read. An empty table
    gives an empty result. Equal fingerprints are one entry of the trie.
    """
    # numbered in the one read that the fingerprints are written from
    number = F.monotonically_increasing_id().alias("_row")
    rows = docs.select(number, F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return _grouped(rows, shingle, max_bits).select(
        F.col("_id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first._id").alias("component_id"),
    )


def one_of_each(
    docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Of each group of near duplicates the row with the smallest id (a null id only where
    there is no other; the row read first among equals), all its columns as they are. The
    rows are written once, numbered."""
    rows = numbered(docs.select(F.struct("*").alias("_own")))
    own = F.col("_own")
    groups = _grouped(
        rows.select("_row", own.getField(id_col).alias("_id"), own.getField(text_col).alias("_text")),
        shingle,
        max_bits,
    )
    gone = groups.where("_row <> first._row").select("_row")
    return rows.join(gone, "_row", "left_anti").select("_own.*")
