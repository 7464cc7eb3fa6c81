"""Embedding near-duplicates by an epsilon grid order join.

Vectors of length one within an angle are points within a distance eps. They are put in the
order of their cells on the leading principal dimensions (a grid of side eps) and cut into
blocks of that sequence. Intervals of the sequence are joined with one another from long to
short: runs of partitions, partitions, then blocks, then halves of blocks within a task; two
whose bounding boxes are more than eps apart are skipped, since no pair in them can be near.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import Forest, components
from .scratch import sent, settle

#: Leading dimensions of the grid order, and of the bounding boxes.
GRID_DIMENSIONS = 4
BOX_DIMENSIONS = 16
BLOCK = 1024
#: Vectors of a partition of the sequence, about.
PARTITION = 16384
#: Intervals that a longer one is opened into, and the most that all meet one another.
FAN = 64
#: Halving stops at so many vectors.
SMALLEST = 64
#: Pairs of blocks handed to a task, about, which with BLOCK bounds its memory.
PAIRS_AT_ONCE = 16


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square over- or underflows."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _stored(classes: DataFrame) -> str:
    """How a block holds the numbers of its vectors: as the column does."""
    kind = classes.schema["vector"].dataType.elementType.simpleString()
    return "<f4" if kind == "float" else "<f8"


def _rows_of(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def principal_axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """By vector length the orthogonal axes of all unit vectors, the widest first. Tasks add
    up their own products; the driver gets length squared sums for each vector length."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column(0)])
            for size in np.unique(sizes).tolist():
                own = unit(_rows_of(batch.column(0).take(pa.array(np.flatnonzero(sizes == size))), size))
                sums[size] = sums.get(size, 0) + own.T @ own
        for size, s in sums.items():
            i, j = np.triu_indices(size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), size, np.int32)), pa.array(i.astype(np.int32)),
                 pa.array(j.astype(np.int32)), pa.array(s[i, j])],
                ["size", "i", "j", "s"],
            )

    found = classes.select("vector").mapInArrow(add, "size int, i int, j int, s double")
    sums: dict[int, np.ndarray] = {}
    for r in found.groupBy("size", "i", "j").agg(F.sum("s").alias("s")).toLocalIterator():
        own = sums.setdefault(r.size, np.zeros((r.size, r.size)))
        own[r.i, r.j] = own[r.j, r.i] = r.s
    return {size: np.linalg.eigh(s)[1][:, ::-1] for size, s in sums.items()}


def _blocks(classes: DataFrame, axes, eps: float, n: int) -> DataFrame:
    """The classes in grid order, cut into blocks: (part, block, label, size, low, high, ids,
    copies, vectors), low and high the corners of the bounding box."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = axes()
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column(2)], np.int64)
            cells = np.zeros((batch.num_rows, GRID_DIMENSIONS), np.int32)
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                at = unit(_rows_of(batch.column(2).take(pa.array(rows)), size)) @ own[size]
                k = min(size, GRID_DIMENSIONS)
                cells[rows, :k] = np.floor(at[:, :k] / eps)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sizes.astype(np.int32)), *[pa.array(c) for c in cells.T.copy()]],
                ["_class", "label", "vector", "copies", "size", *[f"c{k}" for k in range(GRID_DIMENSIONS)]],
            )

    kind, stored = classes.schema["label"].dataType.simpleString(), _stored(classes)
    vector = classes.schema["vector"].dataType.simpleString()
    cells = [f"c{k}" for k in range(GRID_DIMENSIONS)]
    schema = f"_class long, label {kind}, vector {vector}, copies long, size int, " + ", ".join(
        f"{c} int" for c in cells
    )
    order = ["label", "size", *cells, "_class"]
    placed = classes.select("_class", "label", "vector", "copies").mapInArrow(place, schema)
    placed = placed.repartitionByRange(-(-n // PARTITION), *order).sortWithinPartitions(*order)
    placed = placed.select(F.spark_partition_id().alias("part"), "label", "size", "_class", "copies", "vector")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, number, held = axes(), 0, []

        def block(rows: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal number
            size = rows.column(2)[0].as_py()
            vectors = _rows_of(rows.column(5), size)
            at = (unit(vectors) @ own[size])[:, :BOX_DIMENSIONS]
            number += 1
            return pa.RecordBatch.from_arrays(
                [
                    rows.column(0).slice(0, 1),
                    pa.array([number], pa.int32()),
                    rows.column(1).slice(0, 1),
                    rows.column(2).slice(0, 1),
                    pa.array([at.min(axis=0).tolist()]),
                    pa.array([at.max(axis=0).tolist()]),
                    pa.array([rows.column(3).to_numpy().astype("<i8").tobytes()]),
                    pa.array([rows.column(4).to_numpy().astype("<i8").tobytes()]),
                    pa.array([vectors.astype(stored).tobytes()], pa.binary()),
                ],
                ["part", "block", "label", "size", "low", "high", "ids", "copies", "vectors"],
            )

        def joined():
            return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

        for batch in batches:
            keys = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            at = 0
            while at < len(keys):
                key, held_rows = keys[at], sum(b.num_rows for b in held)
                if held and (held_key != key or held_rows == BLOCK):
                    yield block(joined())
                    held, held_rows = [], 0
                stop = at
                while stop < len(keys) and keys[stop] == key and held_rows + stop - at < BLOCK:
                    stop += 1
                held.append(batch.slice(at, stop - at))
                held_key, at = key, stop
        if held:
            yield block(joined())

    boxes = "low array<double>, high array<double>, ids binary, copies binary, vectors binary"
    return settle(placed.mapInArrow(cut, f"part int, block int, label {kind}, size int, {boxes}"))


def _gap(a: str, b: str):
    """Square of the least distance between two boxes."""
    apart = F.zip_with(
        F.arrays_zip(F.col(f"{a}.low"), F.col(f"{a}.high")),
        F.arrays_zip(F.col(f"{b}.low"), F.col(f"{b}.high")),
        lambda x, y: F.greatest(x["low"] - y["high"], y["low"] - x["high"], F.lit(0.0)),
    )
    return F.aggregate(apart, F.lit(0.0), lambda acc, d: acc + d * d)


def _corners(boxes: DataFrame, span: int = 1) -> DataFrame:
    """The bounding box of each run of ``span`` partitions (or runs) of a label."""

    def corner(side, pick):
        return F.array(*[pick(F.get(side, F.lit(k))) for k in range(BOX_DIMENSIONS)])

    run = F.floor(F.col("part") / span).cast("int").alias("part")
    box = boxes.groupBy(run, "label", "size").agg(
        corner("low", F.min).alias("low"), corner("high", F.max).alias("high")
    )
    # vectors with fewer dimensions have shorter corners
    return box.select(
        "part", "label", "size", *[F.filter(c, lambda x: x.isNotNull()).alias(c) for c in ("low", "high")]
    )


def near_partitions(parts: DataFrame, count: int, eps: float) -> DataFrame:
    """(label, size, part_a, part_b): the pairs part_a <= part_b of partitions of a label that
    are near. ``parts`` has their boxes, numbered below ``count`` in order of the sequence.
    Runs of partitions are paired first and only near runs are opened, so that the pairs looked
    at follow those that are near; all meet one another among at most ``FAN`` runs."""
    levels = [parts]
    while count > FAN:
        count = -(-count // FAN)
        levels.append(settle(_corners(levels[-1], FAN)))
    keys, near = ["label", "size"], None
    for boxes in reversed(levels):
        sides = [
            boxes.select(
                *keys,
                F.struct("part", "low", "high").alias(side),
                F.floor(F.col("part") / FAN).cast("int").alias(f"part_{side}"),
            )
            for side in "ab"
        ]
        if near is None:
            near = sides[0].drop("part_a").join(sides[1].drop("part_b"), keys)
        else:
            near = near.join(sides[0], [*keys, "part_a"]).join(sides[1], [*keys, "part_b"])
        near = near.where((F.col("a.part") <= F.col("b.part")) & (_gap("a", "b") <= eps))
        near = near.select(*keys, F.col("a.part").alias("part_a"), F.col("b.part").alias("part_b"))
    return near


def near_pairs(a: np.ndarray, b: np.ndarray, axes: np.ndarray, least: float) -> Iterator[tuple]:
    """Positions (i, j) with a cosine of ``least`` or more, in parts; i < j if ``a is b``."""
    eps = 2 - 2 * least + 1e-9
    same = a is b
    ua, ub = unit(a), unit(b)
    pa_, pb = (ua @ axes)[:, :BOX_DIMENSIONS], (ub @ axes)[:, :BOX_DIMENSIONS]
    todo = [(0, len(a), 0, len(b))]
    while todo:
        al, ah, bl, bh = todo.pop()
        gap = np.maximum(
            pa_[al:ah].min(axis=0) - pb[bl:bh].max(axis=0), pb[bl:bh].min(axis=0) - pa_[al:ah].max(axis=0)
        )
        if (np.maximum(gap, 0) ** 2).sum() > eps:
            continue
        if max(ah - al, bh - bl) > SMALLEST:
            am, bm = (al + ah + 1) // 2, (bl + bh + 1) // 2
            halves = [
                (x, y, u, v)
                for x, y in ((al, am), (am, ah))
                for u, v in ((bl, bm), (bm, bh))
                if x < y and u < v and not (same and u < x)
            ]
            todo += halves
            continue
        cosine = ua[al:ah] @ ub[bl:bh].T
        i, j = np.nonzero(cosine >= least - 1e-9)
        value = cosine[i, j]
        i, j = i + al, j + bl
        # so close to the bound that rounding decides: work it out from the vectors as given
        for k in np.flatnonzero(np.abs(value - least) <= 1e-9):
            x, y = a[i[k]], b[j[k]]
            value[k] = (x @ y) / np.sqrt((x @ x) * (y @ y))
        near = (value >= least) & ((i < j) if same else True)
        yield i[near], j[near]


def _linked(blocks: DataFrame, axes, least: float, stored: str, count: int) -> DataFrame:
    """(a, n, root): per class and pair of blocks, the vectors it is linked to, and a class
    it hangs on. Rows grow with the blocks' vectors, not with the links."""
    eps = 2 - 2 * least + 1e-9
    boxes = blocks.select("part", "block", "label", "size", "low", "high")
    whole = near_partitions(settle(_corners(boxes)), count, eps)
    left = boxes.select(F.struct("block", "low", "high").alias("a"), "label", "size", F.col("part").alias("part_a"))
    right = boxes.select(F.struct("block", "low", "high").alias("b"), "label", "size", F.col("part").alias("part_b"))
    pairs = (
        whole.join(left, ["label", "size", "part_a"])
        .join(right, ["label", "size", "part_b"])
        .where("part_a < part_b OR a.block <= b.block")
        .where(_gap("a", "b") <= eps)
        .select("part_a", F.col("a.block").alias("block_a"), "part_b", F.col("b.block").alias("block_b"), "size")
    )
    pairs = settle(pairs)
    for side in ("a", "b"):
        payload = blocks.select(
            F.col("part").alias(f"part_{side}"),
            F.col("block").alias(f"block_{side}"),
            *[F.col(c).alias(f"{c}_{side}") for c in ("ids", "copies", "vectors")],
        )
        pairs = pairs.join(payload, [f"part_{side}", f"block_{side}"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = axes()
        for batch in batches:
            for row in range(batch.num_rows):
                r = {k: v[0] for k, v in batch.slice(row, 1).to_pydict().items()}
                size = r["size"]
                a = np.frombuffer(r["vectors_a"], stored).reshape(-1, size).astype(np.float64)
                ids, copies = np.frombuffer(r["ids_a"], "<i8"), np.frombuffer(r["copies_a"], "<i8")
                same = (r["part_a"], r["block_a"]) == (r["part_b"], r["block_b"])
                b, shift = a, 0
                if not same:
                    b = np.frombuffer(r["vectors_b"], stored).reshape(-1, size).astype(np.float64)
                    shift = len(a)
                    ids = np.concatenate([ids, np.frombuffer(r["ids_b"], "<i8")])
                    copies = np.concatenate([copies, np.frombuffer(r["copies_b"], "<i8")])
                forest, count = Forest(len(ids)), np.zeros(len(ids), np.int64)
                for i, j in near_pairs(a, b, own[size], least):
                    j = j + shift
                    np.add.at(count, i, copies[j])
                    np.add.at(count, j, copies[i])
                    forest.join(i, j)
                some = np.flatnonzero(count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[some]), pa.array(count[some]), pa.array(ids[forest.root[some]])],
                    ["a", "n", "root"],
                )

    tasks = max(2, -(-pairs.count() // PAIRS_AT_ONCE))
    dealt = pairs.repartition(tasks, "part_a", "block_a", "part_b", "block_b")
    return settle(dealt.mapInArrow(link, "a long, n long, root long"))


def near_duplicates(
    vectors: DataFrame, least: float = 0.93, id_col="vec_id", vector_col="embedding", label_col="label"
) -> DataFrame:
    """(id_col, n_links, component_id, kept) per row. Two vectors are linked if their labels
    are equal and not null and their cosine is ``least`` or more, in double precision.

    A vector that is null, empty or zero, or holds null or non-finite components, links with
    nothing, nor do vectors of different lengths. Equal vectors are one point with a count;
    a thousand copies give no more rows than one. component_id is the smallest id reachable;
    null ids count as vectors but name no component. Rows with equal ids stay vectors of
    their own. Other columns are not read. An empty table gives an empty result.
    """
    own = vectors.select(
        F.col(id_col).alias("_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector")
    )
    finite = F.forall(
        "vector", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(x)
    )
    usable = (
        F.col("label").isNotNull() & (F.size("vector") > 0) & finite & F.exists("vector", lambda x: x != 0)
    )
    own = own.withColumn("usable", F.coalesce(usable, F.lit(False)))
    points = own.where("usable").select("_id", "label", "vector")
    classes = points.groupBy("label", "vector").agg(F.count("*").alias("copies"), F.min("_id").alias("first"))
    classes = settle(classes.withColumn("_class", F.monotonically_increasing_id()))
    n = classes.count()
    if n:
        axes = sent(vectors.sparkSession, principal_axes(classes))
        blocks = _blocks(classes, axes, float(np.sqrt(2 - 2 * least)), n)
        linked = _linked(blocks, axes, least, _stored(classes), -(-n // PARTITION))
        counts = linked.groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "_class")
        roots = components(linked.select("a", "root"), "a", "root")
        roots = roots.select(F.col("node").alias("_class"), "root")
        grouped = classes.join(counts, "_class", "left").join(roots, "_class", "left")
        grouped = settle(
            grouped.select(
                "label",
                "vector",
                "first",
                (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("root", "_class").alias("root"),
            )
        )
        least_id = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
        grouped = grouped.join(least_id, "root").select("label", "vector", "n_links", "component_id")
    else:
        grouped = classes.select(
            "label", "vector", F.col("copies").alias("n_links"), F.col("first").alias("component_id")
        )
    known = points.join(grouped, ["label", "vector"]).select("_id", "n_links", "component_id")
    alone = own.where("NOT usable").select(
        "_id", F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id")
    )
    return known.union(alone).select(
        F.col("_id").alias(id_col),
        "n_links",
        "component_id",
        F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
