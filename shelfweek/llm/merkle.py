"""A Merkle manifest of a dataset: a tree of SHA-256 digests per group, and one over the groups.

Leaves are digests of rows; every 16 consecutive nodes hash into one, level by level, until
one is left. As a child enters its parent's hash as 64 hex digits, a parent keeps a copy of
its hash state from before every child slot. Folding a changed leaf takes the state kept for
its slot, adds the new digest and the siblings to the right, and goes on with the parent in
the same way: siblings to the left are never hashed again.

Rows are put in order by a range partition; how many rows of a group come before a partition
follows from counts. Chunks of 256 nodes then climb two levels in a task, and so on with the
chunks' tops; on the way down each chunk is handed the levels above it.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfweek.sinks.files import forget

from .scratch import settle

#: Children of a node, and levels that a task climbs at once.
RUN = 16
HEIGHT = 2
CHUNK = RUN**HEIGHT
#: Rows of a range partition, about.
PARTITION_ROWS = 50_000

_ABOVE = "array<struct<slot:int,children:binary>>"


def digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields one after another, in lower-case hex: ``-`` for a null, or else
    the number of UTF-8 bytes, ``:`` and the value (numbers in decimals)."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def levels(n: int) -> int:
    """Levels above n nodes."""
    k = 0
    while n > 1:
        n, k = -(-n // RUN), k + 1
    return k


class Parent:
    """The hash of a run of children, its states before every child slot kept."""

    def __init__(self, children: list[bytes]):
        state, self.before, self.children = sha256(), [], children
        for child in children:
            self.before.append(state.copy())
            state.update(child)
        self.hex = state.hexdigest().encode()

    def step(self, slot: int) -> tuple:
        """What a fold through a slot needs: the state before it, and all to the right."""
        return self.before[slot], b"".join(self.children[slot + 1 :])

    def siblings(self, slot: int) -> bytes:
        return b"".join(self.children[:slot] + self.children[slot + 1 :])


def climb(nodes: list[bytes], height: int) -> list[list[Parent]]:
    """The levels above nodes (as hex), lowest first."""
    found = []
    for _ in range(height):
        found.append([Parent(nodes[k : k + RUN]) for k in range(0, len(nodes), RUN)])
        nodes = [p.hex for p in found[-1]]
    return found


def fold(leaf: bytes, steps: list[tuple]) -> bytes:
    """The root that a leaf (as hex) leads to."""
    for before, right in steps:
        state = before.copy()
        state.update(leaf + right)
        leaf = state.hexdigest().encode()
    return leaf


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``_pos``, their place in their ``_group`` by ``order`` (nulls first),
    and ``_n``, the size of it. ``_row`` tells rows apart and settles ties, so that equal
    rows are spread over partitions."""
    parts = max(1, -(-rows.count() // PARTITION_ROWS))
    keys = ["_group", *order, "_row"]
    cut = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    # the number of the partition above bit 33, the place in it below
    cut = settle(cut.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    runs = cut.groupBy("_group", part.alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_own"))
    whole = Window.partitionBy("_group")
    before = F.sum("_own").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(
        F.col("_group").alias("_g"),
        "_part",
        (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_own").over(whole).alias("_n"),
    )
    same = (F.col("_group") == F.col("_g")) & (part == F.col("_part"))
    found = cut.join(runs, same).withColumn("_pos", F.col("_at") + F.col("_shift"))
    return found.drop("_g", "_part", "_shift", "_at")


def _hexed(column: pa.ChunkedArray) -> list[bytes]:
    return [d.hex().encode() for d in column.to_pylist()]


def _chunk() -> Column:
    return F.floor(F.col("_pos") / CHUNK).cast("long").alias("_chunk")


def _tops(nodes: DataFrame) -> DataFrame:
    """The node above each chunk of 256 (or the only node itself), with its own place."""

    def top(key, chunk):
        chunk = chunk.sort_by("_pos")
        n = chunk.column("_n")[0].as_py()
        height = min(HEIGHT, levels(n))
        above = climb(_hexed(chunk.column("digest")), height)
        found = bytes.fromhex(above[-1][0].hex.decode()) if above else chunk.column("digest")[0].as_py()
        n = -(-n // RUN**height)
        return pa.table(
            {
                "_group": pa.array([key[0].as_py()], pa.string()),
                "_pos": pa.array([key[1].as_py()], pa.int64()),
                "_n": pa.array([n], pa.int64()),
                "digest": pa.array([found], pa.binary()),
            }
        )

    chunks = nodes.select("_group", "_pos", "_n", "digest", _chunk())
    return chunks.groupBy("_group", "_chunk").applyInArrow(top, "_group string, _pos long, _n long, digest binary")


def _up(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` and the rounds above them, up to one node per group, settled."""
    rounds = [nodes]
    while (rounds[-1].agg(F.max("_n")).first()[0] or 0) > 1:
        rounds.append(settle(_tops(rounds[-1])))
    return rounds


def _with_above(nodes: DataFrame, tops: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``fn`` on every chunk of ``nodes`` with its row of ``tops`` (the levels above)."""
    own = nodes.withColumn("_chunk", _chunk())
    above = tops.select("_group", F.col("_pos").alias("_chunk"), "above", "_subroot", "_root")
    return own.groupBy("_group", "_chunk").cogroup(above.groupBy("_group", "_chunk")).applyInArrow(fn, schema)


def _path(above: list[list[Parent]], k: int) -> list[tuple[int, Parent]]:
    """Slot and parent of node ``k`` on every level of its chunk."""
    found = []
    for level in above:
        found.append((k % RUN, level[k // RUN]))
        k //= RUN
    return found


def _down(nodes: DataFrame, tops: DataFrame) -> DataFrame:
    """``above`` of every node: on each level up to the root its slot, and all children of
    its parent."""

    def run(key, chunk, top):
        chunk = chunk.sort_by("_pos")
        levels_here = climb(_hexed(chunk.column("digest")), min(HEIGHT, levels(chunk.column("_n")[0].as_py())))
        higher = top.column("above")[0].as_py()
        above = [
            [
                {"slot": slot, "children": bytes.fromhex(b"".join(p.children).decode())}
                for slot, p in _path(levels_here, k)
            ]
            + higher
            for k in range(chunk.num_rows)
        ]
        many = chunk.num_rows
        kind = pa.list_(pa.struct([("slot", pa.int32()), ("children", pa.binary())]))
        return pa.table(
            {
                "_group": chunk.column("_group"),
                "_pos": chunk.column("_pos"),
                "above": pa.array(above, kind),
                "_subroot": pa.array(top.column("_subroot").to_pylist() * many, pa.binary()),
                "_root": pa.array(top.column("_root").to_pylist() * many, pa.binary()),
            }
        )

    schema = f"_group string, _pos long, above {_ABOVE}, _subroot binary, _root binary"
    return _with_above(nodes.select("_group", "_pos", "_n", "digest"), tops, run, schema)


def _all_down(rounds: list[DataFrame], top: DataFrame) -> DataFrame:
    """What stands above the chunks of the lowest round, from what stands above the groups."""
    for nodes in reversed(rounds[1:-1]):
        top = settle(_down(nodes, top))
    return top


def _proven(nodes: DataFrame, tops: DataFrame, kind: str, proofs: bool) -> DataFrame:
    def run(key, chunk, top):
        chunk = chunk.sort_by("_pos")
        leaves = _hexed(chunk.column("digest"))
        own = climb(leaves, min(HEIGHT, levels(chunk.column("_n")[0].as_py())))
        higher = []
        for level in top.column("above")[0].as_py():
            children = level["children"].hex().encode()
            children = [children[k : k + 64] for k in range(0, len(children), 64)]
            higher.append((level["slot"], Parent(children)))
        rest_of_steps = [p.step(slot) for slot, p in higher]
        rest_of_proof = b"".join(p.siblings(slot) for slot, p in higher)
        folded, proof = [], []
        for k, suspect in enumerate(chunk.column("suspect").to_pylist()):
            path = _path(own, k)
            leaf = leaves[k] if suspect is None else suspect.hex().encode()
            folded.append(fold(leaf, [p.step(slot) for slot, p in path] + rest_of_steps).decode())
            siblings = b"".join(p.siblings(slot) for slot, p in path) + rest_of_proof
            proof.append(siblings.decode() if proofs else sha256(siblings).hexdigest())
        many = chunk.num_rows
        return pa.table(
            {
                "_id": chunk.column("_id"),
                "leaf": pa.array([x.decode() for x in leaves]),
                "subroot": pa.array([top.column("_subroot")[0].as_py().hex()] * many),
                "root": pa.array([top.column("_root")[0].as_py().hex()] * many),
                "proof": pa.array(proof, pa.string()),
                "folded_root": pa.array(folded, pa.string()),
            }
        )

    schema = f"_id {kind}, leaf string, subroot string, root string, proof string, folded_root string"
    return _with_above(nodes, tops, run, schema)


def manifest(
    docs: DataFrame,
    fields: list[str],
    suspect: Column | None = None,
    id_col: str = "doc_id",
    group_col: str = "source",
    proofs: bool = False,
) -> DataFrame:
    """(id_col, leaf, subroot, root, proof_sha256, folded_root, verified) per row.

    ``leaf`` is the digest of the ``fields`` of a row. Leaves of a group ascend by id (nulls
    first, then by digest among equal ids); while there are several nodes, every 16 hash into
    one, the last run being shorter. What remains is ``subroot``. Subroots in the order of
    their groups (null first, by UTF-8 bytes) give ``root`` in the same way. The proof is the
    siblings' digests, level by level up to the root, from left to right; ``proofs`` returns
    it as text in a column ``proof`` in place of its digest.

    ``suspect`` may give another leaf digest, such as one worked out from a copy of the data;
    ``folded_root`` is what it (or, where it is null, the leaf itself) leads to with the
    proof's siblings, and ``verified`` tells whether that is the root.

    Nulls are digested as nulls, in any field. Equal rows are leaves of their own; which of
    them stands first makes no difference. A null group is a group. An empty table gives an
    empty result. Other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    if suspect is None:
        suspect = F.lit(None).cast("string")
    rows = docs.select(
        F.col(id_col).alias("_id"),
        # a null before all others
        F.coalesce(F.concat(F.lit("1"), F.col(group_col).cast("string")), F.lit("0")).alias("_group"),
        F.unhex(digest([F.col(c) for c in fields])).alias("digest"),
        F.unhex(suspect).alias("suspect"),
    )
    rows = settle(rows.withColumn("_row", F.monotonically_increasing_id()))
    leaves = settle(placed(rows, ["_id", "digest"]).drop("_row"))
    forget(rows)
    rounds = _up(leaves)

    groups = rounds[-1].select(
        F.lit("").alias("_group"), F.col("_group").alias("_name"), F.lit(0).alias("_row"), "digest"
    )
    groups = settle(placed(groups, ["_name"]).drop("_row"))
    above = _up(groups)
    root = above[-1].select("_group", "_pos", "_n", F.col("digest").alias("_root"))
    top = root.select(
        "_group", "_pos", F.array().cast(_ABOVE).alias("above"), F.col("_root").alias("_subroot"), "_root"
    )
    if len(above) > 1:
        top = _down(groups, _all_down(above, top))
    subroots = groups.select(F.col("_name").alias("_g"), F.col("_pos").alias("_at"), F.col("digest").alias("_own"))
    top = settle(
        top.join(subroots, F.col("_pos") == F.col("_at")).select(
            F.col("_g").alias("_group"), F.lit(0).cast("long").alias("_pos"), "above", F.col("_own").alias("_subroot"), "_root"
        )
    )
    found = _proven(leaves, _all_down(rounds, top), kind, proofs)
    return found.select(
        F.col("_id").alias(id_col),
        "leaf",
        "subroot",
        "root",
        F.col("proof").alias("proof" if proofs else "proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
