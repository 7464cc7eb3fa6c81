"""Packing documents into sequences by a grouping genetic algorithm.

A document's token ids are cut into pieces no longer than a sequence. Pieces that fill one
are done; the others are dealt at random to provinces of bounded size. Several islands
work on each province with a population of packings of their own: a crossover takes whole
well-filled sequences of one parent into the other, removes what is now there twice, and
puts the displaced pieces where they fit best. Between epochs each island's best packing
moves to the next island. Sequences that are not full, and a share of the others, are opened
again and their pieces dealt to fewer provinces, until one province holds them all or it no
longer helps.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from .arrow_text import from_raw, gather, raw, text_slices
from .scratch import settle

#: Pieces of a province, about.
PROVINCE = 4096
ISLANDS = 3
EPOCHS = 3
POPULATION = 4
#: Crossovers of an island in an epoch.
CROSSOVERS = 16
#: Sequences with more than this share of the capacity left over are opened again, and one in
#: so many of the others, whose small pieces fill what is left.
SPARE = 0.0005
OPENED = 8

_ENCODED_AT_ONCE = 256
_BYTES_AT_ONCE = 4 << 20
#: Pieces whose ids a task remembers before it starts afresh.
_REMEMBERED = 1 << 19

_SPACE, _LETTER, _NUMBER, _SYMBOL = range(4)


def _kind(code: int) -> int:
    """How the vocabulary's splitting pattern sees a character up to U+00FF."""
    if 9 <= code <= 13 or code in (32, 0x85, 0xA0):
        return _SPACE
    category = unicodedata.category(chr(code))[0]
    return {"L": _LETTER, "N": _NUMBER}.get(category, _SYMBOL)


_KINDS = np.array([_kind(c) for c in range(256)], np.uint8)


def pieces_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces begin, and which bytes are no white space, in lower-cased UTF-8 of
    characters up to U+00FF. Pieces are runs of letters, single numbers, runs of symbols, and
    the shortened words 's 't 're 've 'm 'll 'd where no symbol stands before them."""
    kinds = _KINDS[data]
    lead = np.flatnonzero(data >= 0xC2)
    kinds[lead] = kinds[lead + 1] = _KINDS[((data[lead] & 3) << 6) | (data[lead + 1] & 0x3F)]
    cut = np.zeros(len(data), bool)  # a piece begins at this byte
    a, b = kinds[:-1], kinds[1:]
    cut[1:] = ((a != b) | (b == _NUMBER)) & (a != _SPACE) & (b != _SPACE)
    cut[lead + 1] = False
    begins = np.ones(len(data) + 3, bool)  # a text does; what follows the last counts too
    begins[: len(data)] = False
    begins[offsets] = True
    quote = np.flatnonzero(data == 0x27)
    quote = quote[begins[quote] | (kinds[quote - 1] != _SYMBOL)]
    quote = quote[~begins[quote + 1]]
    first = data[quote + 1]
    second = np.where(begins[quote + 2], 0, data[np.minimum(quote + 2, len(data) - 1)])
    one = np.isin(first, np.frombuffer(b"stmd", np.uint8))
    two = np.zeros(len(quote), bool)
    for x, y in (b"re", b"ve", b"ll"):
        two |= (first == x) & (second == y)
    cut[quote[one | two] + 1] = False
    after = np.concatenate([quote[one] + 2, quote[two] + 3])
    after = after[after < len(data)]
    cut[after[kinds[after] != _SPACE]] = True
    solid = kinds != _SPACE
    cut[1:] |= ~solid[:-1]
    cut[offsets[:-1][offsets[:-1] < len(data)]] = True
    return cut & solid, solid


class WordEncoder:
    """Ids of many texts at once for a vocabulary that lower-cases, splits at white space
    and marks the last id of every word piece.

    Each different piece of a batch is encoded once and its ids are copied to every place.
    Only texts within Latin-1 go this way: there lower-casing has no context and nothing is
    composed anew. Other texts are encoded whole.
    """

    def __init__(self, vocabulary: str):
        self.whole = Tokenizer.from_file(vocabulary)
        self.lean = Tokenizer.from_file(vocabulary)
        self.lean.normalizer = normalizers.Sequence([])
        self.lean.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        names = self.whole.get_vocab()
        self.last = np.zeros(max(names.values()) + 1, bool)
        self.last[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, pieces: list[str]) -> None:
        lines = [
            " ".join(pieces[k : k + _ENCODED_AT_ONCE])
            for k in range(0, len(pieces), _ENCODED_AT_ONCE)
        ]
        found = [e.ids for e in self.lean.encode_batch_fast(lines, add_special_tokens=False)]
        ids = np.concatenate([np.asarray(x, np.uint32) for x in found] or [np.zeros(0, np.uint32)])
        stops = np.flatnonzero(self.last[ids]) + 1
        if len(stops) != len(pieces):
            raise ValueError("the vocabulary does not mark the end of each word piece")
        starts = np.concatenate([[0], stops])[: len(stops)].astype(np.int64)
        self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(pieces))))
        self.starts = np.concatenate([self.starts, starts + len(self.ids)])
        self.lengths = np.concatenate([self.lengths, stops - starts])
        self.ids = np.concatenate([self.ids, ids])

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where each piece's ids start among them and how many they are."""
        if len(self.known) > _REMEMBERED:
            self._forget()
        at = np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(at < 0)
        if len(new):
            at[new] = np.arange(len(self.known), len(self.known) + len(new))
            self._learn([pieces[k] for k in new.tolist()])
        return self.ids, self.starts[at], self.lengths[at]

    def latin(self, offsets: np.ndarray, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each text has."""
        offsets, data = raw(pc.utf8_lower(from_raw(offsets, data)))
        data = np.frombuffer(data, np.uint8)
        begins, solid = pieces_of(data, offsets)
        first = np.flatnonzero(begins)
        places = np.concatenate([[0], np.cumsum(solid)])[np.append(first, len(data))]
        found = from_raw(places, data[solid].tobytes()).dictionary_encode()
        ids, starts, lengths = self._encode(found.dictionary.to_pylist())
        at = found.indices.to_numpy(zero_copy_only=False)
        upto = np.concatenate([[0], np.cumsum(lengths[at])])
        return gather(ids, starts[at], lengths[at]), np.diff(upto[np.searchsorted(first, offsets)])

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``latin``, for any texts (large_string without nulls)."""
        offsets, data = raw(texts)
        data = bytes(data)
        beyond = np.flatnonzero(np.frombuffer(data, np.uint8) >= 0xC4)
        other = np.searchsorted(offsets[1:], beyond, "right")
        for token in self.special:
            found = pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
            other = np.concatenate([other, np.flatnonzero(found)])
        other = np.unique(other)
        if not len(other):
            return self.latin(offsets, data)
        plain = np.setdiff1d(np.arange(len(texts)), other)
        ids, counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if len(plain):
            offsets, data = raw(texts.take(pa.array(plain)))
            ids, counts = self.latin(offsets, bytes(data))
        rest = self.whole.encode_batch_fast(texts.take(pa.array(other)).to_pylist(), add_special_tokens=False)
        rest = [np.asarray(e.ids, np.uint32) for e in rest]
        every = np.zeros(len(texts), np.int64)
        every[plain], every[other] = counts, [len(x) for x in rest]
        out = np.empty(every.sum(), np.uint32)
        where = np.repeat(np.isin(np.arange(len(texts)), other), every)
        out[where], out[~where] = np.concatenate(rest), ids
        return out, every


def tokenise(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id_col, piece, start, length, ids): every text's token ids and ``end_id``, cut into
    pieces of ``capacity``; ``ids`` are little-endian unsigned 32-bit numbers. Null text
    counts as empty: the end id alone. ``vocabulary`` is a file all executors have."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs as many tasks as there are cores
        encode = WordEncoder(vocabulary)
        for batch in batches:
            for rows, texts in text_slices(batch, 1, _BYTES_AT_ONCE):
                ids, counts = encode(texts)
                ends = np.cumsum(counts + 1)
                full = np.full(ends[-1], end_id, "<u4")
                full[np.delete(np.arange(ends[-1]), ends - 1)] = ids
                many = -(-(counts + 1) // capacity)
                of = np.repeat(np.arange(len(texts)), many)
                piece = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
                start = piece * capacity
                length = np.minimum(capacity, (counts + 1)[of] - start)
                cuts = np.concatenate([[0], np.cumsum(length) * 4]).astype(np.int32)
                binary = pa.Array.from_buffers(
                    pa.binary(), len(of), [None, pa.py_buffer(cuts), pa.py_buffer(full.tobytes())]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0).take(pa.array(of)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(start),
                        pa.array(length),
                        binary,
                    ],
                    ["_id", "piece", "start", "length", "ids"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    out = rows.mapInArrow(read, f"_id {kind}, piece int, start long, length long, ids binary")
    return out.withColumnRenamed("_id", id_col)


# one province


def best_fit(order, sizes, bins: np.ndarray, room: list[int], capacity: int) -> None:
    """Put the pieces ``order`` one by one where they leave the least room, or into a new
    sequence. ``room`` by sequence and ``bins`` by piece are filled in."""
    free: dict[int, list[int]] = {}
    open_rooms = 0  # bit r: a sequence with room r is there
    for b, r in enumerate(room):
        if r > 0:
            free.setdefault(r, []).append(b)
            open_rooms |= 1 << r
    for i in order:
        size = sizes[i]
        fitting = open_rooms >> size
        if fitting:
            r = size + (fitting & -fitting).bit_length() - 1
            own = free[r]
            b = own.pop()
            if not own:
                open_rooms ^= 1 << r
        else:
            r, b = capacity, len(room)
            room.append(r)
        left = r - size
        room[b] = left
        bins[i] = b
        if left:
            own = free.setdefault(left, [])
            if not own:
                open_rooms |= 1 << left
            own.append(b)


def fitness(bins: np.ndarray, sizes: np.ndarray, capacity: int) -> float:
    """Mean square fill: more for fewer sequences, and for full ones beside empty ones."""
    fill = np.bincount(bins, weights=sizes) / capacity
    return float((fill**2).mean())


def crossover(into, out_of, sizes, listed, capacity, rng) -> np.ndarray:
    """Whole well-filled sequences of ``out_of`` go into ``into``."""
    fill = np.bincount(out_of, weights=sizes)
    good = np.flatnonzero(fill >= capacity * (1 - SPARE))
    if not len(good):
        good = np.argsort(-fill, kind="stable")[: max(1, len(fill) // 4)]
    chosen = np.zeros(len(fill), bool)
    chosen[rng.choice(good, max(1, len(good) // 2), replace=False)] = True
    moved = chosen[out_of]
    # sequences that hold a moved piece go, as do the worst that stay
    fill_into = np.bincount(into, weights=sizes)
    gone = np.zeros(len(fill_into), bool)
    gone[into[moved]] = True
    rest = np.flatnonzero(~gone)
    worst = rest[np.argsort(fill_into[rest], kind="stable")[: max(1, len(rest) // 20)]]
    gone[worst] = True
    stay = ~gone
    number = np.cumsum(stay) - 1
    bins = np.where(stay[into] & ~moved, number[into], -1)
    kept = int(stay.sum())
    _, again = np.unique(out_of[moved], return_inverse=True)
    bins[moved] = kept + again
    room = (capacity - np.bincount(bins[bins >= 0], weights=sizes[bins >= 0])).astype(int).tolist()
    lost = np.flatnonzero(bins < 0)
    noise = sizes[lost] * (1 + 0.02 * rng.random(len(lost)))
    best_fit(lost[np.argsort(-noise, kind="stable")].tolist(), listed, bins, room, capacity)
    return bins


def evolve(sizes: np.ndarray, population: list[np.ndarray], capacity: int, seed) -> list[np.ndarray]:
    """One epoch of an island, best packing first. An empty population is founded first by
    best fit in falling order of size, plain for the first and with noise for the others."""
    rng, listed = np.random.default_rng(seed), sizes.tolist()
    if not population:
        for k in range(POPULATION):
            noise = sizes * (1 + (0.1 * rng.random(len(sizes)) if k else 0))
            bins: np.ndarray = np.zeros(len(sizes), np.int64)
            best_fit(np.argsort(-noise, kind="stable").tolist(), listed, bins, [], capacity)
            population.append(bins)
    ranked = sorted(((-fitness(b, sizes, capacity), k, b) for k, b in enumerate(population)), key=lambda x: x[:2])
    ranked = ranked[:POPULATION]
    for k in range(CROSSOVERS if len(sizes) > 1 else 0):
        # the better of two as donor, any other as receiver
        a, b = rng.choice(len(ranked), 2, replace=False) if len(ranked) > 1 else (0, 0)
        donor, receiver = ranked[min(a, b)][2], ranked[max(a, b)][2]
        if rng.random() < 0.5:
            donor, receiver = receiver, donor
        child = crossover(receiver, donor, sizes, listed, capacity, rng)
        ranked.append((-fitness(child, sizes, capacity), POPULATION + k, child))
        ranked = sorted(ranked, key=lambda x: x[:2])[:POPULATION]
    return [b for _, _, b in ranked]


# all provinces


def _epoch(states: DataFrame, capacity: int, epoch: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.asarray(row["sizes"], np.int64)
                population = [np.frombuffer(b, "<i4").astype(np.int64) for b in row["population"]]
                seed = [row["province"], row["island"], epoch]
                population = evolve(sizes, population, capacity, seed)
                best = population[0]
                row |= {
                    "population": [b.astype("<i4").tobytes() for b in population],
                    "used": int(best.max()) + 1,
                    "fitness": fitness(best, sizes, capacity),
                }
                yield pa.RecordBatch.from_pylist([row], schema=batch.schema)

    return states.mapInArrow(run, states.schema)


def _best_packings(items: DataFrame, provinces: int, capacity: int) -> DataFrame:
    """(province, rows, sizes, packing): the best island's packing of each province."""
    own = F.pmod(F.xxhash64("_row", F.lit(provinces)), F.lit(provinces)).alias("province")
    states = (
        items.groupBy(own)
        .agg(F.array_sort(F.collect_list(F.struct("_row", "length"))).alias("own"))
        .select(
            "province",
            F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
            F.col("own._row").alias("rows"),
            F.col("own.length").alias("sizes"),
            F.array().cast("array<binary>").alias("population"),
            F.lit(0).alias("used"),
            F.lit(0.0).alias("fitness"),
        )
    )
    # an island is a row of bounded size: any dealing will do, but a task each if need be
    states = states.repartition(max(2, min(provinces * ISLANDS, 4 * _slots(items))), "province", "island")
    for epoch in range(EPOCHS):
        states = settle(_epoch(states, capacity, epoch))
        if epoch + 1 < EPOCHS:
            elite = states.select(
                "province",
                F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"),
                F.slice("population", 1, 1).alias("guest"),
            )
            states = states.join(elite, ["province", "island"])
            states = states.withColumn("population", F.concat("population", "guest")).drop("guest")
    best = F.max_by(
        F.struct("rows", "sizes", F.col("population")[0].alias("packing")),
        F.struct(-F.col("used"), "fitness", -F.col("island")),
    )
    return states.groupBy("province").agg(best.alias("b")).select("province", "b.*")


def _slots(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _unpacked(best: DataFrame, round_no: int, capacity: int) -> DataFrame:
    """(_row, length, sequence, offset, fill) of every piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                bins = np.frombuffer(row["packing"], "<i4").astype(np.int64)
                sizes, rows = np.asarray(row["sizes"], np.int64), np.asarray(row["rows"], np.int64)
                order = np.argsort(bins, kind="stable")
                before = np.cumsum(sizes[order]) - sizes[order]
                first = np.concatenate([[True], np.diff(bins[order]) > 0])
                offset = before - before[first][np.cumsum(first) - 1]
                fill = np.bincount(bins, weights=sizes).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows[order]),
                        pa.array(sizes[order]),
                        pa.array(np.full(len(order), row["province"], np.int64)),
                        pa.array(bins[order]),
                        pa.array(offset),
                        pa.array(fill[bins[order]]),
                    ],
                    ["_row", "length", "province", "bin", "offset", "fill"],
                )

    schema = "_row long, length long, province long, bin long, offset long, fill long"
    out = best.mapInArrow(run, schema)
    # provinces hold far fewer than 2^24 pieces, and there are far fewer than 2^7 rounds
    number = F.lit(round_no + 1).cast("long") * (1 << 56) + F.col("province") * (1 << 24) + F.col("bin")
    return out.select("_row", "length", number.alias("sequence_id"), "offset", "fill")


def pack(pieces: DataFrame, capacity: int = 2048, province: int = PROVINCE) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: sequences of at most ``capacity``, as
    few as the search finds, each filled from 0 without gaps.

    Needs a column ``length`` (1 to capacity) and a column ``_row`` that tells pieces apart.
    An empty table gives an empty result.
    """
    # a piece that fills a sequence has its place: it goes past the join
    full = pieces.where(F.col("length") == capacity).withColumns(
        {"sequence_id": F.col("_row"), "offset": F.lit(0).cast("long")}
    )
    items = pieces.where(F.col("length") < capacity).select("_row", "length")
    done, held, count, round_no = [], None, items.count(), 0
    while count:
        provinces = -(-count // province)
        found = settle(_unpacked(_best_packings(items, provinces, capacity), round_no, capacity))
        used = found.select("sequence_id").where("offset = 0").count()
        if held is not None and used >= held:
            break  # opening these sequences again did not help: they stay as they were
        drawn = F.pmod(F.xxhash64("sequence_id"), F.lit(OPENED)) == 0
        opened = (F.col("fill") < capacity * (1 - SPARE)) | drawn
        if done:
            done.pop()
        done += [found.where(~opened), found.where(opened)]
        if provinces == 1:
            break
        items = found.where(opened).select("_row", "length")
        held = found.where(opened & (F.col("offset") == 0)).count()
        count, round_no = items.count(), round_no + 1
    if not done:
        return full.drop("_row")
    parts = [part.select("_row", "sequence_id", "offset") for part in done]
    placed = reduce(DataFrame.union, parts)
    rest = pieces.where(F.col("length") < capacity).join(placed, "_row")
    return rest.unionByName(full).drop("_row")


def packed_documents(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: bool = False,
) -> DataFrame:
    """(id_col, piece, start, length, ids, sequence_id, offset): every document, packed.
    ``digest`` gives ``ids_crc32``, made from the packed ids, instead of them.

    Rows with equal ids are packed as documents of their own; a null id is kept. Null text
    counts as empty. Other columns are not read. An empty table gives an empty result.
    """
    pieces = tokenise(docs, vocabulary, capacity, id_col=id_col, text_col=text_col)
    pieces = settle(pieces.withColumn("_row", F.monotonically_increasing_id()))
    packed = pack(pieces, capacity)
    return digested(packed) if digest else packed


def digested(packed: DataFrame) -> DataFrame:
    """``packed`` with ``ids_crc32`` in place of the ids."""
    return packed.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")
