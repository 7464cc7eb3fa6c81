import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from shelfweek.llm import packing
from shelfweek.llm.queries import VOCABULARY

LETTERS = "abstrevlmdABSTÀé×÷ßµªº²¼\xa0\x85\xad\x1c\t\n  '''\"!.,-_0123&*«»"


def test_ids_equal_the_library_on_awkward_texts():
    rng = random.Random(1)
    texts = ["", "'", "'s", "a's", "'re", "it's 're ''s !'s x'll'", "l'amour d'm'our", "123 4a5"]
    texts += ["İΣ’ ώς", "ﬁ á é", "<|endoftext|> a", "x" * 5000, "'", "s"]
    texts += ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    wide = LETTERS + "漢İΣςσ́"
    texts += ["".join(rng.choice(wide) for _ in range(rng.randint(0, 60))) for _ in range(500)]
    plain, encode = Tokenizer.from_file(VOCABULARY), packing.WordEncoder(VOCABULARY)
    for at in range(0, len(texts), 333):
        part = texts[at : at + 333]
        ids, counts = encode(pa.array(part, pa.large_string()))
        stops = np.cumsum(counts)
        for text, stop, n in zip(part, stops, counts):
            want = plain.encode(text, add_special_tokens=False).ids
            assert ids[stop - n : stop].tolist() == want, text


def check_sequences(rows, capacity):
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0, *[n for _, n in own[:-1]]]).tolist()
        assert sum(n for _, n in own) <= capacity
    return len(places)


def test_pieces_and_places(spark):
    rng = random.Random(2)
    texts = [None, "", "one", "the " * 500] + [
        " ".join(rng.choice(["alpha", "Beta", "gamma."]) for _ in range(rng.randint(0, 90))) for _ in range(150)
    ]
    rows = [(k if k != 7 else None, t) for k, t in enumerate(texts)] + [(5, texts[5])]
    docs = spark.createDataFrame(
        [(t, i, 0, "x", 1) for i, t in rows], "text string, doc_id long, length int, ids string, _row int"
    )
    found = packing.packed_documents(docs, VOCABULARY, capacity=64, digest=True).collect()
    plain = Tokenizer.from_file(VOCABULARY)
    want = []
    for i, t in rows:
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 64):
            part = np.array(ids[k : k + 64], "<u4")
            want.append((i, k // 64, k, len(part), zlib.crc32(part.tobytes())))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found]
    assert sorted(got, key=str) == sorted(want, key=str)
    used = check_sequences(found, 64)
    lengths = sorted((r.length for r in found), reverse=True)
    room, bins = [], np.zeros(len(lengths), int)
    packing.best_fit(range(len(lengths)), lengths, bins, room, 64)
    assert used <= len(room)
    # the ids themselves, where they are asked for
    whole = packing.packed_documents(docs.where("doc_id = 3"), VOCABULARY, capacity=64).collect()
    parts = b"".join(bytes(r.ids) for r in sorted(whole, key=lambda r: r.piece))
    assert np.frombuffer(parts, "<u4").tolist() == [*plain.encode(texts[3], add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("province", [40, 10_000])
def test_many_provinces_stay_near_the_bound(spark, province):
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 101, 600)
    df = spark.createDataFrame([(k, int(n)) for k, n in enumerate(lengths)], "_row long, length long")
    df = df.selectExpr("_row", "_row AS own", "length")
    found = packing.pack(df, capacity=100, province=province).collect()
    assert sorted(r.own for r in found) == list(range(600))
    used, bound = check_sequences(found, 100), -(-int(lengths.sum()) // 100)
    assert used <= bound * (1.06 if province == 40 else 1.03)


def test_crossover_keeps_every_piece_once():
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 100, 300)
    best, *rest = packing.evolve(sizes, [], 100, [1, 2, 3])
    for bins in (best, *rest):
        assert (np.bincount(bins, weights=sizes) <= 100).all() and (np.bincount(bins) > 0).all()
    plain: np.ndarray = np.zeros(300, np.int64)
    packing.best_fit(np.argsort(-sizes).tolist(), sizes.tolist(), plain, [], 100)
    assert best.max() <= plain.max()


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.packed_documents(empty, VOCABULARY).collect() == []


def fewest(lengths, capacity):
    """The least number of sequences, by all subsets."""
    full = (1 << len(lengths)) - 1
    fits = [s for s in range(1, full + 1) if sum(n for k, n in enumerate(lengths) if s >> k & 1) <= capacity]
    least = {0: 0}
    for s in range(1, full + 1):
        first = s & -s
        least[s] = 1 + min(least[s ^ t] for t in fits if t & first and t & s == t)
    return least[full]


def test_as_few_sequences_as_brute_force(spark):
    rng = np.random.default_rng(8)
    for case in range(6):
        lengths = [int(n) for n in rng.integers(1, 21, 9)] + [20] * (case % 3)
        df = spark.createDataFrame(list(enumerate(lengths)), "_row long, length long")
        found = packing.pack(df.selectExpr("_row", "_row AS own", "length"), capacity=20).collect()
        assert sorted((r.own, r.length) for r in found) == list(enumerate(lengths))
        assert check_sequences(found, 20) == fewest(lengths, 20)


def test_only_pieces_that_fill_a_sequence(spark):
    df = spark.createDataFrame([(k, 8) for k in range(5)], "_row long, length long")
    found = packing.pack(df.selectExpr("_row", "_row AS own", "length"), capacity=8).collect()
    assert {(r.own, r.offset) for r in found} == {(k, 0) for k in range(5)} and check_sequences(found, 8) == 5
