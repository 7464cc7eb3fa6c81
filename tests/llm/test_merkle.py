import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from shelfweek.llm import merkle
from tests.llm import brute

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row int, leaf string, _id string"


def found(spark, rows, **kw):
    df = spark.createDataFrame([(*(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")), 1, "l", "i") for r in rows], SCHEMA)
    changed = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    suspect = F.when(changed, merkle.digest([F.col(c) if c != "text" else lower for c in FIELDS]))
    return merkle.manifest(df, FIELDS, suspect, **kw).collect()


def expected(rows):
    def suspect(row, leaf):
        if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0:
            return leaf(row | {"text": row["text"] and brute.ascii_lower(row["text"])})

    return brute.merkle(rows, FIELDS, "source", "doc_id", suspect)


def made(n, sources, seed=1):
    rng = random.Random(seed)
    return [
        {
            "doc_id": rng.choice([k, k, k, 7, None]),
            "source": rng.choice(sources),
            "lang": rng.choice(["en", None, ""]),
            "n_chars": rng.choice([3, None]),
            "text": rng.choice(["Abc", "abc", "", None, "É\n" * 30, str(k)]),
        }
        for k in range(n)
    ]


@pytest.mark.parametrize(
    "n, sources",
    [
        (700, ["b", "b", "b", None, "", "a", "ä", "B"]),
        (40, [f"s{k}" for k in range(400)]),
        (900, [f"s{k}" for k in range(300)]),
        (1, ["x"]),
        (2, ["x"]),
        (17, ["x"]),
        (300, ["x"]),
    ],
)
def test_equals_brute_force(spark, monkeypatch, n, sources):
    monkeypatch.setattr(merkle, "PARTITION_ROWS", 130)
    rows = made(n, sources)
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, found(spark, rows)), key=key) == sorted(expected(rows), key=key)


def test_equal_rows_holding_most_of_the_table(spark, monkeypatch):
    monkeypatch.setattr(merkle, "PARTITION_ROWS", 50)
    one = {"doc_id": 5, "source": "x", "lang": "en", "n_chars": 1, "text": "Same"}
    rows = [dict(one) for _ in range(400)] + made(30, ["x", "y"])
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, found(spark, rows)), key=key) == sorted(expected(rows), key=key)


def test_tampering_shows_and_proofs_fold_to_the_root(spark):
    rows = made(60, ["x", "y"])
    for r in found(spark, rows, proofs=True):
        assert r.verified == (r.folded_root == r.root) and len(r.proof) % 64 == 0
        if r.doc_id is None:
            assert r.verified
    assert {r.verified for r in found(spark, rows)} == {True, False}


def test_a_fold_resumes_the_kept_state():
    children = [sha256(bytes([k])).hexdigest().encode() for k in range(16)]
    parent = merkle.Parent(children)
    other = b"0" * 64
    for slot in range(16):
        want = sha256(b"".join([*children[:slot], other, *children[slot + 1 :]])).hexdigest().encode()
        assert merkle.fold(other, [parent.step(slot)]) == want
        assert merkle.fold(children[slot], [parent.step(slot)]) == parent.hex


def test_empty_table_and_very_long_text(spark):
    assert found(spark, []) == []
    rows = [{"doc_id": 1, "source": None, "lang": None, "n_chars": None, "text": "Xé" * 2_000_000}]
    assert [tuple(r) for r in found(spark, rows)] == expected(rows)
