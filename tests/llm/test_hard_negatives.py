import math

import numpy as np
import pytest

from shelfweek.llm import hard_negatives
from tests.llm import brute

SCHEMA = "vec_id long, embedding array<double>, label int, _row int, size string"


def found(spark, rows, anchor="vec_id % 3 = 0", **kw):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA)
    out = hard_negatives.mine(df, F.expr(anchor), **kw).collect()
    return sorted(map(tuple, out), key=str)


def test_products_are_exact_whatever_the_number_of_primes():
    rng = np.random.default_rng(1)
    for size, largest in [(1, 3), (64, 300), (700, 5), (64, 2**20), (5, 2**29), (0, 1)]:
        a, b = (rng.integers(-largest, largest + 1, (n, size)).astype(float) for n in (7, 9))
        bound = max(1.0, np.sqrt((a**2).sum(1).max(initial=0) * (b**2).sum(1).max(initial=0)))
        primes = hard_negatives.primes_for(bound)
        got = hard_negatives.scores(
            hard_negatives.residues(a, primes), hard_negatives.residues(b, primes), primes
        )
        want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
        assert got.tolist() == want
    # the largest scores a block may have
    a = np.full((1, 300), 254.0 * 509 + 254)
    primes = hard_negatives.primes_for(float((a**2).sum()))
    own = hard_negatives.residues(a, primes)
    assert hard_negatives.scores(own, own, primes).tolist() == [[int((a**2).sum())]]


@pytest.mark.parametrize("scale_of", [1.0, 1e5])
def test_equals_brute_force(spark, monkeypatch, scale_of):
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 1500)
    monkeypatch.setattr(hard_negatives, "TILE", (4, 16))
    rng = np.random.default_rng(5)
    base = rng.normal(size=(4, 6))
    rows = []
    for k in range(150):
        v = base[k % 4] + 0.3 * rng.normal(size=6)
        rows.append((k, [float(x) * scale_of for x in v / np.linalg.norm(v)], int(rng.integers(0, 3))))
    rows += [(k, v, label) for k, v, label in rows[:6]]  # repeated rows
    rows += [(200 + k, rows[7][1], k % 3) for k in range(9)]  # ties
    assert found(spark, rows) == brute.hard_negatives(rows, lambda i: i % 3 == 0)


def test_rows_that_take_no_part_and_lengths_apart(spark):
    rows = [
        (0, [1.0, 0.5], 1),
        (1, [1.0, 0.5], 1),
        (2, [0.9, 0.45], 2),
        (3, [1.0, math.nan], 1),
        (4, [1.0, None], 2),
        (5, [math.inf, 0.0], 2),
        (6, None, 2),
        (7, [1.0, 0.5], None),
        (8, [1.0, 0.4, 0.1], 2),
        (9, [1.0, 0.4, 0.2], 1),
        (None, [0.9, 0.45], 2),
        (12, [], 1),
        (15, [], 1),
        (16, [], 2),
        (18, [-1.0, 0.0], 4),
        (19, [1.0, 0.0], 4),
        (20, [-1.0, 0.1], 5),
    ]
    want = brute.hard_negatives(rows, lambda i: i is not None and i % 3 == 0)
    assert found(spark, rows) == want
    assert {r[0] for r in want} == {0, 12, 15} and None in {r[3] for r in want}
    assert (0, 1, 2, None) in {r[:4] for r in want}


def test_empty_tables_no_anchors_and_scores_too_large(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    assert found(spark, [(3, None, 1)]) == []
    with pytest.raises(ValueError, match="fit a long"):
        found(spark, [(3, [1e9], 1), (4, [1e9], 1)])
    one = [(3, [5e6], 1), (4, [5e6], 1), (5, [4.9e6], 2)]
    assert found(spark, one) == brute.hard_negatives(one, lambda i: i % 3 == 0)
