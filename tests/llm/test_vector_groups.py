import numpy as np
import pytest

from shelfweek.llm import vector_groups
from tests.llm import brute

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, _class int, vector string"


def expected(rows, least):
    vectors = [
        np.array(v, float) if v is not None and None not in v and np.isfinite(v).all() and any(v) and l is not None else None
        for _, v, l in rows
    ]
    n = len(rows)
    linked = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(i):
            a, b = vectors[i], vectors[j]
            if a is not None and b is not None and len(a) == len(b) and rows[i][2] == rows[j][2]:
                linked[i, j] = linked[j, i] = a @ b / np.sqrt((a @ a) * (b @ b)) >= least
    root = brute.groups(n, linked)
    first = {}
    for (i, _, _), r in zip(rows, root):
        if i is not None:
            first[r] = min(i, first.get(r, i))
    return sorted((str(i), int(linked[k].sum()), str(first.get(root[k]))) for k, (i, _, _) in enumerate(rows))


def made(seed, n=300, size=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, size))
    rows = []
    for k in range(n):
        v = centres[rng.integers(12)] * rng.uniform(0.1, 9) + rng.normal(size=size) * rng.choice([0, 0.15, 0.6])
        rows.append((k, [float(np.float32(x)) for x in v], int(rng.integers(3))))
    copy = rows[5][1]
    rows += [(1000 + k, copy, rows[5][2]) for k in range(40)]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * size, 1), (2003, [float("nan")] * size, 1),
             (2004, [float("inf")] * size, 1), (2005, [1.0, None], 1), (2006, copy, None), (2007, copy, None),
             (2008, copy[:5], rows[5][2]), (2009, copy[:5], rows[5][2]), (None, copy, rows[5][2]), (7, copy, rows[5][2]),
             (2010, [-0.0] + copy[1:], 2), (2011, [0.0] + copy[1:], 2), (2012, [1e-30] * size, 0), (2013, [2e38] * size, 0)]
    return rows


@pytest.mark.parametrize("block, partition, smallest, fan", [(256, 8192, 64, 64), (16, 50, 4, 64), (16, 12, 4, 3)])
def test_equals_brute_force(spark, monkeypatch, block, partition, smallest, fan):
    monkeypatch.setattr(vector_groups, "FAN", fan)
    monkeypatch.setattr(vector_groups, "BLOCK", block)
    monkeypatch.setattr(vector_groups, "PARTITION", partition)
    monkeypatch.setattr(vector_groups, "SMALLEST", smallest)
    rows = made(block)
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    found = vector_groups.near_duplicates(df, least=0.93).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in found) == expected(rows, 0.93)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found if r.vec_id is not None)


def test_skipped_intervals_hold_no_pair():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(300, 6))
    b = np.concatenate([a[:50] + rng.normal(size=(50, 6)) * 0.05, rng.normal(size=(100, 6))])
    axes = np.linalg.eigh(a.T @ a)[1][:, ::-1]
    got = {(i, j) for x, y in vector_groups.near_pairs(a, b, axes, 0.95) for i, j in zip(x.tolist(), y.tolist())}
    cosine = vector_groups.unit(a) @ vector_groups.unit(b).T
    assert got == set(zip(*(k.tolist() for k in np.nonzero(cosine >= 0.95))))


def test_near_partitions_by_runs(spark, monkeypatch):
    monkeypatch.setattr(vector_groups, "FAN", 4)
    rng = np.random.default_rng(5)
    low = np.sort(rng.uniform(-1, 1, size=(70, 2)), axis=0)
    high = low + rng.uniform(0, 0.1, size=low.shape)
    # partition 20 holds two labels
    rows = [(k, int(k > 20), 2, low[k].tolist(), high[k].tolist()) for k in range(70)] + [(20, 1, 2, [0.0, 0.0], [0.1, 0.1])]
    parts = spark.createDataFrame(rows, "part int, label int, size int, low array<double>, high array<double>")
    found = vector_groups.near_partitions(parts, 70, 0.01).collect()
    want = set()
    for p, l, _, a, b in rows:
        for q, m, _, c, d in rows:
            gap = np.maximum(0, np.maximum(np.subtract(a, d), np.subtract(c, b)))
            if p <= q and l == m and (gap**2).sum() <= 0.01:
                want.add((l, 2, p, q))
    assert len(found) == len(want) and {tuple(r) for r in found} == want


def test_empty_and_all_unusable(spark):
    df = spark.createDataFrame([(1, None, 1, "", 0, "")], SCHEMA)
    assert [tuple(r) for r in vector_groups.near_duplicates(df).collect()] == [(1, 0, 1, True)]
    assert vector_groups.near_duplicates(df.limit(0)).collect() == []
