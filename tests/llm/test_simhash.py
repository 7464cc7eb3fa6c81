import random

import numpy as np
import pytest

from shelfweek.llm import components, simhash
from tests.llm import brute


def variants(seed, n=60):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        if out and rng.random() < 0.6:
            words = (rng.choice(out) or "").split()
            for _ in range(rng.randint(0, 2)):
                if words:
                    words[rng.randrange(len(words))] = f"w{rng.randint(0, 50)}"
            out.append("  ".join(words))
        else:
            out.append(" ".join(f"W{rng.randint(0, 300)}" for _ in range(rng.randint(0, 400))))
    return out


def expected(rows):
    prints = np.array([brute.fingerprint(t) for _, t in rows], np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None]) <= 2
    root = brute.groups(len(rows), near)
    first = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            first[r] = min(i, first.get(r, i))
    return [(i, f"{int(p):016x}", first.get(r)) for (i, _), p, r in zip(rows, prints, root)]


def test_groups_equal_brute_force_with_nulls_repeats_and_clashing_names(spark):
    texts = variants(1) + [None, "", " \t", "one", "ONE", "one two", "é É", "a" * 50]
    rows = [(k * 3 % 97 if k % 11 else None, t) for k, t in enumerate(texts)]
    rows += rows[:3]
    docs = spark.createDataFrame(
        [(t, i, 1, "x", 2, "y") for i, t in rows],
        "text string, doc_id long, fp int, component_id string, _row int, root string",
    )
    found = simhash.near_duplicates(docs).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0)
    assert sorted(map(tuple, found), key=key) == sorted(expected(rows), key=key)
    # one row of each group stays, with all its columns
    kept = simhash.one_of_each(docs).collect()
    assert len(kept) == len({(r[2], r[1]) if r[2] is None else r[2] for r in expected(rows)})
    assert set(kept[0].asDict()) == set(docs.columns)


def test_the_trie_is_opened_as_deep_as_crowded_parts_need(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (40, 6), dtype=np.uint64)
    fps = np.unique(np.concatenate([base, *(base ^ f for f in flips.T)]))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    links = simhash.trie_links(df, budget=2, leaf=8, stride=4)
    found = {r.node: r.root for r in components.components(links, "a", "b").collect()}
    near = np.bitwise_count(fps[:, None] ^ fps[None]) <= 2
    root = brute.groups(len(fps), near)
    signed = fps.view(np.int64)
    members = {}
    for k, r in enumerate(root):
        members.setdefault(r, []).append(int(signed[k]))
    for own in members.values():
        for x in own:
            assert found.get(x, x) == min(own)


@pytest.mark.parametrize("depth", [0, 64])
def test_one_leaf_holds_all(depth):
    a = np.array([1, 3, 7, 15, 1 << 40], np.uint64)
    found = simhash.leaf_links(a, a, 0, 0, 1)
    assert {tuple(x) for x in found.tolist()} == {(1, 0), (2, 0), (3, 0)}


def test_long_text_in_slices_and_empty_table(spark, monkeypatch):
    text = "lorem ipsum dolor " * 5000
    whole = simhash.text_fingerprint(text.encode(), 3)
    monkeypatch.setattr(simhash, "SLICE", 100)
    assert simhash.text_fingerprint(text.encode(), 3) == whole == brute.fingerprint(text)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).collect() == []


def test_components_of_a_path_a_star_and_a_cycle(spark):
    path = [(k, k + 1) for k in range(100, 160)]
    star = [(500, k) for k in range(200, 240)]
    cycle = [(300, 301), (301, 302), (302, 300), (303, 303), (None, 304)]
    df = spark.createDataFrame(path + star + cycle, "a long, b long")
    found = {r.node: r.root for r in components.components(df, "a", "b").collect()}
    assert found == (
        {k: 100 for k in range(100, 161)}
        | {k: 200 for k in [500, *range(200, 240)]}
        | {k: 300 for k in (300, 301, 302)}
    )
