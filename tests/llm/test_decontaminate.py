import random

import pytest

from shelfweek.llm import benchmark_join, decontaminate
from tests.llm import brute


def made(seed):
    rng = random.Random(seed)
    pick = lambda n: " ".join(rng.choice(["a", "B", "c1", "é", "d-e", "zz"]) for _ in range(n))
    items = [(k, pick(rng.choice([0, 1, 2, 3, 5, 6, 8, 12]))) for k in range(12)]
    items += [(None, "null item words here now"), (3, "again three"), (20, None), (21, "?!"), (22, items[5][1])]
    docs = [(k, pick(rng.randint(0, 40))) for k in range(60)]
    docs += [(60, None), (61, ""), (None, "x null ITEM, words. here now y"), (5, docs[5][1])]
    docs += [(62, " ".join(t or "" for _, t in items)), (63, "again three " * 3000)]
    return docs, items


@pytest.mark.parametrize("block", [8 << 20, 64, None])
@pytest.mark.parametrize("width", [4, 10])
def test_equals_brute_force_in_one_block_and_in_many(spark, monkeypatch, block, width):
    if block:
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    else:
        monkeypatch.setattr(decontaminate, "JOIN_BYTES", 0)
    docs, items = made(width)
    df = spark.createDataFrame([(t, i, 1, "z") for i, t in docs], "text string, doc_id long, n_words int, _id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(df, bench, width).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found), key=str)
    want = [(i, *brute.contamination(t, items, width)) for i, t in docs]
    assert got == sorted(want, key=str)
    clean = decontaminate.clean(df, bench, width)
    assert clean.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in clean.where("doc_id IS NOT NULL").collect() if r.text) == sorted(
        (i, t) for (i, t), w in zip(docs, want) if not w[2] and t and i is not None
    )


def test_spans_do_not_run_over_the_end_of_a_text(spark):
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x one two three"), (2, "one two three y"), (3, "three one two")], "doc_id long, text string").coalesce(1)
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in decontaminate.contamination(docs, bench, 10).collect()}
    assert found == {1: [(1, 4)], 2: [(0, 3)], 3: []}


def long_docs(seed, n=400):
    """Documents and items of few common words, so that runs of known shingles are many."""
    rng = random.Random(seed)
    words = ["the", "of", "a", "in", "to", "is", "on", "it"] + [f"w{k}" for k in range(40)]
    pick = lambda n: " ".join(rng.choices(words, [20] * 8 + [1] * 40, k=n))
    items = [(k, pick(rng.choice([11, 14, 30, 60]))) for k in range(150)] + [(900, "w1 of w2 in"), (901, "w1 of w2 in")]
    docs = []
    for k in range(n):
        text = pick(rng.randint(5, 300))
        if k % 3 == 0:
            part = rng.choice(items)[1].split()
            at = rng.randint(0, max(0, len(part) - 12))
            text += " " + " ".join(part[at : at + rng.choice([9, 10, 12])]) + " " + pick(8)
        docs.append((k, text))
    return docs, items


def test_joined_by_shuffles_equals_sent_blocks(spark, monkeypatch):
    docs, items = long_docs(3)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    bench = spark.createDataFrame(items, "item_id long, text string")

    def rows():
        found = decontaminate.contamination(df, bench, 10).collect()
        return sorted((r.doc_id, r.n_words, r.n_hit, r["items"], [tuple(s) for s in r.spans]) for r in found)

    one_block = rows()
    left = {r.doc_id for r in decontaminate.clean(df, bench, 10).collect()}
    monkeypatch.setattr(decontaminate, "JOIN_BYTES", 1000)
    # a bitmap so small that most of what passes is none of the windows
    monkeypatch.setattr(benchmark_join, "MOST_BITS", 1 << 15)
    assert rows() == one_block
    assert {r.doc_id for r in decontaminate.clean(df, bench, 10).collect()} == left
    assert 50 < len(left) < 350


@pytest.mark.parametrize("largest", [None, -1])
def test_empty_tables(spark, monkeypatch, largest):
    if largest:
        monkeypatch.setattr(decontaminate, "JOIN_BYTES", largest)
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    found = decontaminate.contamination(docs, none).collect()
    assert [(r.n_words, r.n_hit, r["items"]) for r in found] == [(3, 0, [])]
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.contamination(docs.limit(0), items).collect() == []
    assert decontaminate.clean(docs, none).count() == 1
    assert decontaminate.clean(docs, items).count() == 0


def test_copies_of_an_item_are_one_row_of_a_block(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 200)
    items = [(1, "red green blue cyan")] * 60 + [(k, f"alpha beta gamma d{k}") for k in range(2, 30)]
    bench = spark.createDataFrame(items, "item_id long, body string")
    blocks = list(decontaminate._blocks(bench, "item_id", "body"))
    assert sorted(r for b in blocks for r in b) == sorted({(str(i), t) for i, t in items})
    docs = spark.createDataFrame([(1, "a red green blue cyan b"), (2, "alpha beta")], "doc_id long, text string")
    found = decontaminate.contamination(docs, bench, item_text_col="body").collect()
    assert {(r.doc_id, r.n_hit, tuple(r["items"])) for r in found} == {(1, 4, ("1",)), (2, 0, ())}
    assert [r.doc_id for r in decontaminate.clean(docs, bench, item_text_col="body").collect()] == [2]
