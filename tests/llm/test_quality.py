import zlib

import numpy as np
import pytest

from shelfweek.llm import quality
from shelfweek.llm.queries import op7_quality_classifier


def grams(text):
    return quality.ngrams(np.frombuffer(text.encode(), np.uint8), np.zeros(quality.BUCKETS, bool))


def test_ngrams_are_indicators_over_the_whole_text(monkeypatch):
    text = "the cat sat on the mat. " * 50 + "zq!"
    whole = grams(text)
    assert (np.diff(whole) > 0).all() and set(grams("zq!")) <= set(whole)
    monkeypatch.setattr(quality, "STRETCH", 7)
    assert (grams(text) == whole).all()
    assert len(grams("")) == 0
    same = set(grams("go go go go")) - set(grams("go ask go ask"))
    assert {0, 1, 2} <= same


def test_held_out_documents_of_the_test_tables(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = op7_quality_classifier(spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    tested = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(tested) > 100 and np.mean([p == y for p, y in tested]) > 0.97


def test_labels_of_the_held_out_fold_are_not_learned(spark):
    rows = [(k, ("good words here " if k % 2 else "JUNK!!! ") * 5) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    right = [(k, k % 2) for k, _ in rows]
    wrong = [(k, y if zlib.crc32(str(k).encode()) % 5 else 1 - y) for k, y in right]
    found = []
    for labels in (right, wrong):
        model = quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
        found.append({r.doc_id: r.score for r in quality.scores(docs, model).collect()})
    assert found[0] == found[1]
    assert all((s >= 0.5) == bool(k % 2) for k, s in found[0].items())


def test_nulls_repeats_and_clashing_names(spark):
    texts = ["fine text of words", "BAD!!! BAD!!!"] * 40
    docs = spark.createDataFrame(
        [(t, k, 1.0, "p", True) for k, t in enumerate(texts)]
        + [(None, 500, 1.0, "p", True), ("", 501, 1.0, "p", True), ("fine", None, 1.0, "p", True)] * 2
        + [("fine text " * 100_000, 502, 1.0, "p", True)],
        "text string, doc_id long, score double, _text string, held_out boolean",
    )
    labels = spark.createDataFrame(
        [(k, 1 - k % 2, 0) for k in range(80)] + [(None, 1, 0), (1, None, 0), (2, 7, 0), (3, 0, 0)],
        "doc_id long, quality int, score int",
    )
    model = quality.train(docs, labels)
    rows = quality.scores(docs, model).collect()
    assert len(rows) == 87
    empty = {r.score for r in rows if r.doc_id in (500, 501)}
    assert len(empty) == 1
    assert all(r.held_out is False for r in rows if r.doc_id is None)
    assert next(r.predicted for r in rows if r.doc_id == 502) == 1
    kept = quality.kept(docs, model, 0.3)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in rows)


@pytest.mark.parametrize("label", [[], [(1, 1)], [(k, 1) for k in range(9)]])
def test_too_few_labels_give_the_share_of_the_classes(spark, label):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(9)], "doc_id long, text string")
    model = quality.train(docs, spark.createDataFrame(label, "doc_id long, quality int"))
    scores = {r.score for r in quality.scores(docs, model).collect()}
    assert len(scores) == 1 and min(scores) >= 0.5
    assert quality.scores(docs.limit(0), model).collect() == []


def test_dual_descent_reaches_the_margin():
    rng = np.random.default_rng(1)
    rows = [np.array([0 if y else 1, *rng.choice(np.arange(2, 40), 5, replace=False)]) for y in (0, 1) * 30]
    labels = np.array([0, 1] * 30)
    values = [np.ones(len(r)) for r in rows]
    weights, bias = quality.dual_descent(rows, values, labels, np.full(60, 10.0), rounds=200)
    margins = np.array([weights[r].sum() + bias for r in rows]) * (2 * labels - 1)
    assert margins.min() > 0.95


def test_an_id_with_very_many_texts_is_learned_from_a_few(spark, monkeypatch):
    rows = [(1, f"good {k} words here") for k in range(40)] + [(k, "bad spam spam") for k in range(2, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k == 1)) for k in range(1, 9)], "doc_id long, quality int")
    monkeypatch.setattr(quality, "PER_ID", 3)
    held = [k for k in range(1, 9) if zlib.crc32(str(k).encode()) % 5 == 0]
    model = quality.train(docs, labels)
    scores = {r.doc_id: r.score for r in quality.scores(docs, model, 0.3).collect()}
    assert 1 not in held and scores[1] > scores[2]
    again = quality.train(docs.union(docs.where("doc_id = 1")), labels)
    assert (again.weights == model.weights).all()
