"""Registered queries against SQL, and the pipeline stage by stage against plain rules."""

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from checks.compare import duck, sorted_rows
from shelfweek.llm import decontaminate, queries, quality
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_equals_sql(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    found = duck(FOLDER).execute(queries.ORACLE[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(columns, found.fetchall())


def test_thirteen_queries_and_a_pipeline():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    import __spark_entry__

    assert {"pipeline", *queries.QUERIES} <= set(__spark_entry__.queries())


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        old, new = before.collect(), docs.collect()
        if name != "best_fit_packing":
            assert docs.columns == corpus_pipeline.COLUMNS
        kept = {r.doc_id for r in new}
        if name == "quality_classifier":
            model = quality.train(before, labels)
            judged = {r.doc_id: r.predicted for r in quality.scores(before, model).collect()}
            assert kept == {i for i, p in judged.items() if p}
            bad = {r.doc_id for r in labels.where("quality = 0").collect()}
            assert len(bad & kept) <= 0.2 * len(bad)
        elif name == "simhash_near_dedup":
            old.sort(key=lambda r: r.doc_id)
            prints = np.array([brute.fingerprint(r.text) for r in old], np.uint64)
            root = brute.groups(len(old), np.bitwise_count(prints[:, None] ^ prints[None]) <= 2)
            assert kept == {old[r].doc_id for r in root}
        elif name == "benchmark_decontamination":
            windows = {tuple(w[k : k + 10]) for _, t in items for w in [brute.words(t)] for k in range(len(w) - 9)}
            hit = {
                r.doc_id
                for r in old
                for w in [brute.words(r.text)]
                if any(tuple(w[k : k + 10]) in windows for k in range(len(w) - 9))
            }
            assert kept == {r.doc_id for r in old} - hit
            assert decontaminate.clean(docs, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).count() == len(new)
        elif name == "secret_scans":
            assert kept == {r.doc_id for r in old} and len(old) == len(new)
            assert all(r.n_chars == len(r.text) for r in new)
            assert not any("password=" in r.text and "password=[secret]" not in r.text for r in new)
        else:
            assert kept == {r.doc_id for r in old}
            used = {}
            for r in new:
                used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
            assert max(used.values()) <= 2048
            assert len(used) <= 1.05 * -(-sum(used.values()) // 2048) + 1


def test_sequences_can_be_rebuilt_from_the_last_stage(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").limit(50)
    texts = {r.doc_id: r.text for r in docs.collect()}
    plain, parts, sequences = Tokenizer.from_file(queries.VOCABULARY), {}, {}
    for r in corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect():
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert len(ids) == r.length
        parts.setdefault(r.doc_id, {})[r.start] = ids
        sequences.setdefault(r.sequence_id, {})[r.offset] = ids
    for i, own in parts.items():
        want = [*plain.encode(texts[i] or "", add_special_tokens=False).ids, 0]
        assert [n for _, part in sorted(own.items()) for n in part] == want
    assert parts.keys() == texts.keys()
    for own in sequences.values():
        upto = 0
        for offset, ids in sorted(own.items()):
            assert offset == upto
            upto += len(ids)
        assert upto <= 2048
