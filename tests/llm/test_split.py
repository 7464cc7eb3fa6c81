"""Results do not change when a table is cut into partitions differently between two reads."""

import random

import pytest

import corpus_pipeline
from shelfweek.llm import line_dedup, packing, simhash, url_rules
from shelfweek.llm.queries import VOCABULARY

FOLDER = "/root/testdata/sf0.001"
SETTINGS = {"spark.sql.files.minPartitionNum": "7", "spark.sql.files.openCostInBytes": "0"}


@pytest.fixture
def recut(spark):
    """Build with one split, then run with another."""

    def run(build):
        df = build()
        try:
            for k, v in SETTINGS.items():
                spark.conf.set(k, v)
            return sorted(map(str, df.collect()))
        finally:
            for k in SETTINGS:
                spark.conf.unset(k)

    return run


def words(rng, n):
    return " ".join(rng.choice(["ant", "bee", "cat", "dog", "eel", "fox", "gnu", "hen", "ibis", "jay"]) for _ in range(n))


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    rng = random.Random(4)
    lines = [words(rng, 12) for _ in range(60)]
    rows = [(k, "\n".join(rng.sample(lines, 3))) for k in range(300)]
    rows += [(1000 + k, rows[k % 7][1]) for k in range(60)]
    path = str(tmp_path_factory.mktemp("docs") / "t")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(9, "doc_id").write.parquet(path)
    return path


def test_dedup_of_lines(spark, documents, recut):
    build = lambda: line_dedup.dedup(spark.read.parquet(documents))
    assert recut(build) == sorted(map(str, build().collect()))


def test_one_of_each(spark, documents, recut):
    build = lambda: simhash.one_of_each(spark.read.parquet(documents))
    found = recut(build)
    assert found == sorted(map(str, build().collect())) and len(found) <= 300


def test_url_rules(spark, documents, recut):
    rules = spark.createDataFrame(
        [("com", f"/{k}", v) for k in range(5) for v in ("allow", "block")], "host string, path string, verdict string"
    )

    def build():
        docs = spark.read.parquet(documents)
        return url_rules.judge(docs.selectExpr("doc_id", "concat('http://a.com/', doc_id) AS url"), rules)

    assert recut(build) == sorted(map(str, build().collect()))


def test_packing(spark, documents, recut):
    found = recut(lambda: packing.packed_documents(spark.read.parquet(documents), VOCABULARY, 64).drop("sequence_id", "offset"))
    assert found == sorted(
        map(str, packing.packed_documents(spark.read.parquet(documents), VOCABULARY, 64).drop("sequence_id", "offset").collect())
    )


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages(spark, recut, tmp_path, name):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs.repartition(9, "doc_id").write.parquet(str(tmp_path / "docs"))
    stage = dict(corpus_pipeline.STAGES)[name]
    build = lambda: stage(spark, spark.read.parquet(str(tmp_path / "docs")), FOLDER)
    assert recut(build) == sorted(map(str, build().collect()))
