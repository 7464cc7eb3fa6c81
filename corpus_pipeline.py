"""From raw documents to training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept, and returns the
columns of ``documents``; the last returns packed pieces with their token ids. A runner may write each result as
Parquet and hand on what it reads back; ``run`` does so itself, in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfweek.llm import decontaminate, packing, quality, secret_scan, simhash
from shelfweek.llm.queries import VOCABULARY
from shelfweek.llm.scratch import settle

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark, docs, sf_dir):
    """Documents scored below 0.3 go. The model learns from the labelled rows of ``docs``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = quality.kept(docs, quality.train(docs, labels), threshold=0.3)
    return kept.select(*COLUMNS)


def simhash_near_dedup(spark, docs, sf_dir):
    """One document of each group stays: the one with the smallest id."""
    return simhash.one_of_each(docs, shingle=3, max_bits=2).select(*COLUMNS)


def benchmark_decontamination(spark, docs, sf_dir):
    """Documents that hold a window of a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean(docs, benchmark, width=10).select(*COLUMNS)


def secret_scans(spark, docs, sf_dir):
    """All documents stay; secrets in their texts are replaced, and n_chars follows the text."""
    forest, trigrams = secret_scan.prepared(docs)
    clean = secret_scan.redact(docs.select(*COLUMNS), forest, trigrams)
    changed = F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", changed)


def best_fit_packing(spark, docs, sf_dir):
    """Pieces with their token ids, and the sequence and the place they are packed into."""
    return packing.packed_documents(docs, VOCABULARY, capacity=2048)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]
#: No SQL says what the classifier and the fingerprints decide; the stages are tested against
#: brute force instead.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
