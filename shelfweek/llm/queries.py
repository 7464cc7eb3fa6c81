"""Registered queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import (
    chat_format,
    decontaminate,
    hard_negatives,
    line_dedup,
    merkle,
    oracle,
    packing,
    pii,
    quality,
    secret_scan,
    simhash,
    url_rules,
    vector_groups,
    warc,
)

# fixed values of the queries
CONFLICTING = [
    (-1, 0, "user", "</s>[INST] ok [/INST]"),
    (-1, 1, "assistant", "</s>[INST] ok [/INST]"),
]
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LEAF_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def _read(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_embedding_near_dedup(spark, folder):
    return vector_groups.near_duplicates(_read(spark, folder, "embeddings"), least=0.93)


def op2_chat_formatting(spark, folder):
    rows = _read(spark, folder, "conversations")
    columns = ("conv_id", "turn", "role", "text")
    more = [F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, row)]) for row in CONFLICTING]
    more = spark.range(1).select(F.inline(F.array(*more)))
    return chat_format.digests(chat_format.format_conversations(rows.select(*columns).union(more)))


def op3_substring_dedup(spark, folder):
    found = line_dedup.dedup(_read(spark, folder, "documents"))
    spans = F.transform(
        "spans", lambda s: F.concat_ws(":", *[s[k].cast("string") for k in ("start", "end", "first")])
    )
    return found.withColumn("spans", F.array_join(spans, ","))


def op4_url_filters(spark, folder):
    pages = _read(spark, folder, "pages").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge(pages, rules).drop("url")


def op5_best_fit_packing(spark, folder):
    packed = packing.packed_documents(_read(spark, folder, "documents"), VOCABULARY, capacity=2048)
    return packing.digested(packed)


def op6_simhash_near_dedup(spark, folder):
    return simhash.near_duplicates(_read(spark, folder, "documents"), shingle=3, max_bits=2)


def op7_quality_classifier(spark, folder):
    docs = _read(spark, folder, "documents")
    model = quality.train(docs, _read(spark, folder, "labels"))
    return quality.scores(docs, model, threshold=0.3)


def op8_secret_scans(spark, folder):
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    forest, trigrams = secret_scan.prepared(docs)
    found = secret_scan.scan(docs, forest, trigrams)
    return found.select(
        "doc_id",
        F.size("secrets").cast("long").alias("n_secrets"),
        F.array_join(
            F.transform("secrets", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))),
            ",",
        ).alias("spans"),
    )


def op9_benchmark_decontamination(spark, folder):
    found = decontaminate.contamination(
        _read(spark, folder, "documents"), _read(spark, folder, "benchmark"), width=10
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_pii(spark, folder):
    return pii.report(_read(spark, folder, "documents"))


def op11_merkle_manifest(spark, folder):
    docs = _read(spark, folder, "documents")
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = merkle.digest([lower if c == "text" else F.col(c) for c in LEAF_FIELDS])
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return merkle.manifest(docs, LEAF_FIELDS, F.when(chosen, tampered))


def op12_warc(spark, folder):
    files = warc.write_archives(_read(spark, folder, "pages"), warc.new_folder(spark), least=0)
    return warc.read_archives(files).select(
        F.col("source_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to_source_id").cast("long").alias("refers_to"),
    )


def op13_hard_negative_mining(spark, folder):
    rows = _read(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_url_filters": op4_url_filters,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_secret_scans": op8_secret_scans,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_pii": op10_pii,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_warc": op12_warc,
    "op13_hard_negative_mining": op13_hard_negative_mining,
}
ORACLE: dict[str, str] = dict(oracle.ORACLE)
