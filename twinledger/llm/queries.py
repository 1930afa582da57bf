"""The operators over the given tables, with the SQL that has to give the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger.llm import (
    op1_licenses,
    op2_order_minhash,
    op3_quality_rules,
    op4_packing,
    op5_site_trees,
    op6_language_id,
    op7_decontamination,
    op8_secrets,
    op9_warc,
    op10_quality_classifier,
    op11_merkle_manifest,
    op12_ngram_join,
    op13_token_alignment,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_license_scan(spark, sf_dir):
    return op1_licenses.scan(table(spark, sf_dir, "documents"))


ORACLES["op1_license_scan"] = op1_licenses.sql()


@query
def op2_near_duplicates(spark, sf_dir):
    return op2_order_minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_quality_rules_forest(spark, sf_dir):
    return op3_quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "anomaly", "kept")


@query
def op4_best_fit_packing(spark, sf_dir):
    pieces = op4_packing.tokenize(table(spark, sf_dir, "documents"))
    return op4_packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


@query
def op5_main_text(spark, sf_dir):
    return op5_site_trees.extract(table(spark, sf_dir, "pages"))


@query
def op6_language(spark, sf_dir):
    return op6_language_id.identify(table(spark, sf_dir, "documents"))


@query
def op7_benchmark_passages(spark, sf_dir):
    return op7_decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_secret_findings(spark, sf_dir):
    return op8_secrets.scan(table(spark, sf_dir, "documents"))


@query
def op9_warc_archives(spark, sf_dir):
    files = op9_warc.archive(table(spark, sf_dir, "pages"))
    found = op9_warc.records_of(op9_warc.read_archives(files, with_data=False))
    return found.select(F.col("record_id").try_cast("bigint").alias("page_id"), "payload_bytes", "payload_digest",
                        "record_type", F.col("refers_to").try_cast("bigint").alias("refers_to"))


ORACLES["op9_warc_archives"] = op9_warc.sql()


@query
def op10_quality_score(spark, sf_dir):
    return op10_quality_classifier.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_merkle_manifest_proofs(spark, sf_dir):
    return op11_merkle_manifest.document_manifest(table(spark, sf_dir, "documents"))


ORACLES["op11_merkle_manifest_proofs"] = op11_merkle_manifest.sql()


@query
def op12_ngram_components(spark, sf_dir):
    return op12_ngram_join.ngram_join(table(spark, sf_dir, "documents"))


ORACLES["op12_ngram_components"] = op12_ngram_join.sql()


@query
def op13_token_alignment_counts(spark, sf_dir):
    return op13_token_alignment.align_documents(table(spark, sf_dir, "documents"))


def load() -> tuple[dict[str, Query], dict[str, str]]:
    return dict(QUERIES), dict(ORACLES)
