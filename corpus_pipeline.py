"""From raw documents to packed training sequences, in five stages.

Each stage gets what its predecessor kept, read back from Parquet:

1. quality classifier: documents scored below the cut go;
2. order-MinHash near-duplicates: one document of each group stays;
3. benchmark decontamination: documents that hold a benchmark item go;
4. secret scan: secrets are replaced by a mark, all documents stay;
5. best-fit packing: token pieces and their places in sequences of 1024 tokens.

All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger.llm import (
    op2_order_minhash,
    op4_packing,
    op7_decontamination,
    op8_secrets,
    op10_quality_classifier,
)
from twinledger.operators.balance import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op10_quality_classifier.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op2_order_minhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op7_decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op8_secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = op4_packing.tokenize(docs)
    return op4_packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", near_dedup),
    ("decontamination", decontaminate),
    ("secret scan", remove_secrets),
    ("packing", pack),
]

#: The stages need models and alignments that SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
