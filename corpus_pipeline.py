"""Corpus pipeline: quality, near-dedup, secrets, mixing, packing, in that order.

Each stage takes the rows that its predecessor kept. The quality stage drops what
importance resampling does not draw; near-dedup keeps one document of each class;
the secret scan replaces every span by a mark and keeps all rows; mixing repeats or
drops rows by their fitted rates; packing returns the pieces of fixed-size sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opspulse.llm import mixing, neardup, packing, quality, secrets
from opspulse.llm.common import table, written

#: SQL has no hashed models, alignment or gradient steps; the stages are tested against brute force.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    drawn = quality.resample(docs, table(spark, sf_dir, "labels"), keep_text=True)
    return drawn.select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.deduplicated(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact_secrets(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, table(spark, sf_dir, "labels"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_documents(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("mixing to target weights", mix_domains),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage{i}")
    return docs
