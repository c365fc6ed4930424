"""A training corpus from documents: clean, de-duplicate, mix and pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowlark.llm import exact_dedup, line_rules, mixing, near_dedup, packing
from flowlark.session import drop_path, scratch_path, ship_package


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line and base rules, without their failing lines."""
    return line_rules.clean_documents(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the largest id."""
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    return near_dedup.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document taken twice comes twice."""
    return mixing.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and place in it."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("mixing", mix),
    ("packing", pack),
]

#: Sketches, random numbers and packing are not expressible in SQL; the tests hold
#: every stage against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of documents, each written and read again."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:  # nothing reads the stage before this one any more
            drop_path(spark, before)
        before = path
    return docs
