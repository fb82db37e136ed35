"""Corpus preparation: quality rules, near-duplicate removal, secret removal, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and reread as the next stage's docs. All but the last return documents'
columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weftlink.llm import near_dedup, packing, quality_rules, secrets, source_mix
from weftlink.llm.common import cut, drop_folder, read_table, shared_folder
from weftlink.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and no certified rule rejects."""
    return quality_rules.keep_good(docs, read_table(spark, sf_dir, "labels"))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, that with the least doc_id."""
    return near_dedup.keep_first(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets replaced by marks."""
    return secrets.remove_secrets(docs)


def blend(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often and as far as the mix takes them."""
    return source_mix.mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1,024 tokens."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("near_dedup", dedup),
    ("secret_scan", clean),
    ("source_mix", blend),
    ("sequence_packing", pack),
]

#: Hashed shingles, entropy and tokenisation have no SQL form; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that the stages make of sf_dir's documents. What the stages hand on goes when the next one has read it, and all of it in the end."""
    root = shared_folder(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    try:
        for n, (name, stage) in enumerate(STAGES):
            stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
            docs = spark.read.parquet(f"{root}/{name}")
            if n:
                drop_folder(spark, f"{root}/{STAGES[n - 1][0]}")
        return cut(docs)
    finally:
        drop_folder(spark, root)
