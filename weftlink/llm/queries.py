"""The registered queries of this subpackage: each applies its operator to its whole table and derives the agreed columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, exact_topk, language_id, near_dedup, packing, quality_rules, secrets, source_mix, toxicity, warc
from .common import cut, doc_hash, drop_folder, read_table, shared_folder
from .oracles import ORACLES

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of documents: doc_id, class_id (the least doc_id of the class)."""
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt where crc32(doc_id) mod 4 is not 2."""
    rest = doc_hash("doc_id", 4)
    return language_id.identify(read_table(spark, sf_dir, "documents"), held_out=rest == 2, usable=rest != 2)


def op3_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as a WARC archive into the shared folder and read back; the archive goes when the result is kept."""
    path = shared_folder(spark, "warc")
    warc.write_archive(read_table(spark, sf_dir, "pages"), path)
    out = cut(warc.read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    drop_folder(spark, path)
    return out


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt where crc32(doc_id) mod 5 is not 0."""
    rest = doc_hash("doc_id", 5)
    return toxicity.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), held_out=rest == 0, usable=rest != 0)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations and conversation -7 formatted, read back and digested."""
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat_format.digests(chat_format.format_conversations(rows.unionByName(more)))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the certified verdict of every document."""
    return quality_rules.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents packed into sequences of 1,024 tokens."""
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return source_mix.mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five largest integer inner products of every 50th vector with all others."""
    return exact_topk.top_k(exact_topk.quantised(read_table(spark, sf_dir, "embeddings")), F.col("vec_id") % 50 == 0, 5)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    return secrets.scan(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_order_minhash, op2_language_id, op3_warc_segments, op4_toxicity, op5_chat_format,
        op6_quality_rules, op7_sequence_packing, op8_source_mix, op9_exact_topk, op10_secret_scan,
    )
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
