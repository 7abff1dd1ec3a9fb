"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontam, filter_audit, host_rules, langid, licenses, merkle, minhash, packing, spans, warc, weak_labels
from .oracles import ORACLE_SQL  # noqa: F401
from .tables import table


def tokenizer_files() -> dict[str, str]:
    """Paths of the public vocabulary: for tokenizers, and the same as ranks for tiktoken."""
    import public_tokenizers

    return {"tokenizer": public_tokenizers.path("byte_bpe_50k.json"), "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}


def word_tokenizer() -> str:
    """Path of the public vocabulary with word ends."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -1, whose texts hold control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.digests(chat.format_chat(turns.unionByName(own)))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_labels.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.judge(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select("doc_id", *host_rules.MEASURES, "base_failed", "kept")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("item_ids", lambda x: x.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op6_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.drop_repeated_spans(table(spark, sf_dir, "documents")).select("doc_id", "n_sentences", "n_removed", "chars_removed", "text")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.round_trip(table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), **tokenizer_files())
    return pieces.select("doc_id", "start", "length", F.crc32("token_bytes").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))


def op11_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), word_tokenizer()), word_tokenizer())
    return read.select("doc_id", "n_tokens", F.sha2("token_bytes", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.manifest(docs, seen=merkle.tampered(docs))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {q.__name__: q for q in (op1_chat_format, op2_minhash_near_dedup, op3_quality_classifier, op4_quality_rules, op5_decontamination, op6_span_dedup, op7_warc, op8_license_scan, op9_packing, op10_language_id, op11_bpe_codec, op12_merkle_manifest, op13_filter_audit)}
