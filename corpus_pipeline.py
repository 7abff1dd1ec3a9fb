"""The corpus pipeline: quality rules, near-dedup, substring dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return the columns
of documents. A runner writes each stage's rows as Parquet and reads them as the next one's docs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyweir.llm import decontam, host_rules, minhash, packing, spans
from tallyweir.llm.queries import tokenizer_files
from tallyweir.llm.tables import new_path, remove, table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return host_rules.passing(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.drop_near_duplicates(docs, percent=80, bands=minhash.LOW_BANDS)


def span_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return spans.without_repeats(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each sequence: doc_id, start, length, doc_tokens, token_bytes, bucket, sequence_id, offset."""
    return packing.pack(docs, **tokenizer_files())


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("span_dedup", span_dedup), ("decontaminate", decontaminate), ("pack", pack)]

#: SQL cannot tokenize or compare near duplicates at this size; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over documents. Each stage's table is written in the shared folder, and deleted when the next
    one is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = new_path(spark, f"pipeline-{name}")
        docs = written(stage(spark, docs, sf_dir), path)
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
