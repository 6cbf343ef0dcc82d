"""The registered queries of this subpackage: one thin query per operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm.oracle import ORACLE  # noqa: F401
from quire.session import apply_runtime_conf, scratch_path
from quire.sources.tables import table


def prepare(spark: SparkSession) -> None:
    """Settings that the operators rely on."""
    apply_runtime_conf(spark)
    # Small Arrow batches bound a Python worker's memory on long texts.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return table(spark, sf_dir, "documents")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a ledger of its own, so each call scans every blob."""
    import uuid

    from quire.llm import secret_scan as op
    docs = _docs(spark, sf_dir)
    return op.digest(op.document_findings(docs, scratch_path(spark, f"ledger-{uuid.uuid4().hex}")))


def op2_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm import phrase_dedup as op
    return op.digest(op.remove_phrases(_docs(spark, sf_dir)))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm import suffix_dedup as op
    return op.digest(op.remove_repeats(_docs(spark, sf_dir), keep_first=False))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm import toxicity as op
    return op.score(_docs(spark, sf_dir), table(spark, sf_dir, "labels"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm import decontaminate as op
    return op.contaminated(_docs(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm import sharding as op
    return op.shard(_docs(spark, sf_dir))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm import jaccard_join as op
    return op.digest(op.join(_docs(spark, sf_dir)))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm import pii as op
    return op.digest(op.find(_docs(spark, sf_dir)))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm import quality_rules as op
    return op.judged(_docs(spark, sf_dir))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from quire.llm import bpe as op
    return op.digest(op.encode(_docs(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                               public_tokenizers.PATTERN))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm import prefix_trie as op
    prepare(spark)
    return op.trie(table(spark, sf_dir, "conversations"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm import line_dedup as op
    return op.digest(op.drop_lines(_docs(spark, sf_dir)))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm import merkle as op
    return op.digest(op.manifest(_docs(spark, sf_dir)))


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_phrase_dedup": op2_phrase_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_decontaminate": op4_decontaminate,
    "op5_sharding": op5_sharding,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_pii": op7_pii,
    "op8_quality_rules": op8_quality_rules,
    "op9_bpe": op9_bpe,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_line_dedup": op12_line_dedup,
    "op13_merkle_manifest": op13_merkle_manifest,
}
