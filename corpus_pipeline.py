"""The training-text pipeline: documents through five stages.

Every stage takes all rows that its predecessor kept; all but the last return
the columns of ``documents``. Its rows in SQL: none, as robust estimates,
alignment and byte-pair merges have no SQL form; the tests compare each stage
with a brute-force version and the whole with the stages one by one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers."""
    from quire.llm import quality_rules as op
    _prepare(spark)
    return op.keep_good(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: sets of five-word
    shingles with a similarity of 0.8 or more."""
    from quire.llm import jaccard_join as op
    _prepare(spark)
    return op.keep_one(docs, k=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    from quire.llm import decontaminate as op
    from quire.sources.tables import table
    _prepare(spark)
    return op.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    from quire.llm import secret_scan as op
    from quire.session import scratch_path
    _prepare(spark)
    return op.redact(docs, scratch_path(spark, f"ledger-{uuid.uuid4().hex}"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each document."""
    import public_tokenizers

    from quire.llm import bpe as op
    _prepare(spark)
    return op.digest(op.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))


def _prepare(spark: SparkSession) -> None:
    from quire.llm.registry import prepare
    prepare(spark)


STAGES = [
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("decontaminate", decontaminate),
    ("secret_scan", secret_scan),
    ("bpe", bpe),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each stage's rows are written as
    Parquet in the shared folder and read again as the next one's input."""
    from quire.session import materialize
    from quire.sources.tables import table
    _prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs)
    return docs
