"""Training corpus pipeline: what is left of ``documents``, mixed and encoded.

Stages, each over all rows that the one before kept:

1. toxicity: documents that the classifier rejects go.
2. near_dedup: of each group of near duplicates one document stays.
3. pii: personal data in the texts is replaced by its kind.
4. mixing: sources are brought to their target weights; a document may come
   twice, and documents beyond their source's budget go.
5. bpe: the texts are encoded and decoded; digests of ids and bytes.

The last stage's rows are doc_id, n_tokens, ids_sha256, decoded_sha256; all
others return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowlens.llm import bpe, mixing, near_dup, pii, toxicity
from flowlens.llm.common import prepare, stored, table


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def _near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return near_dup.deduplicate(docs)


def _pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return pii.redact(docs)


def _mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mix(docs)


def _bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return bpe.digests(docs)


STAGES = [("toxicity", _toxicity), ("near_dedup", _near_dedup), ("pii", _pii), ("mixing", _mixing), ("bpe", _bpe)]

#: SQL can't express the stages; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
