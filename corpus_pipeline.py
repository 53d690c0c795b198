"""The corpus pipeline: quality rules, near-dedup, decontamination, PII and
byte-level BPE, each over all that the stage before has kept.

Every stage function takes (spark, docs, sf_dir) and returns a DataFrame; all
but the last return the columns of ``docs``.  ``run`` writes each result as
Parquet to the shared folder and reads it again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import bpe, decontaminate, minhash_dedup, pii, quality
from meterlake.llm.common import beside, restored, table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality.judge(docs, table(spark, sf_dir, "labels"))
    return restored(judged.filter("kept"), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one of the smallest
    id.  Documents without words stay."""
    return minhash_dedup.drop_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    hits = decontaminate.find(beside(docs), table(spark, sf_dir, "benchmark"))
    return restored(hits.filter(F.size("hit_spans") == 0), docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by the name of its kind."""
    return pii.redact(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with n_tokens, token_ids and ``decoded_ok``: whether the ids
    decode to the text again."""
    decoded = bpe.encode(docs, decoded=True)
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return decoded.withColumn("decoded_ok", same).drop("decoded")


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("personal_data", personal_data),
          ("byte_bpe", byte_bpe)]

# The n-gram verdict, the signature join and the merges are beyond SQL; the
# stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
