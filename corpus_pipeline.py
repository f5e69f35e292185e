"""The corpus pipeline: five stages, each on what the one before it kept, written and read again between them.

All but the last return rows with the columns of documents. Every row is decided by its id and text together: a row
with a null id takes part like any other, and rows that repeat an id with other texts are decided apart. An empty
table passes through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import bpe, langid, pii, simhash
from quayside.llm.common import free_name, sha256_hex, snapshot, table
from quayside.llm.queries import BYTE_BPE, decontaminated


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled documents; texts without a language (null, or without a letter) go."""
    model = langid.learn(docs.where(~langid.held_out("doc_id")), F.col("text"), F.col("lang"))
    return langid.with_language(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    found = decontaminated(spark, docs, sf_dir).where("n_hit > 0")
    hit_id, mark = (free_name(docs, n) for n in ("_hit", "_mark"))
    hit = snapshot(found.select(F.col("id").alias(hit_id), F.col("mark").alias(mark)).distinct(), "hit")
    text = F.xxhash64(F.col("text").cast("string"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(hit_id)) & (text == F.col(mark))
    return docs.join(hit, same, "left_anti")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every identifier in a text becomes its kind in brackets."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and digests of them and of the bytes that they decode to."""
    path = public_tokenizers.path(BYTE_BPE)
    return bpe.encode(docs, path, public_tokenizers.PATTERN, decoded=True).select(
        F.col("id").alias("doc_id"),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        sha256_hex("ids").alias("ids_sha256"),
        sha256_hex("decoded").alias("decoded_sha256"),
    )


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: SQL cannot express the stages' models; they are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = snapshot(stage(spark, docs, sf_dir), name)
    return docs
