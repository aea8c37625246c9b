"""A pipeline from documents to packed training sequences."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from rollkeep.llm import exact_dedup, language_id, packing, simhash, toxicity
from rollkeep.llm.common import shared_folder
from rollkeep.llm.queries import vocabulary


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents that the classifier calls toxic go; without labels of both kinds all stay, as do null and empty texts. Repeats are judged alike."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a recognisable language go, null and letterless texts among them; if no document has a language to learn from, all stay."""
    return language_id.keep_known(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the document with the largest doc_id stays; a null doc_id loses, and rows that repeat the largest one all stay."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each group of similar texts the document with the smallest doc_id stays; rows with a null doc_id stay, and so do repeats of the smallest."""
    return simhash.keep_one(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing into sequences of 2048 tokens: one row for each piece, with its ids in two bytes each; null and empty texts are one token."""
    return packing.pack(packing.cut(docs, vocabulary("byte_bpe_50k.json"), id_bytes=2))


STAGES = [("toxicity", clean), ("language_id", known_language), ("exact_dedup", exact_copies), ("simhash_dedup", near_copies), ("packing", packed)]

#: SQL cannot express the classifiers, the tokenizer and the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents in turn; each one's rows are written as Parquet and read again."""
    folder = shared_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    name = uuid.uuid4().hex
    for step, stage in STAGES:
        out = f"{folder}/pipeline-{name}/{step}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
